"""Text expressions: normalization, error rates, punctuation and counts."""

from __future__ import annotations

import difflib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The punctuation that normalization blanks, and the marks that count as punctuation.
PUNCTUATION = r"[!-/:-@\[-`{-~«»—…“”„]"
SENTENCE_MARKS = r"[.,!?…;:—]"
TRANSFER_MARKS = ".,!?"
#: WER writes each distinct word of a pair as one character of this private range.
FIRST_WORD_CODE, WORD_CODES = 0xE000, 6400


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_text(text: Column) -> Column:
    """Without leading and trailing Unicode white space."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_blank(text: Column) -> Column:
    return F.coalesce(strip_text(text), F.lit("")) == ""


def normalize_text(text: Column) -> Column:
    """Lower case; bracketed asides and punctuation become spaces; white space is collapsed."""
    bare = F.regexp_replace(F.lower(text), r"(?d)\(.*?\)|<.*?>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, PUNCTUATION, " "), r"(?U)\s+", " "))


def has_punctuation(text: Column) -> Column:
    return F.coalesce(text.rlike(SENTENCE_MARKS), F.lit(False))


def char_error_rate(reference: Column, hypothesis: Column) -> Column:
    """Edit distance by characters over the reference's length; null for an empty reference."""
    return F.levenshtein(reference, hypothesis) / F.nullif(F.length(reference), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a normalized text."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def word_edits(reference: list[str], hypothesis: list[str]) -> int:
    """Edit distance by words, a row of the table at a time."""
    ids: dict[str, int] = {}
    a, b = (np.array([ids.setdefault(w, len(ids)) for w in ws], dtype=np.int64) for ws in (reference, hypothesis))
    steps = np.arange(len(b) + 1)
    row = steps
    for w in a:
        new = np.r_[row[0] + 1, np.minimum(row[1:] + 1, row[:-1] + (b != w))]
        row = np.minimum.accumulate(new - steps) + steps
    return int(row[-1])


@F.pandas_udf(T.LongType())
def word_edits_udf(reference: pd.Series, hypothesis: pd.Series) -> pd.Series:
    """word_edits of arrays of words; null where one is null."""
    return pd.Series([None if a is None or b is None else word_edits(list(a), list(b)) for a, b in zip(reference, hypothesis)], dtype="Int64")


def word_error_rate(reference: Column, hypothesis: Column) -> Column:
    """Edit distance by words over the reference's words; null for an empty reference.

    Each distinct word of the pair becomes one character, so levenshtein counts words. Pairs
    with more than 6,400 distinct words, and no others, go through word_edits_udf."""
    vocab = F.array_distinct(F.concat(words_of(reference), words_of(hypothesis)))
    # A character's low surrogate-free code in UTF-16, two bytes: hex digits of the code
    code = lambda w: F.decode(F.unhex(F.lpad(F.hex(F.array_position(vocab, w) + F.lit(FIRST_WORD_CODE - 1)), 4, "0")), "UTF-16BE")
    spelt = lambda t: F.array_join(F.transform(words_of(t), code), "")
    many = F.coalesce(F.size(vocab) > WORD_CODES, F.lit(False))
    by_words = word_edits_udf(*(F.when(many, words_of(t)) for t in (reference, hypothesis)))
    edits = F.when(many, by_words).otherwise(F.levenshtein(spelt(reference), spelt(hypothesis)))
    return edits / F.nullif(F.size(words_of(reference)), F.lit(0))


def normalized_rates(ref: Column, hyp: Column) -> tuple[Column, Column]:
    """(wer, cer) of texts that are normalized; -1 for both where the reference has no text."""
    none = F.coalesce(ref, F.lit("")) == ""
    return tuple(F.when(none, -1.0).otherwise(rate(ref, hyp)) for rate in (word_error_rate, char_error_rate))


def error_rates(reference: Column, hypothesis: Column) -> tuple[Column, Column]:
    """The same of texts as they are. Each use normalizes them anew: see with_error_rates()."""
    return normalized_rates(normalize_text(reference), normalize_text(F.coalesce(hypothesis, F.lit(""))))


def with_error_rates(df: DataFrame, reference: Column, hypothesis: Column, wer: str | None, cer: str | None) -> DataFrame:
    """df with the rates that are named. Each text is normalized once, in a projection of its own."""
    df = df.withColumns({"_ref": normalize_text(reference), "_hyp": normalize_text(F.coalesce(hypothesis, F.lit("")))})
    found = normalized_rates(F.col("_ref"), F.col("_hyp"))
    return df.withColumns({k: v for k, v in zip((wer, cer), found) if k}).drop("_ref", "_hyp")


def pair_distance(a: Column, b: Column) -> Column:
    """Mean of both character error rates, at most 1; two empty texts agree, one alone is at 1."""
    both = let(F.levenshtein(a, b).cast("double"), lambda edits: F.least(F.lit(1.0), (edits / F.length(a) + edits / F.length(b)) / 2))
    return F.when((a == "") & (b == ""), 0.0).when((a == "") | (b == ""), 1.0).otherwise(both)


def split_trailing_punct(text: Column) -> Column:
    """Array of (word, mark): the last mark of the run that ends a token; tokens of marks alone go."""
    tokens = F.filter(F.split(text, r"(?U)\s+"), lambda t: t != "")
    pattern = rf"(?s)^(.*?)([{TRANSFER_MARKS}]*)$"
    parts = F.transform(tokens, lambda t: F.struct(F.regexp_extract(t, pattern, 1).alias("word"), F.right(F.regexp_extract(t, pattern, 2), F.lit(1)).alias("mark")))
    return F.filter(parts, lambda p: p["word"] != "")


def word_key(word: Column) -> Column:
    """What two words must share to count as one."""
    return F.regexp_replace(F.replace(F.lower(word), F.lit("ё"), F.lit("е")), "[^а-яa-z0-9]+", "")


def char_count(text: Column) -> Column:
    return F.length(strip_text(text))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\w+"))


def nonspace_count(text: Column) -> Column:
    return F.length(F.replace(text, F.lit(" "), F.lit("")))


def join_segments(segments: Column, sep: str = " ") -> Column:
    """The texts of recognizer segments, blank ones left out."""
    kept = F.filter(F.transform(segments, strip_text), lambda t: F.coalesce(t, F.lit("")) != "")
    return F.array_join(kept, sep)


def _marks_of(text: str) -> tuple[list[str], list[str]]:
    words, marks = [], []
    for token in text.split():
        word = token.rstrip(TRANSFER_MARKS)
        if word:
            words.append(word)
            marks.append(token[-1] if len(token) > len(word) else "")
    return words, marks


def _key(word: str) -> str:
    return "".join(ch for ch in word.lower().replace("ё", "е") if "а" <= ch <= "я" or "a" <= ch <= "z" or "0" <= ch <= "9")


def moved_punctuation(reference: str | None, hypothesis: str | None, min_match: float = 0.6) -> tuple[str | None, float]:
    """The reference's words with the marks of the words they match in the hypothesis, and the
    fraction of words matched; no text where that is below min_match."""
    words, _ = _marks_of(reference or "")
    heard, marks = _marks_of(hypothesis or "")
    if not words or not heard:
        return None, 0.0
    pairs = difflib.SequenceMatcher(None, [*map(_key, words)], [*map(_key, heard)], autojunk=False).get_matching_blocks()
    mark_of = {p.a + i: marks[p.b + i] for p in pairs for i in range(p.size)}
    share = len(mark_of) / len(words)
    if share < min_match:
        return None, share
    final = len(words) - 1
    if mark_of.get(final) not in {".", "!", "?"}:
        mark_of[final] = "."
    return " ".join(w + mark_of.get(i, "") for i, w in enumerate(words)), share


def transfer_punctuation(min_match: float = 0.6):
    """A function of the columns reference and hypothesis: struct (text, share). Matching blocks
    aren't an SQL expression, so this is a pandas UDF."""

    @F.pandas_udf("text string, share double")
    def run(reference: pd.Series, hypothesis: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([moved_punctuation(a, b, min_match) for a, b in zip(reference, hypothesis)], columns=["text", "share"])

    return run
