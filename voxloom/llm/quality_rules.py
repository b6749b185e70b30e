"""Quality rules with suffix-array repetition.

The words of a text are the symbols of its suffix array. Prefix doubling builds it,
for all texts of a slice at once: suffixes are ordered by their first word, then
by twice as many words a round, and only suffixes not yet told apart go on. Longest
common prefixes of neighbours come from the rounds' ranks. They form a tree of intervals;
each interval of value v >= min_repeat is a maximal repeated substring of v words, and
the deepest interval that holds a suffix has the greater of its two common prefixes.
These spans, united, are the repeated part of the text. A text is dropped if the
repeated part is too large a fraction of its words or its longest repeat too long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import c, documents, slices

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MOST_REPEAT_PERCENT, WINDOW = 50, 50, 3
MIN_REPEAT, MOST_COVERED, MOST_LONGEST = 8, 0.2, 50


def suffix_ranks(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of many texts at once, and the ranks after each round.

    ids: the symbols of all texts, one after another; ends: for each symbol, the end of its text.
    Suffixes of an earlier text come before those of a later one, so none is compared
    with another text's. Round k's ranks agree where the first 2**k symbols do.
    """
    n = len(ids)
    if n >= 1 << 31:
        raise ValueError("a slice has too many words")
    sa = np.lexsort((ids, ends))
    rank = np.empty(n, dtype=np.int32)  # a copy of all ranks is kept for each round

    def number(order: np.ndarray, starts: np.ndarray, differs: np.ndarray) -> np.ndarray:
        """Ranks of order: the place of the first of those that don't differ."""
        return np.maximum.accumulate(np.where(differs, starts, 0))

    differs = np.r_[True, (ids[sa[1:]] != ids[sa[:-1]]) | (ends[sa[1:]] != ends[sa[:-1]])] if n else np.zeros(0, bool)
    rank[sa] = number(sa, np.arange(n), differs)
    ranks, width = [rank.copy()], 1
    shared = ~differs | np.r_[~differs[1:], False] if n else differs
    active = np.flatnonzero(shared)
    while len(active):
        own = sa[active]
        ahead = own + width
        nxt = np.where(ahead < ends[own], rank[np.minimum(ahead, n - 1)], -1)
        old = rank[own]
        order = np.lexsort((nxt, old))
        own, nxt, old = own[order], nxt[order], old[order]
        sa[active] = own
        differs = np.r_[True, (old[1:] != old[:-1]) | (nxt[1:] != nxt[:-1])]
        rank[own] = number(own, active, differs)
        ranks.append(rank.copy())
        width *= 2
        active = active[~differs | np.r_[~differs[1:], False]]
    return sa, ranks


def common_prefixes(sa: np.ndarray, ranks: list[np.ndarray], ends: np.ndarray, least: int) -> np.ndarray:
    """For each suffix but the first in order, the symbols it shares with the one before;
    0 where these are fewer than least."""
    out = np.zeros(max(0, len(sa) - 1), dtype=np.int64)
    k = max(0, least.bit_length() - 1)
    if k >= len(ranks):
        return out
    at = np.flatnonzero(ranks[k][sa[1:]] == ranks[k][sa[:-1]])
    a, b = sa[:-1][at], sa[1:][at]
    got = np.zeros(len(at), dtype=np.int64)
    for j in range(len(ranks) - 1, -1, -1):
        inside = (a + got < ends[a]) & (b + got < ends[b])
        same = inside & (ranks[j][np.minimum(a + got, len(sa) - 1)] == ranks[j][np.minimum(b + got, len(sa) - 1)])
        got += same.astype(np.int64) << j
    out[at] = np.where(got >= least, got, 0)
    return out


def covered(n: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which of n symbols the union of spans holds."""
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def repeats(ids: np.ndarray, counts: np.ndarray, min_repeat: int = MIN_REPEAT, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text (counts: its symbols): symbols in windows found twice or more,
    symbols that maximal repeats of min_repeat symbols or more cover, and the longest repeat."""
    n, texts = len(ids), len(counts)
    if not n:
        return (np.zeros(texts, dtype=np.int64),) * 3
    ends = np.repeat(np.cumsum(counts), counts)
    text = np.repeat(np.arange(texts), counts)
    sa, ranks = suffix_ranks(ids, ends)
    sums = []
    longest = np.zeros(texts, dtype=np.int64)
    shared = common_prefixes(sa, ranks, ends, min(window, min_repeat))
    for least in (window, min_repeat):
        deep = np.where(shared >= least, shared, 0)
        length = np.maximum(np.r_[0, deep], np.r_[deep, 0])
        some = length > 0
        spans = length[some] if least == min_repeat else np.full(int(some.sum()), window)
        sums.append(np.bincount(text[covered(n, sa[some], spans)], minlength=texts))
    np.maximum.at(longest, text[sa[some]], length[some])
    return sums[0], sums[1], longest


def measure(texts: list[str | None], min_repeat: int = MIN_REPEAT) -> dict[str, np.ndarray]:
    """The figures of each text; a null text has none of anything."""
    raw = [(t or "").encode() for t in texts]
    words = [b.split() for b in raw]
    known = {w: i for i, w in enumerate(dict.fromkeys(w for ws in words for w in ws))}
    counts = np.fromiter(map(len, words), np.int64, len(words))
    ids = np.fromiter((known[w] for ws in words for w in ws), np.int64, int(counts.sum()))
    twice, cover, longest = repeats(ids, counts, min_repeat)
    lines = [[x for x in b.split(b"\n") if x.strip()] for b in raw]
    return {
        "n_words": counts,
        "word_chars": np.array([len(t or "") - len(b) + sum(map(len, w)) for t, b, w in zip(texts, raw, words)], dtype=np.int64),
        "n_symbols": np.array([len(b) - len(b.translate(None, SYMBOLS)) for b in raw], dtype=np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], dtype=np.int64),
        "n_repeat_words": twice, "covered_words": cover, "longest_repeat": longest,
    }


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")


def with_figures(df: DataFrame, text_col: str = "text", min_repeat: int = MIN_REPEAT) -> DataFrame:
    """The id columns given in df, without text_col, with the figures of the text."""
    kept = [x for x in df.schema if x.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text_col):
                found = measure(piece.column(text_col).to_pylist(), min_repeat)
                yield pa.RecordBatch.from_arrays([*(piece.column(x.name) for x in kept), *(pa.array(found[x]) for x in FIGURES)], [*(x.name for x in kept), *FIGURES])

    return df.mapInArrow(run, T.StructType([*kept, *(T.StructField(x, T.LongType()) for x in FIGURES)]))


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_repeat: int = MIN_REPEAT, most_covered: float = MOST_COVERED, most_longest: int = MOST_LONGEST) -> DataFrame:
    """A row for each row of df: id_col, the figures, base_failed and kept.

    base_failed: fewer than 50 words, or over half of them in 3-word windows found twice or
    more. kept: not base_failed, repeats of min_repeat words or more cover at most the
    fraction most_covered of the words, and none is longer than most_longest words. Null
    and empty texts have zero words and fail. Null ids and repeated rows are rows like others;
    other columns of df aren't read. An empty table gives an empty one.
    """
    found = with_figures(df.select(c(id_col).alias("_id"), c(text_col).alias("text")), "text", min_repeat)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words"))
    good = (F.col("covered_words") <= most_covered * F.col("n_words")) & (F.col("longest_repeat") <= most_longest)
    return found.select(F.col("_id").alias(id_col), *FIGURES, failed.alias("base_failed"), (~failed & good).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir)).drop("longest_repeat")


def _windows(size: int) -> str:
    """Places of windows of so many words that a text has twice or more."""
    return f"""(SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM
  (SELECT doc_id, i, array_to_string(ws[i : i + {size - 1}], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {size - 2})) AS i FROM w))) WHERE n > 1)"""


#: A word lies in a repeat of MIN_REPEAT words or more exactly when it lies in a window of MIN_REPEAT words
#: that the text has twice; a repeat is longer than MOST_LONGEST when a window of one more is there twice.
ORACLE = f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
a AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM {_windows(WINDOW)}, range(0, {WINDOW}) r(k) GROUP BY doc_id),
b AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM {_windows(MIN_REPEAT)}, range(0, {MIN_REPEAT}) r(k) GROUP BY doc_id),
c AS (SELECT DISTINCT doc_id FROM {_windows(MOST_LONGEST + 1)}),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM w),
f AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(a.n, 0)::BIGINT AS n_repeat_words, coalesce(b.n, 0)::BIGINT AS covered_words, c.doc_id IS NULL AS short
  FROM w JOIN l USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN c USING (doc_id)),
g AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEAT_PERCENT} * n_words AS base_failed FROM f)
SELECT * EXCLUDE (short), NOT base_failed AND short AND covered_words <= {MOST_COVERED} * n_words AS kept FROM g
"""
