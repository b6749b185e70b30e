"""Timed spans: alignments, diarization results and sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import endpoint_within
from ..functions.text import is_blank
from ..schema import named

SENTENCE_ENDS = (".", "!", "?")


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def alignment_valid(words: Column) -> Column:
    """Whether an array of (text, start, end) is an alignment: not empty, no blank text, finite
    times, 0 <= start <= end, and no start before the end of the word before."""
    each = F.forall(words, lambda w: ~is_blank(w["text"]) & _finite(w["start"]) & _finite(w["end"]) & (w["start"] >= 0) & (w["start"] <= w["end"]))
    n = F.size(words)
    order = F.forall(F.zip_with(F.slice(words, 2, F.greatest(n - 1, F.lit(0))), F.slice(words, 1, F.greatest(n - 1, F.lit(0))), lambda b, a: b["start"] >= a["end"]), lambda ok: F.coalesce(ok, F.lit(False)))
    return F.coalesce((n > 0) & each & order, F.lit(False))


def alignment_status(text: Column, words: Column, frames: Column, sample_rate: Column, tolerance_ms: int = 80) -> Column:
    """empty_text, error, out_of_bounds or ok."""
    inside = endpoint_within(F.element_at(words, -1)["end"], frames, sample_rate, tolerance_ms)
    return F.when(is_blank(text), "empty_text").when(~alignment_valid(words), "error").when(inside, "ok").otherwise("out_of_bounds")


def alignment_columns(df: DataFrame, text: str, words: str, frames: Column, sample_rate: Column, tolerance_ms: int = 80) -> DataFrame:
    """df with the alignment as compact JSON ([] unless it stands) and its status."""
    status = alignment_status(named(text), named(words), frames, sample_rate, tolerance_ms)
    return df.withColumn("qwen3_alignment_status", status).withColumn("qwen3_alignment", F.when(F.col("qwen3_alignment_status").isin("ok", "out_of_bounds"), F.to_json(named(words))).otherwise("[]"))


def out_of_order(words: DataFrame, clip: str, order: str, start: Column, end: Column) -> DataFrame:
    """words with monotonic: whether each starts no earlier than the word before it ends."""
    before = F.lag(end).over(Window.partitionBy(named(clip)).orderBy(named(order)))
    return words.withColumn("monotonic", F.coalesce(start >= before, F.lit(True)))


def turns_valid(turns: Column) -> Column:
    """Whether each (speaker, start, end) has a speaker and finite times with 0 <= start < end."""
    ok = F.forall(turns, lambda t: (F.coalesce(t["speaker"], F.lit("")) != "") & _finite(t["start"]) & _finite(t["end"]) & (t["start"] >= 0) & (t["start"] < t["end"]))
    return F.coalesce(ok, F.lit(False))


def timing_valid(timing: Column) -> Column:
    return F.coalesce((F.size(timing) > 0) & F.forall(F.map_values(timing), _finite), F.lit(False))


def diarization_columns(df: DataFrame, merged: str, raw: str, speakers: str, timing: str, missing: Column) -> DataFrame:
    """df with senko_segments, senko_raw_segments, senko_num_speakers, senko_timing and senko_status.

    missing tells where the diarizer found no speech. A result is ok with merged and raw turns, raw_only
    without merged ones, and an error where its turns, timing or speaker count don't hold up."""
    m, r, t = named(merged), named(raw), named(timing)
    distinct = F.size(F.array_distinct(F.transform(m, lambda x: x["speaker"])))
    good = turns_valid(m) & turns_valid(r) & timing_valid(t) & F.coalesce((named(speakers) >= 0) & (named(speakers) == distinct) & (F.size(r) > 0), F.lit(False))
    status = F.when(missing, "no_speech").when(~good, "error").when(F.size(m) > 0, "ok").otherwise("raw_only")
    rounded = lambda x: F.to_json(F.transform(x, lambda s: F.struct(s["speaker"].alias("speaker"), F.bround(s["start"], 3).alias("start"), F.bround(s["end"], 3).alias("end"))))
    df = df.withColumn("senko_status", status)
    stands = F.col("senko_status").isin("ok", "raw_only")
    return df.withColumns({
        "senko_segments": F.when(stands, rounded(m)).otherwise("[]"), "senko_raw_segments": F.when(stands, rounded(r)).otherwise("[]"),
        "senko_num_speakers": F.when(stands, named(speakers)).otherwise(0), "senko_timing": F.when(stands, F.to_json(t)).otherwise("{}"),
    })


def sentences(words: DataFrame, clip: str, order: str, file_seconds: Column, buffer: float = 0.5) -> DataFrame:
    """clip, sentence (from 0), text, start_timestamp, end_timestamp of words (word, start, end).

    A sentence ends at a word that ends in a full stop, an exclamation or a question mark; words
    after the last such one are dropped. The text loses its first character, the recognizer's
    space. Starts move back by half the gap to the word before, by the buffer at most, and then by
    the buffer once more; ends move on by half the gap to the next word, or to the last
    sample, by the buffer at most."""
    by = Window.partitionBy(named(clip)).orderBy(named(order))
    ends = F.right(F.col("word"), F.lit(1)).isin(*SENTENCE_ENDS)
    w = words.withColumns({
        "_before": F.lag("end").over(by), "_next": F.coalesce(F.lead("start").over(by), file_seconds), "_ends": ends,
        "_sentence": F.coalesce(F.sum(ends.cast("int")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    })
    first = F.min_by(F.struct("start", "_before"), named(order))
    last = F.max_by(F.struct("end", "_next", "_ends"), named(order))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(named(order).alias("o"), F.col("word").alias("w")))), lambda x: x["w"]), "")
    s = w.groupBy(named(clip), F.col("_sentence").cast("int").alias("sentence")).agg(first.alias("f"), last.alias("l"), text.alias("text")).where("l._ends")
    start = F.when(F.col("f._before").isNull(), F.greatest(F.col("f.start") - buffer, F.lit(0.0))).otherwise(F.greatest(F.col("f.start") - buffer, (F.col("f._before") + F.col("f.start")) / 2))
    return s.select(
        named(clip), "sentence", F.expr("substring(text, 2)").alias("text"), F.greatest(start - buffer, F.lit(0.0)).alias("start_timestamp"),
        F.least((F.col("l.end") + F.col("l._next")) / 2, F.col("l.end") + buffer).alias("end_timestamp"),
    )


def clip_sentences(clips: DataFrame, words: str = "words", folder: str | None = None, buffer: float = 0.5) -> DataFrame:
    """A row for each sentence of each clip, from the clip's words (word, start, end) and duration: the clip's columns
    but for its words and text, and sentence, text, start_timestamp, end_timestamp; with a folder also
    audio_file, the sentence's own file there."""
    each = clips.select("id", "duration", F.posexplode(named(words)).alias("_at", "_w")).select("id", "duration", "_at", "_w.word", "_w.start", "_w.end")
    found = sentences(each, "id", "_at", F.col("duration"), buffer)
    kept = clips.drop(words, "text", "sentence", "start_timestamp", "end_timestamp")
    out = kept.join(found, "id")
    return out.withColumn("audio_file", sentence_file(F.col("audio_file"), F.col("sentence"), folder)) if folder else out


def sentence_file(path: Column, sentence: Column, folder: str) -> Column:
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")
    return F.concat(F.lit(folder.rstrip("/") + "/"), stem, F.lit("_"), F.lpad(sentence.cast("string"), 8, "0"), F.regexp_extract(path, r"(\.[^./]*)$", 1))


def failure_streaks(rows: DataFrame, group: str, order: str, failed: Column) -> DataFrame:
    """group, failures and longest_streak (rows in an unbroken row of failures)."""
    by = Window.partitionBy(named(group)).orderBy(named(order))
    w = rows.select(named(group), failed.alias("_failed"), (F.row_number().over(by) - F.sum(F.when(failed, 1).otherwise(0)).over(by)).alias("_island"))
    runs = w.groupBy(named(group), "_island").agg(F.count_if("_failed").alias("n"))
    return runs.groupBy(named(group)).agg(F.sum("n").alias("failures"), F.max("n").alias("longest_streak"))
