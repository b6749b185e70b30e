"""Thresholds, drop reasons and the figures of the quality report."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import is_number, sentinel_to_null
from ..functions.text import is_blank, strip_text
from ..schema import named
from ..storage import new_folder


@dataclass(frozen=True)
class Thresholds:
    distillmos: float = 3.0
    wada_snr: float = 15.0
    stoi: float = 0.85
    duration: tuple[float, float] = (1.0, 20.0)
    cer: float = 0.15
    agreement: float = 0.6
    bandwidth: float = 6000.0
    speaker_conf: float = 0.75
    speaking_rate: tuple[float, float] = (5.0, 30.0)
    human_text: frozenset[str] = field(default_factory=frozenset)
    asr_text: frozenset[str] = field(default_factory=frozenset)
    unknown_is_speaker: bool = True  # whether the label "unknown" counts as a speaker


def _column(df: DataFrame, name: str, kind: str = "double") -> Column:
    return named(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)


def _outside(value: Column, lo: float, hi: float) -> Column:
    """NaN lies outside."""
    return value.isNotNull() & (F.isnan(value) | (value < lo) | (value > hi))


def drop_reasons(df: DataFrame, limits: Thresholds = Thresholds()) -> Column:
    """The failed checks of a clip, in order; none for a good one.

    A check whose column is null or absent is skipped. A NaN passes the one-sided checks and
    fails the ranges. CER is checked in data sets of human text, agreement in those of ASR text."""
    num = lambda x: _column(df, x)
    below = lambda x, t: is_number(num(x)) & (num(x) < t)
    dataset = _column(df, "dataset", "string")
    speaker = F.coalesce(F.nullif(_column(df, "speaker_id", "string"), F.lit("")), F.nullif(_column(df, "speaker", "string"), F.lit("")))
    if not limits.unknown_is_speaker:
        speaker = F.nullif(speaker, F.lit("unknown"))
    confident = is_number(num("speaker_conf")) & (num("speaker_conf") >= limits.speaker_conf)
    of_human = dataset.isin(*sorted(limits.human_text)) if limits.human_text else F.lit(False)
    of_asr = dataset.isin(*sorted(limits.asr_text)) & ~of_human if limits.asr_text else F.lit(False)
    checks = {
        "mos": below("distillmos", limits.distillmos),
        "snr": below("wada_snr", limits.wada_snr),
        "stoi": below("pyt_stoi", limits.stoi),
        "dur": _outside(num("duration"), *limits.duration),
        "bandwidth": below("bandwidth_hz", limits.bandwidth),
        "srate": _outside(num("speaking_rate"), *limits.speaking_rate),
        "cer": of_human & is_number(num("whisper_cer")) & (num("whisper_cer") > limits.cer),
        "asr_agree": of_asr & below("asr_agreement", limits.agreement),
        "no_speaker": speaker.isNull() & ~F.coalesce(confident, F.lit(False)),
        "no_text": is_blank(_column(df, "text", "string")),
    }
    return F.array_compact(F.array(*[F.when(F.coalesce(failed, F.lit(False)), F.lit(reason)) for reason, failed in checks.items()]))


def with_reasons(df: DataFrame, limits: Thresholds = Thresholds(), name: str = "reasons") -> DataFrame:
    return df.withColumn(name, drop_reasons(df, limits))


def clean(df: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    return df.where(F.size(drop_reasons(df, limits)) == 0)


def reason_counts(df: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """reason, clips, and their share of all clips in percent."""
    listed = df.select(drop_reasons(df, limits).alias("reasons"))
    # one pass: a null reason for every clip carries the total
    rows = listed.select(F.explode(F.concat(F.col("reasons"), F.array(F.lit(None).cast("string")))).alias("reason"))
    counts = rows.groupBy("reason").agg(F.count(F.lit(1)).alias("clips"))
    total = F.max(F.when(F.col("reason").isNull(), F.col("clips"))).over(Window.partitionBy())  # a row a reason
    return counts.withColumn("percent", 100 * F.col("clips") / total).where("reason IS NOT NULL")


def summary(df: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """clips, hours, speakers, kept and kept_percent (floored) of a table."""
    speaker = F.coalesce(F.nullif(_column(df, "speaker_id", "string"), F.lit("")), _column(df, "speaker", "string"))
    good = F.size(drop_reasons(df, limits)) == 0
    seconds = F.coalesce(F.nanvl(_column(df, "duration"), F.lit(0.0)), F.lit(0.0))
    rows = df.select(seconds.alias("s"), F.nullif(strip_text(speaker), F.lit("")).alias("speaker"), good.alias("good"))
    out = rows.agg(F.count(F.lit(1)).alias("clips"), (F.coalesce(F.sum("s"), F.lit(0.0)) / 3600).alias("hours"), F.count_distinct("speaker").alias("speakers"), F.count_if("good").alias("kept"))
    return out.withColumn("kept_percent", F.expr("(100 * kept) div greatest(1, clips)"))


def passes(value: Column, kind: str, limit: float | tuple[float, float]) -> Column:
    if kind == "ge":
        return value >= limit
    return value <= limit if kind == "le" else value.between(*limit)


def metric_limits(limits: Thresholds = Thresholds(), human: bool = False, asr: bool = False) -> list[tuple[str, str, str, float | tuple[float, float]]]:
    """(column, label, kind of limit, limit) of the report's metrics."""
    out = [
        ("distillmos", "MOS (DistillMOS)", "ge", limits.distillmos), ("wada_snr", "SNR (WADA), dB", "ge", limits.wada_snr), ("pyt_stoi", "STOI", "ge", limits.stoi),
        ("duration", "Duration, s", "range", limits.duration), ("bandwidth_hz", "Bandwidth, Hz", "ge", limits.bandwidth), ("speaking_rate", "Speaking rate, phonemes/s", "range", limits.speaking_rate),
    ]
    return out + [("whisper_cer", "CER (whisper)", "le", limits.cer)] * human + [("asr_agreement", "ASR agreement", "ge", limits.agreement)] * asr


def fail_shares(df: DataFrame, metrics: list[tuple[str, str, str, float | tuple[float, float]]]) -> DataFrame:
    """metric, clips, missing, failing: one scan and one aggregation for all metrics."""
    values = {m: sentinel_to_null(_column(df, m)) for m, *_ in metrics}
    sums = [F.count(F.lit(1)).alias("clips")]
    for m, _, kind, limit in metrics:
        sums += [F.count_if(values[m].isNull()).alias(f"missing_{m}"), F.count_if(values[m].isNotNull() & ~passes(values[m], kind, limit)).alias(f"failing_{m}")]
    one = df.agg(*sums)
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col("clips"), F.col(f"missing_{m}").alias("missing"), F.col(f"failing_{m}").alias("failing")) for m, *_ in metrics])
    return one.select(F.inline(rows))


def nearest_rank(df: DataFrame, column: str, quantiles: list[float]) -> DataFrame:
    """q and value: the value at place min(n - 1, floor(q * n)) in order. Exact, whatever the size:
    distinct values are counted first, their counts summed in ranges of values, and
    running sums are taken within ranges."""
    counted = df.select(named(column).alias("value")).where("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    edges = counted.agg(F.approx_percentile("value", F.array(*[F.lit(i / 64) for i in range(1, 64)]), 1000).alias("edges"))
    ranged = counted.crossJoin(F.broadcast(edges)).withColumn("r", F.size(F.filter("edges", lambda e: e < F.col("value")))).drop("edges")
    sums = ranged.groupBy("r").agg(F.sum("n").alias("s"))
    by_range = Window.orderBy("r")  # at most 64 rows
    sums = sums.withColumns({"before": F.sum("s").over(by_range) - F.col("s"), "total": F.sum("s").over(Window.partitionBy())}).drop("s")
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("r").orderBy("value"))
    placed = ranged.join(F.broadcast(sums), "r").withColumn("upto", upto)
    wanted = F.array(*[F.struct(F.lit(q).alias("q"), F.least(F.col("total") - 1, F.floor(F.lit(q) * F.col("total"))).alias("at")) for q in quantiles])
    hits = placed.withColumn("w", F.explode(wanted)).where((F.col("w.at") < F.col("upto")) & (F.col("w.at") >= F.col("upto") - F.col("n")))
    return hits.select("w.q", "value")


def histogram(df: DataFrame, column: str, limit: float | tuple[float, float], bins: int = 48) -> DataFrame:
    """bin and clips of the values between the 0.5 and 99.5 percent places, stretched to hold
    the limits; values beyond are counted at the edges. Empty bins have no row."""
    ends = nearest_rank(df, column, [0.005, 0.995]).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    limits = limit if isinstance(limit, tuple) else (limit, limit)
    ends = ends.select(F.least("lo", F.lit(limits[0])).alias("lo"), F.greatest("hi", F.lit(limits[1])).alias("hi"))
    ends = ends.select("lo", F.when(F.col("hi") <= F.col("lo"), F.col("lo") + 1).otherwise(F.col("hi")).alias("hi"))  # one row
    rows = df.select(named(column).alias("v")).where("v IS NOT NULL").crossJoin(F.broadcast(ends))
    place = (F.least(F.greatest("v", "lo"), F.col("hi")) - F.col("lo")) / (F.col("hi") - F.col("lo")) * (bins - 1)
    return rows.select(F.floor(place).cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("clips"))


def near_limit(df: DataFrame, column: str, kind: str, limit: float | tuple[float, float], n: int, tie: str) -> DataFrame:
    """The n rows nearest to the limit on either side, with passing, distance and place; ties by
    the column tie. Each side is a top-n of its own, so no task sorts a whole side."""
    limits = limit if isinstance(limit, tuple) else (limit,)
    value = sentinel_to_null(named(column).cast("double"))
    away = F.least(*[F.abs(value - x) for x in limits]) if len(limits) > 1 else F.abs(value - limits[0])
    rows = df.where(value.isNotNull()).withColumns({"passing": passes(value, kind, limit), "distance": away})
    sides = [rows.where(F.col("passing") == side).orderBy("distance", tie).limit(n) for side in (False, True)]
    order = Window.partitionBy("passing").orderBy("distance", tie)
    return sides[0].unionByName(sides[1]).withColumn("place", F.row_number().over(order))


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows that depend on the key and the seed alone."""
    return df.orderBy(F.xxhash64(named(key), F.lit(seed)), named(key)).limit(n)


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """n, pearson, mae and spread (greatest less least difference) of two columns, where both have a number."""
    x, y = named(a).cast("double"), named(b).cast("double")
    rows = df.select(x.alias("x"), y.alias("y")).where(is_number(F.col("x")) & is_number(F.col("y")))
    gap = F.col("x") - F.col("y")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.corr("x", "y").alias("pearson"), F.avg(F.abs(gap)).alias("mae"), (F.max(gap) - F.min(gap)).alias("spread"))


def ordinal_ranks(df: DataFrame, column: str, tie: str, name: str) -> DataFrame:
    """df with the place of each row in order of column, from 0, nulls first; equal values by the column tie. Rows are
    dealt into ranges of both, so that a value that very many rows have is cut too, and written in order to
    the shared folder; a row's place is its place in its range and what the ranges before hold."""
    spark, folder = df.sparkSession, new_folder(df.sparkSession, "ranks")
    order = [named(column), named(tie)]
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_r": F.spark_partition_id(), "_i": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    placed.write.parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)
    sizes = placed.groupBy("_r").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select(F.col("_r").alias("_q"), (F.sum("_n").over(Window.orderBy("_r")) - F.col("_n")).alias("_before"))  # a row a range
    return placed.join(F.broadcast(sizes), F.col("_r") == F.col("_q")).withColumn(name, F.col("_i") + F.col("_before")).drop("_r", "_i", "_q", "_before")


def spearman(df: DataFrame, a: str, b: str, tie: str) -> DataFrame:
    """n and spearman: the correlation of ordinal ranks."""
    ranked = ordinal_ranks(ordinal_ranks(df.select(*dict.fromkeys((a, b, tie))), a, tie, "_ra"), b, tie, "_rb")
    return ranked.agg(F.count(F.lit(1)).alias("n"), F.corr(F.col("_ra").cast("double"), F.col("_rb").cast("double")).alias("spearman"))
