"""Queries against their SQL on documents with rows that the test tables lack."""

import os

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from voxloom import queries

SF = "/root/testdata/sf0.001"
#: text, lang, source, n_chars
UNCOUNTED = [("", "en", "web", 0), ("   ", "de", "web", 0), ("words of which none is counted", "fr", "books", 0), ("words that are counted", "es", "web", None), ("of no source", "en", None, 0), ("of a blank source", "en", "\u00a0", 0)]


def tables(spark, folder, rows):
    """The test tables with more documents, the first ids being those of events."""
    os.makedirs(folder)
    for x in os.listdir(SF):
        if x != "documents.parquet":
            os.symlink(f"{SF}/{x}", f"{folder}/{x}")
    more = spark.createDataFrame([(500 + i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.read.parquet(f"{SF}/documents.parquet").unionByName(more).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def uncounted(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("odd") / "uncounted", UNCOUNTED)


def test_ieee_divide(spark):
    from voxloom.functions.numbers import ieee_divide

    rows = spark.createDataFrame([(6, 4.0), (1, 0.0), (0, 0.0), (-1, 0.0), (None, 0.0), (1, None)], "a long, b double")
    got = [r[0] for r in rows.select(ieee_divide(F.col("a"), F.col("b"))).collect()]
    assert got[:2] == [1.5, float("inf")] and got[2] != got[2] and got[3:] == [float("-inf"), None, None]


@pytest.mark.parametrize("name", ["clean_rows", "clip_reasons", "clip_view", "drop_reasons", "fail_missing_share", "qa_summary"])
def test_clips_without_counted_characters(spark, uncounted, name):
    assert differences(queries.QUERIES[name](spark, uncounted), connect(uncounted), queries.ORACLES[name]) == []


@pytest.mark.parametrize("name", ["clip_view"])
def test_clips_of_no_document_id(spark, tmp_path, name):
    folder = tables(spark, tmp_path / "ids", [])
    rows = spark.createDataFrame([(None, "of no id", "en", "web", 5), (-4, "of an id that divides by zero", "en", "web", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    rows.write.mode("append").parquet(f"{folder}/documents.parquet")
    assert differences(queries.QUERIES[name](spark, folder), connect(folder), queries.ORACLES[name]) == []


def shuffled_bytes(df):
    """Runs a query; the bytes that all its exchanges were given."""

    def of(plan):
        name = plan.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return of(plan.executedPlan())
        if "QueryStage" in name:
            return of(plan.plan())
        below = plan.children()
        own = plan.metrics().apply("dataSize").value() if name == "Exchange" else 0
        return own + sum(of(below.apply(i)) for i in range(below.size()))

    df.collect()
    return of(df._jdf.queryExecution().executedPlan())


@pytest.fixture(scope="module")
def long_texts(spark, tmp_path_factory):
    """Forty texts of 100,000 characters."""
    return tables(spark, tmp_path_factory.mktemp("odd") / "long", [("words " * 16_666 + "last", "en", "web", 100_000)] * 40)


@pytest.mark.parametrize("name", ["drop_reasons", "fail_missing_share"])
def test_figures_send_no_texts_through_the_joins(spark, long_texts, name):
    """Whole texts in a merge's sort ran out of a small heap's memory."""
    df = queries.QUERIES[name](spark, long_texts)
    assert 0 < shuffled_bytes(df) < 1_000_000
    assert differences(df, connect(long_texts), queries.ORACLES[name]) == []


TEXTS = [
    None, "", " ", "  both ends  ", "\ttab\t", "\nlines\n", "a\r\nb", "a\rb\r", "\x0b\x0c\x1c\x1f", "\u00a0\u3000", '"', '""', '"a"', 'a"', '"|', 'say "x" | y', "\\", '\\"', "a\\", "|", "#",
    "null", "NULL", "\\N", "\x00", "a\x00b", 'a\x00"b', '"\x00', "\x00\n\x00", "\ufeffbom", "\U0001f600", "\x01",
]


def test_blank_texts_are_told_without_the_texts(spark, tmp_path):
    from voxloom.operators import quality

    folder = tables(spark, tmp_path / "blanks", [(t, "en", "web", 1) for t in [*TEXTS, "\u0085", "\u2028\u2029\u180e", "\u200b", "\n\n\U0001f600", " " * 100_000]])
    reasons = [sorted(tuple(r) for r in quality.with_reasons(queries.clips(spark, folder, whole), queries.LIMITS).select("doc_id", F.array_join("reasons", " ")).collect()) for whole in (True, False)]
    assert reasons[0] == reasons[1] and len(reasons[0]) > len(TEXTS)


def test_csv_keeps_texts_as_they_are(spark, tmp_path):
    rows = [(t, lang, "web", 1) for t in TEXTS for lang in ("en", None, "", " d ")]
    folder = tables(spark, tmp_path / "texts", rows)
    assert differences(queries.csv_round_trip(spark, folder), connect(folder), queries.ORACLES["csv_round_trip"]) == []


def test_csv_of_the_usual_dialect_keeps_white_space(spark, tmp_path):
    from voxloom.sources import clips, sinks

    df = spark.createDataFrame([(str(i), "x.wav", t) for i, t in enumerate(TEXTS)], "id string, audio_file string, text string")
    sinks.write_csv(df, f"{tmp_path}/c")
    back = {int(r["id"]): r["text"] for r in clips.read_csv(spark, f"{tmp_path}/c").collect()}
    assert [back[i] for i in range(len(TEXTS))] == [t or "" for t in TEXTS]
