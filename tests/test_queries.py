"""Every query against its SQL; those without SQL against what is known of them."""

import pytest
from compare import connect, differences

from voxloom import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, con, name):
    assert differences(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name]) == []


@pytest.mark.parametrize("name", ["drop_reasons", "nearest_rank_quantile", "metric_histogram", "merge_first_wins", "sentence_split", "consensus_punctuated"])
@pytest.mark.parametrize("parts", [1, 32])
def test_results_do_not_depend_on_partitions(spark, con, name, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert differences(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name]) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("name", ["clip_view", "drop_reasons", "fail_missing_share"])
def test_clips_broadcast_no_table(spark, con, name):
    """Whatever the size of the files of events and labels: a driver's memory may not hold their rows."""
    before = spark.conf.get("spark.sql.maxBroadcastTableSize")
    spark.conf.set("spark.sql.maxBroadcastTableSize", 1000)
    try:
        assert differences(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name]) == []
    finally:
        spark.conf.set("spark.sql.maxBroadcastTableSize", before)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_word_errors(spark):
    from voxloom.functions.text import normalize_text

    pairs = {(r["conv_id"], r["turn"]): r for r in queries.turn_pairs(spark, SF).withColumns({"a": normalize_text("ref"), "b": normalize_text("hyp")}).collect()}
    for r in queries.wer_pairs(spark, SF).collect():
        p = pairs[r["conv_id"], r["turn"]]
        a, b = p["a"].split(), p["b"].split()
        assert r["wer"] == pytest.approx(edits(a, b) / len(a))


def test_punctuation_transfer(spark):
    got = queries.punctuation_transfer(spark, SF).collect()
    assert len(got) == queries.turn_pairs(spark, SF).count()
    assert all((r["text"] is None) == (r["share"] < 0.6) for r in got)


def test_signal_measures(spark):
    for r in queries.signal_measures(spark, SF).collect():
        assert r["pitch_mean"] == pytest.approx(110 + 20 * r["label"], rel=0.01)
        assert r["expressiveness"] < 0.01 and r["is_upsampled_est"]


def test_length_buckets(spark):
    rows = queries.length_buckets(spark, SF).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) == 200


def test_other_queries(spark):
    assert queries.deterministic_sample(spark, SF).collect() == queries.deterministic_sample(spark, SF).collect()
    assert queries.speaker_cluster(spark, SF).count() == 500
    by = {r["senko_status"] for r in queries.diarization_columns(spark, SF).collect()}
    assert {"ok", "raw_only", "no_speech", "error"} >= by and "ok" in by
