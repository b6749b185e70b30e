"""The pipeline's stages on the smallest table and on one without rows."""

import zlib
from collections import defaultdict

import public_tokenizers
from pyspark.sql import functions as F
from test_llm_operators import brute_targets, lower_az, similar_components, words

import corpus_pipeline
from voxloom.llm import language_id, queries
from voxloom.llm.common import stash


def test_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == columns, name
        n = out.count()
        assert 0 < n and (n <= before or "mixing" in name)
        before = n
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert last.count() == before and {"doc_id", "ids"} <= set(last.columns)


def test_stages_by_brute_force(spark):
    """Each stage's rows against plain Python on what the stage before kept, with copies and near copies added."""
    import sentencepiece

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = docs.limit(60)
    swapped = F.concat(F.upper(F.substring("text", 1, 40)), F.expr("substring(text, 41)"))
    near = F.concat(F.col("text"), F.lit(" one more end"))
    docs = docs.unionByName(first.withColumns({"doc_id": F.col("doc_id") + 10_000, "text": swapped})).unionByName(first.withColumns({"doc_id": F.col("doc_id") + 20_000, "text": near}))
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: {r["doc_id"]: r for r in df.collect()}

    found = stash(stages["language ID"](spark, docs, sf), "test")
    model = language_id.learn(docs)
    said = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(docs, model).collect()}
    assert set(rows(found)) == {d for d, (lang, score) in said.items() if lang != "und" and score >= language_id.LEAST_SCORE}

    once = stash(stages["exact dedup"](spark, found, sf), "test")
    last = {}
    for d, r in rows(found).items():
        key = lower_az(r["text"])
        last[key] = max(d, last.get(key, d))
    assert set(rows(once)) == set(last.values())

    apart = stash(stages["SimHash near-dedup"](spark, once, sf), "test")
    texts = {d: r["text"] for d, r in rows(once).items()}
    want = set(similar_components(texts)[0].values())
    assert want <= set(rows(apart)) and len(rows(apart)) - len(want) <= 0.01 * (len(texts) - len(want))

    mixed = stash(stages["mixing to target weights"](spark, apart, sf), "test")
    sizes, source = defaultdict(int), {}
    for d, r in rows(apart).items():
        source[d] = r["source"]
        sizes[r["source"]] += len(words(r["text"]))
    goal, taken = brute_targets(sizes), defaultdict(int)
    for r in mixed.collect():
        taken[r["source"]] += len(words(r["text"]))
    longest = max(len(words(r["text"])) for r in rows(apart).values())
    assert all(abs(taken[s] - goal[s]) <= longest for s in goal)

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {d: r["text"] for d, r in rows(mixed).items()}
    for r in stages["SentencePiece encoding and decoding"](spark, mixed, sf).collect():
        t = texts[r["doc_id"]]
        assert r["ids"] == sp.encode(t) and r["text_crc32"] == zlib.crc32(t.encode())


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = corpus_pipeline.find_language(spark, docs, "")
    assert kept.count() >= 0.99 * docs.count()


def test_empty(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0


def test_names():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES if k.startswith("op")) == list(range(1, 11))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_queries_match_sql(spark):
    from compare import connect, differences

    sf = "/root/testdata/sf0.001"
    con = connect(sf)
    for name, sql in queries.ORACLES.items():
        assert differences(queries.QUERIES[name](spark, sf), con, sql) == [], name
