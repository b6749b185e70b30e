"""The training-data operators against brute force, on small tables with all the odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import exact_dedup, language_id, lm_scoring, mixing, quality_rules, sentencepieces, sharding, simhash, suffix_dedup, token_files
from voxloom.llm.common import unit_hash

DOCS = "/root/testdata/sf0.001/documents.parquet"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, rid long, chunk long, label string, `a.b` string"


def rows(*pairs):
    """Documents with columns whose names the operators use themselves."""
    return [(d, t, "en", s, 1, 7, 7, 7, "x", "y") for d, t, s in pairs]


LONG = "the quick brown fox jumps over a lazy dog " * 4000
ODD = [(1, None, "a"), (2, "", "a"), (3, "   \n\t", None), (None, "Some words without an id stand here.", "b"), (4, LONG, "a"), (5, "Same text", "b"), (6, "same TEXT", "b"), (6, "same TEXT", "b"), (7, "é" * 300, "c"), (8, "!!! 123", None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(*ODD), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(DOCS)


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


# quality rules


def brute_repeats(ws, least):
    n = len(ws)
    longest, cover = 0, set()
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and ws[i + k] == ws[j + k]:
                k += 1
            best = max(best, k)
        if best >= least:
            longest = max(longest, best)
            cover.update(range(i, i + best))
    return len(cover), longest


def base_figures(t):
    ws = words(t)
    seen = defaultdict(list)
    for i in range(len(ws) - 2):
        seen[tuple(ws[i : i + 3])].append(i)
    twice = {k for at in seen.values() if len(at) > 1 for i in at for k in range(i, i + 3)}
    lines = [x for x in (t or "").split("\n") if words(x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(twice)


def test_quality_figures(docs, texts):
    got = {r["doc_id"]: r for r in quality_rules.quality(docs).collect()}
    assert len(got) == len(texts)
    for d, t in texts.items():
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base_figures(t)
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        if r["n_words"] < 150:
            assert (r["covered_words"], r["longest_repeat"]) == brute_repeats(words(t), quality_rules.MIN_REPEAT)
        good = r["covered_words"] <= 0.2 * r["n_words"] and r["longest_repeat"] <= 50
        assert r["kept"] == (not r["base_failed"] and good)


def test_quality_repeats_random():
    rng = np.random.default_rng(0)
    for least in (2, 4):
        ws = [[f"w{i}" for i in rng.integers(0, 3, rng.integers(0, 40))] for _ in range(50)]
        got = quality_rules.measure([" ".join(w) for w in ws], least)
        assert [(int(a), int(b)) for a, b in zip(got["covered_words"], got["longest_repeat"])] == [brute_repeats(w, least) for w in ws]


def test_quality_odd(odd, empty):
    got = quality_rules.quality(odd).collect()
    assert len(got) == len(ODD) and not any(r["kept"] for r in got if r["doc_id"] in (1, 2, 3, 4))
    assert quality_rules.quality(empty).count() == 0


# language


def test_language(docs):
    got = {r["doc_id"]: r for r in language_id.predict(docs, language_id.learn(docs), "doc_id", "text", language_id.held_out("doc_id").alias("held_out")).collect()}
    true = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [d for d in true if zlib.crc32(str(d).encode()) % 4 == 2]
    assert {d for d, r in got.items() if r["held_out"]} == set(held)
    assert np.mean([got[d]["lang_pred"] == true[d] for d in held]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_odd(odd, empty):
    model = language_id.train(["the cat and the dog " * 5, "der Hund und die Katze " * 5], ["en", "de"], steps=30)
    got = language_id.predict(odd, model).collect()
    assert len(got) == len(ODD)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3, 8)} == {"und"}
    assert len(model.positions("the cat")) == 7
    assert {r["lang_pred"] for r in language_id.predict(odd, None).collect()} == {"und"}
    assert language_id.predict(empty, language_id.learn(empty)).count() == 0
    assert language_id.reject_unknown(odd).columns == odd.columns
    assert language_id.reject_unknown(empty).count() == 0


def test_language_probabilities_by_brute_force():
    """The network's answer for a few texts, byte by byte in plain loops."""
    model = language_id.train(["the cat and the dog " * 5, "der Hund und die Katze " * 5], ["en", "de"], steps=30)
    t1, u1, t2, u2, w, b = (p.astype(float) for p in model.params)
    n = u1.shape[1]
    sigmoid = lambda v: (np.tanh(v) + 1) / 2

    def states(table, u, bytes_):
        h, out = np.zeros(n), []
        for x in bytes_:
            a, g = u @ h, table[:, x]
            z, r = sigmoid(g[:n] + a[:n]), sigmoid(g[n : 2 * n] + a[n : 2 * n])
            cand = np.tanh(g[2 * n :] + r * a[2 * n :])
            h = cand + z * (h - cand)
            out.append(h)
        return out

    texts = ["the", "die Katze ist kein Hund, und der Hund ist keine Katze, so ist es; dies ist ein langer Satz", "a" * 64]
    got = model.documents([t.encode() for t in texts])
    for t, p in zip(texts, got):
        raw, total = t.encode(), np.zeros(2)
        size = language_id.WINDOW
        for k in range(max(1, -(-len(raw) // size))):
            first = max(0, min(k * size, len(raw) - size))
            piece = raw[first : first + size].ljust(size)
            forth, back = states(t1, u1, piece), states(t2, u2, piece[::-1])[::-1]
            for i in range(min(size, len(raw))):
                e = np.exp(w @ np.r_[forth[i], back[i]] + b)
                total += e / e.sum()
        assert p == pytest.approx(total / total.sum(), abs=1e-4)


def test_language_gradients():
    rng = np.random.default_rng(1)
    n, x = 3, rng.integers(0, 5, (6, 4))
    table, u = rng.standard_normal((3 * n, 256)) * 0.5, rng.standard_normal((3 * n, n)) * 0.5
    weight = rng.standard_normal((6, n, 4))
    keep = []
    language_id.gru(table.astype(np.float32), u.astype(np.float32), x, keep)
    dtable, du = language_id.backward(u, x, keep, weight.astype(np.float32))
    loss = lambda t, v: float((language_id.gru(t.astype(np.float32), v.astype(np.float32), x) * weight).sum())
    for i, j in ((0, 1), (4, 2), (7, 0)):
        for grad, k, pair in ((du, 1, (table, u)), (dtable, 0, (table, u))):
            up, down = [p.copy() for p in pair], [p.copy() for p in pair]
            col = j if k else x[0, j]
            up[k][i, col] += 1e-2
            down[k][i, col] -= 1e-2
            assert abs((loss(*up) - loss(*down)) / 2e-2 - grad[i, col]) < 2e-2


# token files


def test_token_files(spark, docs, texts, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(docs, f"{tmp_path}/t", path)
    got = sorted(token_files.read_token_files(spark, f"{tmp_path}/t").collect())
    tok, start = Tokenizer.from_file(path), 0
    for r, (d, t) in zip(got, sorted(texts.items()), strict=True):
        ids = tok.encode(t, add_special_tokens=False).ids + [1]
        assert r == (d, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)


def test_token_files_odd(spark, odd, empty, tmp_path):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    for name, df, blocks in (("o", odd, 1 << 20), ("small", odd, 50), ("e", empty, 50)):
        token_files.write_token_files(df, f"{tmp_path}/{name}", path, block_tokens=blocks)
        got = token_files.read_token_files(spark, f"{tmp_path}/{name}").orderBy("start").collect()
        assert len(got) == df.count()
        assert [r["doc_id"] for r in got] == sorted([r["doc_id"] for r in got], key=lambda d: (d is not None, d or 0))
        assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))
        assert all(r["n_tokens"] == 1 for r in got if r["doc_id"] in (1, 2))


def test_elias_fano():
    rng = np.random.default_rng(2)
    for n, top in ((1, 1), (5, 3), (1000, 10), (1000, 10**9), (300, 300)):
        values = np.sort(rng.integers(0, top, n)).astype(np.uint64)
        packed = token_files.EliasFano.encode(values).pack()
        back, end = token_files.EliasFano.unpack(memoryview(packed), 0)
        assert end == len(packed) and (back.selected(0, n) == values.astype(np.int64)).all()
        a, b = n // 3, n - n // 5
        assert (back.selected(a, b) == values[a:b].astype(np.int64)).all()
        assert [back.select(i) for i in range(n)] == values.tolist()
    assert len(token_files.EliasFano.encode(np.arange(100_000, dtype=np.uint64) * 400).pack()) < 100_000 * 12 / 8


# language-model scores


def test_lm_scores(docs, texts):
    got = {r["doc_id"]: r for r in lm_scoring.lm_scores(docs).collect()}
    tokens = lm_scoring.hashed(list(texts.values()))
    counts = np.bincount(np.concatenate(tokens), minlength=lm_scoring.VOCAB) + 0.5
    plain = (np.log(counts / counts.sum()) * (counts - 0.5)).sum()
    assert {d: r["n_tokens"] for d, r in got.items()} == {d: len(words(t)) for d, t in texts.items()}
    assert sum(r["log_prob"] for r in got.values()) > plain  # both sides tell more than none


def test_lm_scores_are_conditional_probabilities():
    rng = np.random.default_rng(3)
    net = lm_scoring.Network.new(rng.integers(0, 50, lm_scoring.VOCAB).astype(float))
    doc = rng.integers(0, lm_scoring.VOCAB, 5).astype(np.uint16)
    flat, places = lm_scoring.padded([doc])
    total = 0.0
    for p in places:
        h = np.tanh(sum(net.embed[flat[p + o - lm_scoring.REACH]] @ net.mix[k] for k, o in enumerate(lm_scoring.OFFSETS)))
        logits = h @ net.out[:-1] + net.out[-1]
        logs = logits - np.log(np.exp(logits).sum())
        total += logs[net.classes[flat[p]]] + net.within[flat[p]]
        every = np.exp(logs[net.classes] + net.within)
        assert abs(every.sum() - 1) < 1e-3
    assert abs(net.scores([doc])[0] - total) < 1e-3


def test_lm_training_helps():
    rng = np.random.default_rng(4)
    doc = np.tile(np.arange(20, dtype=np.uint16), 200)
    net = lm_scoring.Network.new(np.bincount(doc, minlength=lm_scoring.VOCAB).astype(float))
    before = net.scores([doc])[0]
    flat, places = lm_scoring.padded([doc])
    for _ in range(30):
        net.train(flat, places, rng)
    assert net.scores([doc])[0] > before / 2


def test_lm_trains_on_every_place(docs):
    tokens = lm_scoring.tokenized(docs.coalesce(1), "doc_id", "text")
    net = lm_scoring.fit(tokens, warm_up=0)
    held = [np.frombuffer(r["tokens"], "<u2") for r in tokens.collect()]
    want = lm_scoring.Network.new(lm_scoring.bucket_counts(tokens))
    order = np.argsort([r["h"] for r in tokens.select("h").collect()], kind="stable")
    flat, places = lm_scoring.padded([held[i] for i in order if len(held[i])])
    want.train(flat, places, np.random.default_rng([0, 0]))
    assert np.allclose(net.weights(), want.weights(), atol=5e-3)


def test_lm_does_not_depend_on_partitions(docs):
    got = [{r["doc_id"]: r["log_prob"] for r in lm_scoring.lm_scores(docs.repartition(n), block=20_000).collect()} for n in (1, 7)]
    assert got[0] == pytest.approx(got[1], rel=1e-6)


def test_lm_scores_by_brute_force(docs, texts):
    """The trained network's scores, token by token in plain loops."""
    net = lm_scoring.fit(lm_scoring.tokenized(docs, "doc_id", "text"))
    got = {r["doc_id"]: r["log_prob"] for r in lm_scoring.lm_scores(docs).collect()}
    for d in sorted(texts)[:12]:
        (tokens,) = lm_scoring.hashed([texts[d]])
        total = 0.0
        for i in range(min(len(tokens), 300)) if len(tokens) <= 300 else ():
            h = np.zeros(lm_scoring.HIDDEN)
            for k, o in enumerate(lm_scoring.OFFSETS):
                j = i + o - lm_scoring.REACH
                h += net.embed[tokens[j] if 0 <= j < len(tokens) else lm_scoring.PAD].astype(float) @ net.mix[k]
            logits = np.tanh(h) @ net.out[:-1] + net.out[-1]
            total += logits[net.classes[tokens[i]]] - np.log(np.exp(logits).sum()) + net.within[tokens[i]]
        if len(tokens) <= 300:
            assert got[d] == pytest.approx(total, rel=1e-4, abs=1e-3)


def test_lm_hot_row(spark):
    """Repeated rows, of which the start takes one, and a long text."""
    df = spark.createDataFrame(rows(*[(1, "the same row again and again", "a")] * 400, (2, "long text " * 50_000, "a"), (3, "another", "b")), SCHEMA)
    got = lm_scoring.lm_scores(df, warm_up=500, block=1000).collect()
    assert len(got) == 402 and len({r["log_prob"] for r in got}) == 3


def test_lm_odd(odd, empty):
    got = lm_scoring.lm_scores(odd).collect()
    assert len(got) == len(ODD)
    assert all(r["log_prob"] == 0 and r["mean_log_prob"] is None for r in got if r["n_tokens"] == 0)
    assert lm_scoring.lm_scores(empty).count() == 0


# sharding


def test_sharding(docs, texts):
    got = sharding.shard(docs).collect()
    size = {d: len(t.encode()) + 8 for d, t in texts.items()}
    loads, slots, of_text = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["law"] == "bytes" and r["grown_shard"] is None
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        of_text[texts[r["doc_id"]]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(loads) <= set(range(24))
    assert max(loads.values()) <= sum(size.values()) / 24 + 2 * max(size.values())


def test_sharding_hot_text(spark):
    many = [(i, "one and the same text " * 5, "a") for i in range(3000)] + [(10_000 + i, f"text {i} " * 12, "b") for i in range(3000)]
    got = sharding.shard(spark.createDataFrame(rows(*many), SCHEMA), shards=8).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert len(got) == 8 and max(r["b"] for r in got) < 1.1 * min(r["b"] for r in got)


@pytest.mark.parametrize("ranges", [None, 7, 300])
def test_sharding_is_the_order_cut_evenly(spark, ranges):
    """Every record's shard by brute force; groups of equal texts that fit stay together, however many boundaries
    fall on them."""
    rng = random.Random(9)
    made = [(i, f"text {i % 700} " * rng.choice((1, 3, 40)), "a") for i in range(3000)] + [(5000 + i, "large group " * 10, "a") for i in range(900)] + [(7000 + i, "fitting group " * 10, "b") for i in range(12)]
    df = spark.createDataFrame(rows(*made), SCHEMA)
    shards = 6
    keys = {r["doc_id"]: r["h"] for r in df.select("doc_id", F.xxhash64("text").alias("h")).collect()}
    text = {d: t for d, t, _ in made}
    order = sorted(text, key=lambda d: (keys[d], d))
    size, group = {d: len(text[d].encode()) + 8 for d in text}, defaultdict(int)
    for d in text:
        group[keys[d]] += size[d]
    total, at, want, start = sum(size.values()), 0, {}, {}
    for d in order:
        start.setdefault(keys[d], at)
        large = group[keys[d]] > total // (shards * sharding.SPLIT)
        want[d] = min(shards - 1, int((at if large else start[keys[d]] + group[keys[d]] // 2) * shards / total))
        at += size[d]
    got = {r["doc_id"]: r for r in sharding.shard(df, shards=shards, ranges=ranges).collect()}
    assert {d: r["shard"] for d, r in got.items()} == want
    assert len({want[7000 + i] for i in range(12)}) == 1 and len({want[5000 + i] for i in range(900)}) > 1
    for s in range(shards):
        assert [got[d]["slot"] for d in order if want[d] == s] == list(range(sum(v == s for v in want.values())))


def test_sharding_odd(odd, empty):
    got = sharding.shard(odd).collect()
    assert len(got) == len(ODD)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(empty).count() == 0


# suffix-array dedup


def brute_removed(docs, length):
    first = {}
    for d, b in docs:
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            first[s] = min(first.get(s, d), d)
    out = []
    for d, b in docs:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return sorted(out)


def removed(df, **options):
    return sorted(tuple(r) for r in suffix_dedup.removals(df, **options).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


def test_suffix_dedup(docs, texts):
    assert removed(docs) == brute_removed([(d, t.encode()) for d, t in texts.items()], 50)


def test_suffix_dedup_shared_passages(spark):
    rng = np.random.default_rng(5)
    passages = ["".join(chr(97 + c) for c in rng.integers(0, 4, rng.integers(30, 90))) for _ in range(6)] + ["a" * 120, "ab" * 50]
    made = [(int(d), "".join(passages[k] for k in rng.integers(0, 8, rng.integers(0, 5))) + "é\0x", "s") for d in rng.permutation(80)]
    df = spark.createDataFrame(rows(*made), SCHEMA).repartition(5)
    for length in (26, 50):
        assert removed(df, length=length, chunk_rows=7) == brute_removed([(d, t.encode()) for d, t, _ in made], length)


def test_suffix_dedup_odd(odd, empty):
    got = {r["doc_id"]: r for r in suffix_dedup.removals(odd).collect()}
    assert got[4]["n_removed"] == 0 and got[1]["n_bytes"] == 0 and bytes(got[7]["kept"]).decode() == "é" * 300
    assert suffix_dedup.removals(odd).count() == len(ODD)
    assert suffix_dedup.removals(empty).count() == 0


def test_suffix_dedup_crowds(spark):
    """Many copies of one text over many chunks, a passage in every chunk, and a text as large as many chunks."""
    rng = random.Random(4)
    passage = "this passage is in very many of the documents of the table, word by word and sign by sign. "
    made = [(i, "one text that occurs again and again in the table, always the same one", "a") for i in range(0, 300, 2)]
    made += [(i, "".join(rng.choice("abc ") for _ in range(60)) + passage + str(i), "a") for i in range(1, 300, 2)]
    made += [(1000, " ".join(str(rng.randrange(10**9)) for _ in range(30_000)) + passage, "a")]
    df = spark.createDataFrame(rows(*made), SCHEMA).repartition(5)
    assert removed(df, chunk_rows=40) == brute_removed([(d, t.encode()) for d, t, _ in made], 50)


def test_suffix_dedup_ties(spark):
    text = "x" * 10 + "one passage that is longer than fifty bytes for certain, yes" * 2
    same = spark.createDataFrame(rows((5, text, "a"), (5, text, "a"), (9, text, "a"), (None, text, "a"), (None, text, "a")), SCHEMA)
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in suffix_dedup.removals(same).collect())
    assert got == [("5", 0), ("5", 0), ("9", len(text)), ("None", len(text)), ("None", len(text))]


def test_collection_is_the_sorted_suffixes():
    rng = np.random.default_rng(6)
    strings = [bytes(rng.integers(97, 100, rng.integers(1, 20)).astype(np.uint8)) for _ in range(30)]
    text, ends = np.frombuffer(b"".join(strings), np.uint8), np.cumsum([len(s) for s in strings])
    built = suffix_dedup.Collection(text, ends).build()
    symbols, common = built.read()
    places = built.places()[len(strings) :]
    owner = np.searchsorted(ends, places, "right")
    suffixes = [bytes(text[p : ends[o]]) for p, o in zip(places, owner)]
    assert suffixes == sorted(suffixes) and len(suffixes) == len(text)
    shared = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert common[len(strings) + 1 :].tolist() == [shared(a, b) for a, b in zip(suffixes, suffixes[1:])]
    before = [0 if p == (0 if o == 0 else ends[o - 1]) else text[p - 1] + 1 for p, o in zip(places, owner)]
    assert symbols[len(strings) :].tolist() == before


# exact dedup


def lower_az(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def test_exact_dedup(docs, texts):
    groups = defaultdict(list)
    for d, t in texts.items():
        groups[lower_az(t)].append(d)
    got = {r["doc_id"]: r for r in exact_dedup.exact_groups(docs).collect()}
    for t, ids in groups.items():
        for d in ids:
            r = got[d]
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (max(ids), len(ids), d == max(ids), hashlib.sha256(t.encode()).hexdigest())
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {max(ids) for ids in groups.values()}


def test_exact_dedup_odd(odd, empty):
    got = exact_dedup.exact_groups(odd).collect()
    assert len(got) == len(ODD)
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert [r["keep_id"] for r in by[1] + by[2]] == [2, 2] and by[5][0]["keep_id"] == 6 and by[5][0]["group_size"] == 3
    assert sum(r["kept"] for r in by[6]) == 1
    assert exact_dedup.exact_dedup(odd).count() == 7
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_chunks(spark):
    pattern = re.compile(exact_dedup.chunk_pattern(4, 9).replace(r"\z", r"\Z"))
    for t in ("", "a", "abc. def! ghi", "x" * 50, "a\nb\nc\nd\ne. "):
        assert "".join(pattern.findall(t)) == t
    clash = spark.createDataFrame(rows((1, "aaaa.bbbb.", "s"), (2, "bbbb.aaaa.", "s"), (3, "aaaa.BBBB.", "s")), SCHEMA)
    got = {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_groups(clash, chunk_min=4, chunk_max=9).collect()}
    assert got == {1: 3, 2: 2, 3: 3}


# mixing


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s] + 1e-9}
        if not over:
            return share | {s: most * sizes[s] for s in capped}
        capped |= over


def test_mixing(docs, texts):
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sizes = defaultdict(int)
    for d, t in texts.items():
        sizes[source[d]] += len(words(t))
    want = brute_targets(sizes)
    got = mixing.mix(docs).collect()
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == len(words(texts[r["doc_id"]])) and r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    longest = max(len(words(t)) for t in texts.values())
    assert all(abs(taken[s] - want[s]) <= longest for s in want)
    again = sorted((r["doc_id"], r["taken"]) for r in mixing.mix(docs.repartition(7)).collect())
    assert again == sorted((r["doc_id"], r["taken"]) for r in got)
    assert sum(len(words(r["text"])) for r in mixing.mixed(docs).collect()) == sum(taken.values())


def test_mixing_prefers_weight(spark):
    many = spark.createDataFrame(rows(*[(i, "w " * 10, "a") for i in range(500)], *[(1000 + i, "w " * 10, "b") for i in range(500)]), SCHEMA)
    heavy = F.when(F.col("doc_id") % 2 == 0, 20.0).otherwise(1.0)
    got = mixing.mix(many, weight=heavy).where("doc_id >= 1000 AND copies > 0").collect()
    assert sum(r["doc_id"] % 2 == 0 for r in got) > 0.8 * min(len(got), 250)


@pytest.mark.parametrize("weight", [0.001, 1.0, 50.0])
def test_mixing_whole(spark, weight):
    """The documents taken, by brute force: keys in order until the sizes reach the rest; in many ranges, of near
    equal size whatever the weights."""
    rng = random.Random(5)
    texts = {i: "w " * rng.randrange(1, 40) for i in range(3000)}
    df = spark.createDataFrame(rows(*[(i, t, "ab"[i % 7 == 0]) for i, t in texts.items()]), SCHEMA)
    got = {r["doc_id"]: r for r in mixing.mix(df, weight=F.lit(weight), range_rows=100).collect()}
    key = {r["doc_id"]: r["k"] for r in df.select("doc_id", (-F.log(unit_hash(F.col("doc_id"), F.xxhash64("text"), F.lit(8))) / weight).alias("k")).collect()}
    for s in (0, 1):
        ids = sorted((i for i in texts if (i % 7 == 0) == s), key=lambda i: (key[i], i))
        size = {i: len(words(texts[i])) for i in ids}
        target, whole, upto = got[ids[0]]["target"], sum(size.values()), 0
        for i in ids:
            upto += size[i]
            epochs = int(target // whole)
            assert got[i]["copies"] == epochs + (epochs < 3 and upto - size[i] / 2 <= target - epochs * whole)
    keyed = df.select(F.col("doc_id").alias("id"), (-F.log(unit_hash(F.col("doc_id"), F.lit(8))) / weight).alias("key"))
    assert keyed and max(r["count"] for r in mixing._ranged(keyed, 100).groupBy("bucket").count().collect()) < 400


def test_mixing_repeated_rows(spark):
    """Rows with equal ids and texts get as many copies in all as the mix takes of them."""
    df = spark.createDataFrame(rows(*[(i % 40, "w " * (1 + i % 40), "a") for i in range(200)], *[(1000 + i, "v " * 30, "b") for i in range(400)]), SCHEMA)
    taken = {s: sum(r["taken"] for r in mixing.mix(df).collect() if r["group"] == s) for s in "ab"}
    mixed = mixing.mixed(df).collect()
    assert {s: sum(len(words(r["text"])) for r in mixed if r["source"] == s) for s in "ab"} == taken


def test_mixing_odd(odd, empty):
    got = mixing.mix(odd).collect()
    assert len(got) == len(ODD) and all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


# SentencePiece


def library():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    return path, sentencepiece.SentencePieceProcessor(model_file=path)


@pytest.mark.parametrize("cached", [0, 200_000])
def test_pieces(docs, texts, cached):
    path, sp = library()
    got = sentencepieces.decode(sentencepieces.encode(docs, path, cached=cached), path).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r["doc_id"]]
        assert r["ids"] == sp.encode(t) and r["n_tokens"] == len(r["ids"]) and r["text"] == t
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())


def test_pieces_odd(spark, odd, empty):
    path, sp = library()
    hard = ["  two  spaces ", "a▁b ▁ c", "tab\tand\nline\r\n", "日本語 テキスト", "𝔘🙂 emoji", "x" * 700, "  ", "é́ ﬁ", "\0 nul", "." * 300 + " a"]
    made = spark.createDataFrame(rows(*[(i, t, "s") for i, t in enumerate(hard)]), SCHEMA)
    got = {r["doc_id"]: (r["ids"], r["text"]) for r in sentencepieces.decode(sentencepieces.encode(made, path), path).collect()}
    for i, t in enumerate(hard):
        assert got[i][0] == sp.encode(t) and got[i][1] == sp.decode(sp.encode(t))
    assert sentencepieces.encode(odd, path).count() == len(ODD)
    assert sentencepieces.encode(empty, path).count() == 0


def test_pieces_viterbi(spark):
    pieces = {"▁": -5.0, "▁a": -2.0, "b": -3.0, "ab": -1.5, "▁ab": -4.5, "a": -3.0, "bb": -2.5, "c": -6.0, "abb": -3.8}
    model = sentencepieces.Model(("<unk>", *pieces), (0.0, *pieces.values()), (False, *[True] * len(pieces)), None, 0, False)
    units = ["▁abb", "▁aab", "c", "▁bbabc", "▁axb", "b"]
    df = spark.createDataFrame([(u, 0, 0) for u in units], "unit string, part int, places int")
    got = {r["unit"]: sentencepieces.unpacked(bytes(r["ids"]), 2).tolist() for r in sentencepieces.encode_units(df, model).collect()}

    def score(u):
        best = {0: (0.0, [])}
        for e in range(1, len(u) + 1):
            ways = [(best[s][0] + pieces[u[s:e]], best[s][1] + [model.pieces.index(u[s:e])]) for s in range(e) if u[s:e] in pieces]
            ways += [(best[e - 1][0] + min(pieces.values()) - 10, best[e - 1][1] + [0])]
            best[e] = max(ways, key=lambda w: w[0])
        return best[len(u)][1]

    assert got == {u: score(u) for u in units}
    ranks = {p: (0, i) for i, p in enumerate(model.pieces) if i}
    assert all(sentencepieces.best_path(u, ranks, model, lambda x: [0]) == score(u) for u in units)


def test_pieces_equal_scores(spark):
    """Of paths with equal scores the fold and the loop for long units take the same, as the library does."""
    pieces = {"a": -1.0, "aa": -2.0, "aaa": -3.0, "b": -1.0, "ab": -2.0, "ba": -2.0}
    model = sentencepieces.Model(("<unk>", *pieces), (0.0, *pieces.values()), (False, *[True] * len(pieces)), None, 0, False)
    units = ["a" * n for n in range(1, 9)] + ["ab" * n for n in range(1, 5)] + ["b" * 70 + "a" * 120]
    df = spark.createDataFrame([(u, 0, 0) for u in units], "unit string, part int, places int")
    ranks = model.ranks()
    for r in sentencepieces.encode_units(df, model).collect():
        assert sentencepieces.unpacked(bytes(r["ids"]), 2).tolist() == sentencepieces.best_path(r["unit"], ranks, model, lambda x: [0])
    assert sentencepieces.best_path("aaa", ranks, model, lambda x: [0]) == [model.pieces.index("aaa")]


def test_pieces_merges_in_any_order(spark):
    """Random BPE tables, in which a merge may make a pair that ranks before it, against the heap."""
    rng = random.Random(3)
    for seed in range(6):
        pieces = ["a", "b", "c"] + list({"".join(rng.choice("abc") for _ in range(rng.randrange(2, 6))) for _ in range(60)})
        model = sentencepieces.Model(("<unk>", *pieces), (0.0, *[-float(i) for i in rng.sample(range(len(pieces)), len(pieces))]), (False, *[True] * len(pieces)), None, 0, True)
        units = list({"".join(rng.choice("abcd") for _ in range(rng.choice((1, 2, 5, 12, 61, 62, 90, 250)))) for _ in range(60)})
        df = spark.createDataFrame([(u, 0, 0) for u in units], "unit string, part int, places int")
        got = {r["unit"]: sentencepieces.unpacked(bytes(r["ids"]), 2).tolist() for r in sentencepieces.encode_units(df, model).collect()}
        assert got == {u: sentencepieces.merge(u, model.ranks(), lambda x: [0]) for u in units}


def test_pieces_by_viterbi(spark, docs, texts):
    """Whole texts cut by the fold, against a loop over their units, which finds the best sum of scores."""
    model = sentencepieces.by_rank(sentencepieces.load_model(library()[0]))
    ranks, spell, done = model.ranks(), lambda x: [b + model.bytes_at for b in x.encode()], {}
    for r in sentencepieces.encode(docs.limit(40), model, cached=500, decoded=True).collect():
        units = model.units.findall(sentencepieces.marked(texts[r["doc_id"]]))
        for u in units:
            if u not in done:
                done[u] = sentencepieces.best_path(u, ranks, model, spell)
        assert r["ids"] == [i for u in units for i in done[u]] and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())


def test_pieces_hot_and_long_units(spark):
    path, sp = library()
    texts = [f"{'-' * 40} {'=' * 240} {'~' * 600} word{i} " + "日本語" * i for i in range(60)]
    made = spark.createDataFrame(rows(*[(i, t, "s") for i, t in enumerate(texts)]), SCHEMA)
    for cached in (0, 1000):
        got = {r["doc_id"]: r["ids"] for r in sentencepieces.encode(made, path, cached=cached, chunk_bytes=2000).collect()}
        assert got == {i: sp.encode(t) for i, t in enumerate(texts)}


def test_pieces_refuses_other_settings(tmp_path):
    path, _ = library()
    data = open(path, "rb").read()
    for field, name in ((b"\x12\x02\x18\x03", "kind"), (b"\x1a\x02\x20\x01", "white space"), (b"\x0a\x0a\x0a\x01q\x15\x00\x00\x80\xbf\x18\x04", "user-defined")):
        (tmp_path / "m.model").write_bytes(data + field)
        with pytest.raises(ValueError, match=name):
            sentencepieces.load_model(str(tmp_path / "m.model"))


# SimHash


def brute_simhash(t):
    import xxhash

    ws = words(lower_az(t))
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    parent = {d: d for d in fps}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_simhash(docs, texts):
    got = {r["doc_id"]: r for r in simhash.near_groups(docs).collect()}
    fps = {d: brute_simhash(t) for d, t in texts.items()}
    assert {d: r["fingerprint"] for d, r in got.items()} == {d: f"{f:016x}" for d, f in fps.items()}
    assert {d: r["component_id"] for d, r in got.items()} == brute_components(fps)


def test_simhash_components_random(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = {}
    for d in range(900):
        f = int(base[d % 40])
        for b in rng.integers(0, 64, rng.integers(0, 4)):
            f ^= 1 << int(b)
        fps[d] = f
    signed = [(d, f - (1 << 64) if f >> 63 else f) for d, f in fps.items()]
    df = spark.createDataFrame(signed, "id long, fp long")
    want = brute_components(fps)
    for most in (64, 2):  # few pairs a key: the other way to links
        got = {r["id"]: r["component"] for r in simhash.near_components(df, most_pairs=most).collect()}
        assert got == want


def test_golay_keys_meet():
    rng = np.random.default_rng(8)
    errors = simhash.nearby_errors()
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64))
    ka, oa = simhash.golay_keys(a, errors)
    kb, ob = simhash.golay_keys(b, errors)
    left, right = defaultdict(set), defaultdict(set)
    for k, o in zip(ka.tolist(), oa.tolist()):
        left[o].add(k)
    for k, o in zip(kb.tolist(), ob.tolist()):
        right[o].add(k)
    assert all(left[i] & right[i] for i in range(3000))


def test_simhash_odd(odd, empty):
    got = simhash.near_groups(odd).collect()
    assert len(got) == len(ODD) and {r["component_id"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    kept = simhash.near_dedup(odd)
    assert kept.columns == odd.columns and kept.count() < len(ODD)
    assert simhash.near_groups(empty).count() == 0 and simhash.near_dedup(empty).count() == 0


def shingle_set(t, n=5):
    ws = words(lower_az(t))
    return frozenset(tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1)))


def similar_components(texts):
    """As near_dedup has to find them: by all pairs' Jaccard similarity."""
    sets, ids = {d: shingle_set(t) for d, t in texts.items()}, sorted(texts)
    label = {d: d for d in ids}
    pairs = []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common / (len(sets[a]) + len(sets[b]) - common) >= 0.8 - 1e-9:
                pairs.append((a, b))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label, pairs


def altered(rng, ws, spots):
    out = list(ws)
    for at in spots:
        out[at] = f"new{rng.integers(1 << 40)}"
    return " ".join(out)


def test_near_dedup_is_jaccard(spark, texts):
    rng = np.random.default_rng(12)
    mine = dict(texts)
    for k in range(60):  # one changed word of 200, and as many as leave about 0.8
        base = [f"w{rng.integers(3000)}" for _ in range(200)]
        mine[10_000 + 3 * k] = " ".join(base)
        mine[10_001 + 3 * k] = altered(rng, base, [100])
        mine[10_002 + 3 * k] = altered(rng, base, [30, 70, 110, 190])
    df = spark.createDataFrame(list(mine.items()), "doc_id long, text string")
    label, pairs = similar_components(mine)
    kept = {r["doc_id"] for r in simhash.near_dedup(df).collect()}
    want = set(label.values())
    assert want <= kept  # no text goes without a similar one
    assert len(kept - want) <= 0.01 * (len(mine) - len(want)), (len(kept), len(want))
    assert not any({a, b} <= kept for a, b in pairs if 10_000 <= a and b == a + 1 and a % 3 == 1)  # 10_000 is 1 mod 3


def test_near_dedup_many_copies(spark):
    """A crowd of near copies of several texts that share a passage, and chains within it."""
    rng = np.random.default_rng(13)
    shared, mine = [f"s{i}" for i in range(60)], {}
    for k in range(4):
        base = shared + [f"b{k}_{i}" for i in range(60)]
        for i in range(80):
            mine[k * 100 + i] = altered(rng, base, rng.choice(120, 1))
            base = mine[k * 100 + i].split() if i % 20 == 0 else base
    df = spark.createDataFrame(list(mine.items()), "doc_id long, text string")
    want = set(similar_components(mine)[0].values())
    kept = {r["doc_id"] for r in simhash.near_dedup(df).collect()}
    assert kept == want
