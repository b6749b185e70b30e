"""SimHash near-dedup with Golay-code fuzzy hashing.

The 64 bits of a fingerprint are three segments of 22, 21 and 21 bits, each padded
to a 23-bit word of the binary Golay code. The code is perfect: every word lies
within 3 bits of one codeword; a word at distance 3 lies at distance 4 from five more.
Words at most 2 bits apart always share one of these one or six codewords.

Two fingerprints at most 2 bits apart have a segment without an error, and another
with at most one, so they share a key (position of both segments, the first
segment's bits, a codeword of the second). Fingerprints that share a key are compared
and linked if they differ in 2 bits or fewer. Where more than PAIRS fingerprints share
a key, no pairs are made: each of these writes down the 65 points within 1 bit of it;
fingerprints are within 2 bits of each other exactly when they share such a point, and all
that share one are linked to the least of them. A point has at most 65 such
fingerprints, so no group grows with the data.

Everything runs on distinct fingerprints, so copies count once. Components are found
by passing the least label along links and then along labels, a table in the shared folder a round.

near_dedup, the pipeline's stage, is wider: see similar_rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bucketed, c, documents, id_keys, kept_once, lower_az, slices, stash

#: Generator polynomial of the [23, 12, 7] Golay code.
GENERATOR, LENGTH, CHECKS = 0b101011100011, 23, 11
SEGMENTS = ((0, 22), (22, 21), (43, 21))
SHINGLE, SEED, BITS, PAIRS = 3, 42, 2, 64
#: similar_rows: standard deviations of differing SimHash bits that are let pass, and the most rows and shingles of a block.
SIGMAS, BLOCK_ROWS, BLOCK_SHINGLES = 6, 2048, 4_000_000
MOST_SEEN = 200_000


def syndrome(words: np.ndarray) -> np.ndarray:
    """The remainders of 23-bit words on division by the generator."""
    left = words.astype(np.int64).copy()
    for i in range(LENGTH - 1, CHECKS - 1, -1):
        left ^= ((left >> i) & 1) * (GENERATOR << (i - CHECKS))
    return left


def nearby_errors() -> np.ndarray:
    """For each syndrome, the differences to the nearby codewords: the one of at most 3
    bits, and if it has 3, the five of 4 bits; -1 fills up."""
    bits = 1 << np.arange(LENGTH)
    by_weight = [np.zeros(1, dtype=np.int64)]
    for _ in range(4):
        last = by_weight[-1]
        by_weight.append(np.unique((last[:, None] | bits)[(last[:, None] & bits) == 0]))
    out, filled = np.full((1 << CHECKS, 6), -1, dtype=np.int64), np.zeros(1 << CHECKS, dtype=np.int64)
    for weight, errors in enumerate(by_weight):
        for s, e in zip(syndrome(errors).tolist(), errors.tolist()):
            if weight < 4 or filled[s] and out[s, 0].bit_count() == 3:
                out[s, filled[s]] = e
                filled[s] += 1
    return out


def golay_indices(words: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """(n, 6) indices of the codewords near each word: their 12 leading bits, -1 fills up."""
    near = errors[syndrome(words)]
    return np.where(near < 0, -1, (words[:, None].astype(np.int64) ^ near) >> CHECKS)


def golay_keys(prints: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints (uint64), and the index of the fingerprint of each key."""
    parts = [((prints >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    near = [golay_indices(p, errors) for p in parts]
    keys, owners = [], []
    for i, exact in enumerate(parts):
        for j in range(3):
            if i != j:
                owner, slot = np.nonzero(near[j] >= 0)
                keys.append(((3 * i + j) << 40) | (exact[owner] << 12) | near[j][owner, slot])
                owners.append(owner)
    return np.concatenate(keys), np.concatenate(owners)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a normalised text: over the hashes of its word shingles, the bits that
    more than half have. Fewer words make one shingle, no words fingerprint 0."""
    words = text.split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(flat[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64, len(starts))
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """id and fp (the fingerprint as a signed long) of each row, and what more asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_buffer().to_pybytes()) for t in batch.column("norm").cast(pa.large_string())], dtype=np.uint64).view(np.int64)
            kept = [x for x in batch.schema.names if x != "norm"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(fps, pa.int64())], [*kept, "fp"])

    rows = df.select(c(id_col).alias("id"), *more, lower_az(F.coalesce(c(text_col), F.lit(""))).alias("norm"))
    schema = T.StructType([*(x for x in rows.schema if x.name != "norm"), T.StructField("fp", T.LongType())])
    return rows.mapInArrow(run, schema)


def _keyed(distinct: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        errors = nearby_errors()
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            keys, owners = golay_keys(fps.view(np.uint64), errors)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[owners])], ["key", "fp"])

    return distinct.mapInArrow(run, "key long, fp long")


def _linked(keyed: DataFrame, most_bits: int, most_pairs: int) -> DataFrame:
    """a, b of linked fingerprints, a < b; for fingerprints under a key with too many, a = b.
    The rows of a key come one after another, so only those of keys of at most
    most_pairs rows are ever held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        def pairs(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            sizes = np.diff(np.r_[starts, len(keys)])
            many = np.repeat(sizes > most_pairs, sizes)
            if many.any():
                yield out(fps[many], fps[many])
            for n in np.unique(sizes[(sizes > 1) & (sizes <= most_pairs)]).tolist():
                groups = fps[starts[sizes == n][:, None] + np.arange(n)]
                for i in range(n - 1):
                    near = np.bitwise_count((groups[:, i : i + 1] ^ groups[:, i + 1 :]).view(np.uint64)) <= most_bits
                    g, j = np.nonzero(near)
                    if len(g):
                        yield out(groups[g, i], groups[g, i + 1 + j])

        keys, fps, open_key = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            k, f = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("key", "fp"))
            if open_key is not None:  # of a key with too many rows, some went out already
                rest = np.searchsorted(k, open_key, "right")
                if rest:
                    yield out(f[:rest], f[:rest])
                if rest == len(k):
                    continue
                k, f, open_key = k[rest:], f[rest:], None
            keys, fps = np.concatenate([keys, k]), np.concatenate([fps, f])
            if not len(keys):
                continue
            last = np.searchsorted(keys, keys[-1], "left")
            yield from pairs(keys[:last], fps[:last]) if last else ()
            keys, fps = keys[last:], fps[last:]
            if len(keys) > most_pairs:
                yield out(fps, fps)
                open_key, keys, fps = keys[-1], keys[:0], fps[:0]
        if len(keys):
            yield from pairs(keys, fps)

    spread = keyed.repartition("key").sortWithinPartitions("key")
    return spread.mapInArrow(run, "a long, b long").distinct()


def _by_points(crowded: DataFrame) -> DataFrame:
    """Links of fingerprints with many neighbours, by the points within one bit."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in range(64)])
    points = crowded.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    stars = points.groupBy("point").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return stars.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a < b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """v, label of every vertex of edges (a, b), label being the least vertex reachable.

    Vertices take the least label among their neighbours', then their label's label,
    until nothing changes. A vertex has a bounded number of links here; many vertices may
    share a label, which the join on labels can split."""
    both = stash(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stash(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        seen = both.join(labels, both["b"] == labels["v"]).groupBy("a").agg(F.min("label").alias("least"))
        own = labels.join(seen, labels["v"] == seen["a"]).select("v", F.col("label").alias("old"), F.least("label", "least").alias("mid"))
        jump = labels.select(F.col("v").alias("w"), F.col("label").alias("far"))
        new = stash(own.join(jump, own["mid"] == jump["w"]).select("v", "old", F.least("mid", "far").alias("label")), "labels")
        changed = new.where("label <> old").limit(1).count()
        labels = new.drop("old")
        if not changed:
            return labels


def near_components(rows: DataFrame, most_bits: int = BITS, most_pairs: int = PAIRS) -> DataFrame:
    """The rows (id, fp and more) with their component, the smallest id in it, and its label,
    the least fingerprint in it."""
    if most_bits > BITS:
        raise ValueError(f"keys are made for links of at most {BITS} bits")
    ids = stash(rows.groupBy("fp").agg(F.min("id").alias("least")), "prints")
    linked = stash(_linked(_keyed(ids.select("fp")), most_bits, most_pairs), "pairs")
    edges = linked.where("a < b")
    crowded = linked.where("a = b").select(F.col("a").alias("fp"))
    if crowded.limit(1).count():
        points = _by_points(crowded)
        if most_bits < BITS:
            points = points.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most_bits)
        edges = edges.union(points).distinct()
    labels = components(edges)
    both = ids.join(labels, ids["fp"] == labels["v"], "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    least = both.groupBy("label").agg(F.min("least").alias("component")).withColumnRenamed("label", "l")
    of_print = both.join(least, both["label"] == least["l"]).select(F.col("fp").alias("p"), "component", "label")
    return rows.join(of_print, rows["fp"] == of_print["p"]).drop("p")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, fingerprint (16 hex digits) and component_id of each row of df.

    A-Z count as a-z. Documents link if their fingerprints differ in 2 bits or fewer;
    component_id is the smallest id reachable over links, the document's own included. Null and
    wordless texts have fingerprint 0 and link like any other. Null ids never are a
    component's smallest while it has another. Repeated rows each give a row. Columns beyond
    these two aren't read. An empty table gives an empty one.
    """
    rows = stash(fingerprints(df, id_col, text_col), "simhash")
    found = near_components(rows)
    return found.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def mixed_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """(n, len) independent hashes of uint64 hashes."""
    x = hashes[None, :] + np.arange(1, n + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    return x ^ (x >> np.uint64(31))


def sketched(text: bytes, shingle: int, sketches: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Of a normalised text: a hash of its words, the set of its shingles' 32-bit hashes, and for each
    sketch the least hash of a shingle and a SimHash of 23 bits."""
    flat = b" ".join(text.split())
    words = flat.split()
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    of = np.unique(np.fromiter([digest(b" ".join(words[i : i + shingle]), SEED) for i in range(n)], np.uint64, n))
    least, counts = np.full(sketches, np.iinfo(np.uint64).max), np.zeros((sketches, 24), dtype=np.int64)
    for at in range(0, len(of), 1 << 14):
        x = mixed_hashes(of[at : at + (1 << 14)], sketches)
        least = np.minimum(least, x.min(axis=1))
        three = np.ascontiguousarray(x).view(np.uint8).reshape(sketches, -1, 8)[:, :, :3]
        counts += np.unpackbits(three, axis=2, bitorder="little").sum(axis=1, dtype=np.int64)
    bits = 2 * counts[:, :LENGTH] > len(of)
    return digest(flat, SEED), np.unique((of >> np.uint64(32)).astype("<u4")), least, (bits * (1 << np.arange(LENGTH))).sum(axis=1).astype(np.uint32)


def sketch_keys(least: np.ndarray, words: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of (n, sketches) least hashes and SimHashes, and the index of the row of each: a
    sketch's least hash with a codeword near its SimHash."""
    near = golay_indices(words.ravel().astype(np.int64), errors)
    owner, slot = np.nonzero(near >= 0)
    sketch = (owner % words.shape[1]).astype(np.uint64)
    key = (least.ravel()[owner] + sketch) * np.uint64(0x9E3779B97F4A7C15) ^ near[owner, slot].astype(np.uint64)
    return key.view(np.int64), owner // words.shape[1]


def _sketches(df: DataFrame, id_col: str, text_col: str, text_hash: Column, shingle: int, sketches: int) -> DataFrame:
    """id, h and d (the hash of the words) of each row; n (the number of shingles), least, simhash and shingles
    with the first row of a task that has the words, and k: d there, a hash of the row elsewhere, so that
    dealing by k brings the sets of equal texts together and no crowd of rows."""
    names = ["d", "k", "n", "least", "simhash", "shingles"]
    rows = df.select(c(id_col).alias("id"), text_hash.alias("h"), F.xxhash64(c(id_col), text_hash).alias("k"), lower_az(F.coalesce(c(text_col), F.lit(""))).alias("norm"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in slices(batch, "norm"):
                found = [sketched(t.as_buffer().to_pybytes(), shingle, sketches) for t in piece.column("norm").cast(pa.large_string())]
                d = np.array([f[0] for f in found], np.uint64).view(np.int64)
                first = []
                for x in d.tolist():
                    first.append(x not in seen)
                    if len(seen) < MOST_SEEN:
                        seen.add(x)
                k = np.where(first, d, piece.column("k").to_numpy(zero_copy_only=False))
                n = pa.array([len(f[1]) if own else None for f, own in zip(found, first)], pa.int64())
                blobs = [pa.array([f[i].tobytes() if own else None for f, own in zip(found, first)], pa.binary()) for i in (2, 3, 1)]
                yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("h"), pa.array(d), pa.array(k), n, *blobs], ["id", "h", *names])

    return rows.mapInArrow(run, T.StructType([rows.schema["id"], rows.schema["h"], *(T.StructField(x, T.LongType() if x in ("d", "k", "n") else T.BinaryType()) for x in names)]))


def _stacked(column: pa.Array, kind: type) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_buffer(), kind) for x in column])


def _meets(distinct: DataFrame) -> DataFrame:
    """key and d of the texts whose key another text has too. Only neighbours are compared, so a key's rows are
    never held together."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        errors = nearby_errors()
        for batch in batches:
            if batch.num_rows:
                keys, owners = sketch_keys(_stacked(batch.column("least"), np.uint64), _stacked(batch.column("simhash"), np.uint32), errors)
                yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("d").take(pa.array(owners))], ["key", "d"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = [np.zeros(0, np.int64)] * 2
        before = False  # whether the row held back is like the one before it
        for batch in batches:
            key, d = (np.concatenate([x, batch.column(y).to_numpy(zero_copy_only=False)]) for x, y in zip(last, ("key", "d")))
            if not len(key):
                continue
            same = key[1:] == key[:-1]
            met = np.r_[before, same[:-1]] | same if len(same) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(key[:-1][met]), pa.array(d[:-1][met])], ["key", "d"])
            before, last = bool(same[-1]) if len(same) else before, [key[-1:], d[-1:]]
        if before:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in last], ["key", "d"])

    schema = "key long, d long"
    return distinct.mapInArrow(keyed, schema).repartition("key").sortWithinPartitions("key").mapInArrow(run, schema)


def _viable(words: np.ndarray, n: np.ndarray, other_words: np.ndarray, other_n: np.ndarray, bits: int, similarity: float) -> np.ndarray:
    """Whether texts can be so similar, by their SimHashes and their numbers of shingles."""
    return (np.minimum(n, other_n) >= similarity * np.maximum(n, other_n) - 1e-9) & (np.bitwise_count(words ^ other_words).sum(axis=1, dtype=np.int64) <= bits)


def _led(meets: DataFrame, bits: int, similarity: float) -> DataFrame:
    """a, b: each row of a key with the key's leader, the row with the least hash, where they can be similar."""
    leads = meets.groupBy("key").agg(F.min_by(F.struct("d", "n", "simhash"), F.xxhash64("key", "d")).alias("o")).select("key", F.col("o.d").alias("e"), F.col("o.n").alias("m"), F.col("o.simhash").alias("lead"))
    both = meets.join(leads, "key").where("d <> e").select("d", "n", "simhash", "e", "m", "lead")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d, n, e, m = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("d", "n", "e", "m"))
                good = _viable(_stacked(batch.column("simhash"), np.uint32), n, _stacked(batch.column("lead"), np.uint32), m, bits, similarity)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(d, e)[good]), pa.array(np.maximum(d, e)[good])], ["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct()


def _sets(rows: DataFrame, ds: DataFrame) -> DataFrame:
    """d and shingles of the texts d of ds."""
    need = ds.select(F.col("d").alias("v")).distinct()
    return rows.where("n IS NOT NULL").select("k", "shingles").join(need, F.col("k") == F.col("v"), "left_semi").dropDuplicates(["k"]).withColumnRenamed("k", "d")


def _similar(pairs: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets of shingles are so similar, by Jaccard."""
    sets = _sets(rows, pairs.select(F.explode(F.array("a", "b")).alias("d")))
    x, y = (sets.select(F.col("d").alias(f"d_{k}"), F.col("shingles").alias(f"s_{k}")) for k in "ab")
    both = pairs.join(x, pairs["a"] == x["d_a"]).join(y, pairs["b"] == y["d_b"]).select("a", "b", "s_a", "s_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for s, t in zip(batch.column("s_a"), batch.column("s_b")):
                s, t = (np.frombuffer(z.as_buffer(), "<u4") for z in (s, t))
                common = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(common >= similarity * (len(s) + len(t) - common) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


UNIT = ["key", "x", "y"]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each unit, of batches sorted by unit."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = np.stack([batch.column(x).to_numpy(zero_copy_only=False) for x in UNIT])
        cuts = [0, *(np.flatnonzero((cells[:, 1:] != cells[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for first, last in zip(cuts, cuts[1:]):
            if held and any(held[-1].column(x)[-1].as_py() != v for x, v in zip(UNIT, cells[:, first].tolist())):
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(first, last - first))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _apart(meets: DataFrame, found: DataFrame, bits: int, similarity: float) -> DataFrame:
    """key, x, y, d and label of the rows that can be similar to a row of the same key with another label.

    Keys that have several labels are dealt as units: a key with more than BLOCK_ROWS rows or BLOCK_SHINGLES
    shingles is cut into blocks by hash, and every two blocks make a unit. Of the keys that
    two texts share, only the least counts."""
    labelled = meets.join(found, meets["d"] == found["v"], "left").select("key", "d", "n", "least", "simhash", F.coalesce("label", "d").alias("label"))
    keys = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("rows"), F.sum("n").alias("sum"))
    blocks = F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("sum") / BLOCK_SHINGLES)).cast("int")
    keys = keys.where("lo <> hi").select(F.col("key").alias("k"), blocks.alias("blocks"))
    dealt = labelled.join(keys, F.col("key") == F.col("k")).withColumn("own", F.expr("int(pmod(xxhash64(d), blocks))")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "d", "label", "n", "least", "simhash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        errors = nearby_errors()
        for unit in _units(batches):
            words, least = _stacked(unit.column("simhash"), np.uint32), _stacked(unit.column("least"), np.uint64)
            n, label = (unit.column(x).to_numpy() for x in ("n", "label"))
            keys, owner = sketch_keys(least, words, errors)
            order = np.lexsort((keys, owner))
            keys, owner = keys[order], owner[order]
            upto = np.searchsorted(owner, np.arange(len(n) + 1))
            table = np.full((len(n), np.diff(upto).max()), np.iinfo(np.int64).max)
            table[owner, np.arange(len(owner)) - upto[owner]] = keys
            here, marked = unit.column("key")[0].as_py(), np.zeros(len(n), bool)
            for i in range(len(n) - 1):
                those = np.arange(i + 1, len(n))
                those = those[(label[those] != label[i]) & ~(marked[i] & marked[those])]
                if len(those):
                    those = those[_viable(words[i], n[i], words[those], n[those], bits, similarity)]
                if len(those):
                    own = keys[upto[i] : upto[i + 1]]
                    earlier = table[those]
                    earlier = (own[np.minimum(np.searchsorted(own, earlier), len(own) - 1)] == earlier) & (earlier < here)
                    those = those[~earlier.any(axis=1)]
                    marked[those] = True
                    marked[i] |= len(those) > 0
            if marked.any():
                yield from unit.select([*UNIT, "d", "label"]).filter(pa.array(marked)).to_batches()

    return dealt.repartition(*UNIT).sortWithinPartitions(*UNIT, "d").mapInArrow(run, "key long, x int, y int, d long, label long")


def _joining(apart: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """a, b: labels that come together, each by two similar texts of one unit that have them."""
    sets = _sets(rows, apart)
    both = apart.join(sets.withColumnRenamed("d", "s"), F.col("d") == F.col("s")).select(*UNIT, "d", "label", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _units(batches):
            label = unit.column("label").to_numpy().copy()
            sets = [np.frombuffer(x.as_buffer(), "<u4") for x in unit.column("shingles").combine_chunks()]
            n = np.array([len(x) for x in sets])
            _, flat = np.unique(np.concatenate(sets), return_inverse=True)
            starts, has = np.r_[0, np.cumsum(n)[:-1]], np.zeros(flat.max() + 1, np.int64)
            a, b = [], []
            for i in range(len(n) - 1):
                if (label[i + 1 :] == label[i]).all():
                    continue
                own = flat[starts[i] : starts[i] + n[i]]
                has[own] = 1
                common = np.add.reduceat(has[flat[starts[i + 1] :]], starts[i + 1 :] - starts[i + 1])
                has[own] = 0
                for j in (np.flatnonzero(common >= similarity * (n[i] + n[i + 1 :] - common) - 1e-9) + i + 1).tolist():
                    if label[j] != label[i]:
                        a.append(min(label[i], label[j]))
                        b.append(max(label[i], label[j]))
                        label[label == b[-1]] = a[-1]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return both.repartition(*UNIT).sortWithinPartitions(*UNIT, "d").mapInArrow(run, "a long, b long").distinct()


def similar_rows(df: DataFrame, id_col: str, text_col: str, text_hash: Column, shingle: int = 5, similarity: float = 0.8, sketches: int = 10) -> DataFrame:
    """id, h, d and label of each row; rows reachable over links have one label.

    Texts link if their words are equal or the Jaccard similarity of their sets of word shingles (32-bit
    hashes) is at least similarity. Candidates share a sketch's least hash and a Golay codeword near its
    SimHash; each is verified by its sets. First each row of a key is compared with the key's leader,
    which settles large groups of copies in as many pairs as they have rows; where several labels are
    left under a key, the rows that differ in label are compared within the task that has the key, and
    only pairs that join labels leave it."""
    # bucketed, so that the sets, which are larger than all else here, move once
    rows = bucketed(_sketches(df, id_col, text_col, text_hash, shingle, sketches).repartition("k"), "sketches", "k")
    distinct = rows.where("n IS NOT NULL").groupBy("k").agg(*(F.first(x).alias(x) for x in ("n", "least", "simhash"))).withColumnRenamed("k", "d")
    met = _meets(distinct).withColumnRenamed("d", "m")
    meets = stash(met.join(distinct, F.col("m") == F.col("d")).select("key", "d", "n", "least", "simhash"), "meets")
    flips = np.arccos(min(1.0, 2 * similarity / (1 + similarity))) / np.pi
    bits = int(LENGTH * sketches * flips + SIGMAS * (LENGTH * sketches * flips * (1 - flips)) ** 0.5)
    links = stash(_similar(stash(_led(meets, bits, similarity), "led"), rows, similarity), "links_led")
    found = components(links)
    more = stash(_joining(stash(_apart(meets, found, bits, similarity), "apart"), rows, similarity), "links_apart")
    if more.limit(1).count():
        further = components(more).select(F.col("v").alias("was"), F.col("label").alias("now"))
        found = found.select("v", "label").union(further.select("was", "was")).groupBy("v").agg(F.min("label").alias("label"))  # texts that had no link are labels too
        found = found.join(further, F.col("label") == F.col("was"), "left").select("v", F.coalesce("now", "label").alias("label"))
    return rows.select("id", "h", "d").join(found, F.col("d") == F.col("v"), "left").select("id", "h", "d", F.coalesce("label", "d").alias("label"))


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of df that stay, with df's columns: one of each component of similar_rows (its options are
    shingle, similarity and sketches), that with the smallest id (null last), of several such
    rows one with the least text hash."""
    text_hash = F.xxhash64(F.coalesce(c(text_col), F.lit("")))
    rows = similar_rows(df, id_col, text_col, text_hash, **options)
    first = rows.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("null"), "id", "h")).alias("first"))
    return kept_once(df, [text_hash, *id_keys(c(id_col))], first.select("first.h", *id_keys(F.col("first.id"))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir))
