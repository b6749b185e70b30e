"""Language-model scoring by masked pseudo-likelihood.

A token is a word's hash among VOCAB buckets. A network reads REACH tokens on either side
of a place, never the token there, and gives the probabilities of CLASSES classes of buckets;
within its class a bucket has the probability that its count in the corpus gives it. A
document's score is the sum of the conditional log-probabilities of all its tokens.

Counts are those of all documents. The network is trained in numpy: first on the driver,
on a sample of about WARM_UP tokens, then on the executors, where every BLOCK tokens train a
copy of it on all their places, and the copies, weighted by their places, are
averaged. So the copies grow in number with the corpus. A document's block follows from its hash and a
block's order and seed from the block, so neither partitions nor retries change the result. A task
averages the copies of its own blocks; the tasks' averages, MOST_TASKS at most, are cut into PARTS and
averaged by part; the driver only gets the average, about 4 MB.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import c, documents, slices, stash, unit_hash

VOCAB, CLASSES, REACH, EMBED, HIDDEN = 1 << 15, 64, 2, 16, 32
WARM_UP, BLOCK, PARTS, BATCH, RATE, MOST_TASKS = 300_000, 1 << 21, 32, 512, 0.1, 4096
PAD = VOCAB
OFFSETS = [o for o in range(2 * REACH + 1) if o != REACH]


def hashed(texts: list[str | None]) -> list[np.ndarray]:
    """The tokens of each text; a null text has none."""
    words = [(t or "").encode().split() for t in texts]
    known = {w: zlib.crc32(w) % VOCAB for ws in words for w in ws}
    return [np.fromiter(map(known.__getitem__, ws), np.uint16, len(ws)) for ws in words]


def padded(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All tokens with REACH pads around each document, and the places of the tokens."""
    edge = np.full(REACH, PAD, dtype=np.int32)
    parts, places, at = [edge], [], REACH
    for d in docs:
        parts += [d.astype(np.int32), edge]
        places.append(np.arange(at, at + len(d)))
        at += len(d) + REACH
    return np.concatenate(parts), np.concatenate([np.zeros(0, np.int64), *places])


@dataclass
class Network:
    embed: np.ndarray  # (VOCAB + 1, EMBED)
    mix: np.ndarray  # (2 REACH, EMBED, HIDDEN)
    out: np.ndarray  # (HIDDEN + 1, CLASSES), the last row is the bias
    classes: np.ndarray  # class of each bucket
    within: np.ndarray  # log-probability of each bucket within its class

    @classmethod
    def new(cls, counts: np.ndarray, seed: int = 4) -> Network:
        """Frequent buckets are classes of their own, the others share the rest evenly by count."""
        rng = np.random.default_rng(seed)
        order = np.argsort(-counts, kind="stable")
        alone = CLASSES // 2
        classes = np.empty(VOCAB, dtype=np.int64)
        classes[order[:alone]] = np.arange(alone)
        rest = rng.permutation(order[alone:])
        mass = np.cumsum(counts[rest] + 1.0)
        classes[rest] = alone + np.minimum((mass - mass[0]) / mass[-1] * (CLASSES - alone), CLASSES - alone - 1).astype(np.int64)
        smooth = counts + 0.5
        within = np.log(smooth) - np.log(np.bincount(classes, smooth, CLASSES))[classes]
        share = np.log(np.bincount(classes, smooth, CLASSES) / smooth.sum())
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        out = np.vstack([draw(HIDDEN, CLASSES, scale=0.1), share]).astype(np.float32)
        return cls(draw(VOCAB + 1, EMBED, scale=0.3), draw(2 * REACH, EMBED, HIDDEN, scale=(2 * REACH * EMBED) ** -0.5), out, classes, within)

    def weights(self) -> np.ndarray:
        return np.concatenate([self.embed.ravel(), self.mix.ravel(), self.out.ravel()])

    def load(self, flat: np.ndarray) -> Network:
        a, b = self.embed.size, self.embed.size + self.mix.size
        new = [flat[x].astype(np.float32).reshape(y.shape) for x, y in ((slice(a), self.embed), (slice(a, b), self.mix), (slice(b, None), self.out))]
        return Network(*new, self.classes, self.within)

    def train(self, flat: np.ndarray, places: np.ndarray, rng: np.random.Generator) -> None:
        """One pass of gradient descent over the places, in random order."""
        places = rng.permutation(places)
        flat = flat.astype(np.uint16)  # PAD fits; two bytes sort fastest
        around = np.array(OFFSETS) - REACH
        mix = self.mix.reshape(-1, HIDDEN)  # a view: one product for all offsets
        for at in range(0, len(places), BATCH):
            p = places[at : at + BATCH]
            x = flat[p[:, None] + around]  # (B, 2 REACH)
            e = self.embed[x].reshape(len(p), -1)
            h = np.tanh(e @ mix)
            logits = h @ self.out[:-1] + self.out[-1]
            logits -= logits.max(axis=1, keepdims=True)
            np.exp(logits, out=logits)
            logits /= logits.sum(axis=1, keepdims=True)
            logits[np.arange(len(p)), self.classes[flat[p]]] -= 1
            dh = (logits @ self.out[:-1].T) * (1 - h * h)
            rate = RATE * BATCH**-0.5
            self.out[:-1] -= rate * 0.2 * (h.T @ logits)
            self.out[-1] -= rate * 0.2 * logits.sum(axis=0)
            de = (dh @ mix.T).reshape(-1, EMBED)
            mix -= rate * 0.2 * (e.T @ dh)
            x = x.ravel()
            order = np.argsort(x, kind="stable")
            x = x[order]
            heads = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
            self.embed[x[heads]] -= rate * np.add.reduceat(de[order], heads, axis=0)

    def scores(self, docs: list[np.ndarray], at_once: int = 1 << 15) -> np.ndarray:
        """The sum of log P(token | both sides) of each document."""
        tables = np.stack([self.embed @ m for m in self.mix])
        flat, places = padded(docs)
        logs = np.empty(len(places))
        for at in range(0, len(places), at_once):
            p = places[at : at + at_once]
            h = tables[0][flat[p + OFFSETS[0] - REACH]]
            for k in range(1, 2 * REACH):
                h += tables[k][flat[p + OFFSETS[k] - REACH]]
            np.tanh(h, out=h)
            logits = h @ self.out[:-1]
            logits += self.out[-1]
            top = logits.max(axis=1)
            token = flat[p]
            own = logits[np.arange(len(p)), self.classes[token]] - top
            np.exp(logits - top[:, None], out=logits)
            logs[at : at + at_once] = own - np.log(logits.sum(axis=1)) + self.within[token]
        upto = np.r_[0.0, np.cumsum(logs)]
        ends = np.cumsum([len(d) for d in docs])
        return upto[ends] - upto[ends - [len(d) for d in docs]]


def tokenized(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, h (a hash of the id and the text) and tokens (2 bytes each) of each row."""
    rows = df.select(c(id_col).alias("id"), F.xxhash64(c(id_col), c(text_col)).alias("h"), c(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                tokens = [t.astype("<u2").tobytes() for t in hashed(piece.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("h"), pa.array(tokens, pa.binary())], ["id", "h", "tokens"])

    return rows.mapInArrow(run, T.StructType([rows.schema["id"], T.StructField("h", T.LongType()), T.StructField("tokens", T.BinaryType())]))


def _arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), "<u2") for x in batch.column("tokens")]


def _averaged(vectors: DataFrame, weighted: bool, groups: int = 64) -> np.ndarray:
    """The sum or, weighted by weight, the mean of vectors (source, part, weight, data), in the order of their
    sources. Sums, of which every input task has one, are made by part and one of `groups` groups of sources first."""

    def run(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
        key, total, weight = None, None, 0.0

        def done() -> pa.RecordBatch:
            mean = total / weight if weighted else total
            return pa.RecordBatch.from_arrays([pa.array([key[1]], pa.int64()), pa.array([key[0]], pa.int32()), pa.array([weight]), pa.array([mean.astype("<f8").tobytes()], pa.binary())], ["source", "part", "weight", "data"])

        for batch in batches:
            for p, g, w, data in zip(*(batch.column(x) for x in ("part", "grouped", "weight", "data"))):
                if (p.as_py(), g.as_py()) != key:
                    if key is not None:
                        yield done()
                    key, total, weight = (p.as_py(), g.as_py()), 0.0, 0.0
                total = total + np.frombuffer(data.as_buffer(), kind).astype(np.float64) * (w.as_py() if weighted else 1)
                weight += w.as_py()
        if key is not None:
            yield done()

    last = (F.lit(0).cast("long"), "<f2" if weighted else "<f8")
    for group, kind in [last] if weighted else [(F.pmod("source", F.lit(groups)), "<f8"), last]:
        dealt = vectors.withColumn("grouped", group).repartition("part", "grouped").sortWithinPartitions("part", "grouped", "source")
        vectors = dealt.mapInArrow(lambda batches, kind=kind: run(batches, kind), VECTORS)
    rows = sorted(vectors.select("part", "data").collect(), key=lambda r: r["part"])
    return np.concatenate([np.zeros(0), *(np.frombuffer(r["data"], "<f8") for r in rows)])


VECTORS = "source long, part int, weight double, data binary"


def _cut(source: int, weight: float, flat: np.ndarray) -> pa.RecordBatch:
    blobs = [x.tobytes() for x in np.array_split(flat, PARTS)]
    columns = [pa.array([source] * PARTS, pa.int64()), pa.array(range(PARTS), pa.int32()), pa.array([weight] * PARTS), pa.array(blobs, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["source", "part", "weight", "data"])


def bucket_counts(tokens: DataFrame) -> np.ndarray:
    """How often each bucket is in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(VOCAB)
        for batch in batches:
            for d in _arrays(batch):
                counts += np.bincount(d, minlength=VOCAB) if len(d) > VOCAB else 0
            short = [d for d in _arrays(batch) if len(d) <= VOCAB]
            counts += np.bincount(np.concatenate([np.zeros(0, np.uint16), *short]), minlength=VOCAB)
        if counts.any():
            yield _cut(TaskContext.get().partitionId(), 1.0, counts.astype("<f8"))

    total = _averaged(tokens.select("tokens").mapInArrow(run, VECTORS), weighted=False)
    return total if len(total) else np.zeros(VOCAB)


def fit(tokens: DataFrame, warm_up: int = WARM_UP, block: int = BLOCK) -> Network:
    counts = bucket_counts(tokens)
    net = Network.new(counts)
    total = counts.sum()
    if not total:
        return net
    # one row of repeated ones and the first warm_up tokens of longer texts: this is only where training starts
    drawn = tokens.where(unit_hash(F.col("h"), F.lit(4)) < min(1.0, warm_up / total)).select("h", F.substring("tokens", 1, 2 * warm_up).alias("tokens")).dropDuplicates(["h"]).orderBy("h").collect()
    flat, places = padded([np.frombuffer(r["tokens"], "<u2") for r in drawn])
    net.train(flat, places, np.random.default_rng(5))
    start = tokens.sparkSession.sparkContext.broadcast(net)
    blocks = max(1, round(total / block))
    each = -(-blocks // MOST_TASKS)  # blocks a task
    tasks = -(-blocks // each)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, mean, weight = start.value, 0.0, 0.0
        task = None

        def train(docs: list[np.ndarray], seed: list[int]) -> None:
            nonlocal mean, weight
            copy = first.load(first.weights())
            flat, places = padded(docs)
            copy.train(flat, places, np.random.default_rng(seed))
            mean = mean + copy.weights().astype(np.float64) * len(places)
            weight += len(places)

        # blocks come one after another; repeated rows, which are all in one, may cut it into several
        held, size, own, nth = [], 0, None, 0
        for batch in batches:
            for b, d in zip(batch.column("block").to_pylist(), _arrays(batch)):
                if held and (b != own or size >= 2 * block):
                    train(held, [own, nth])
                    held, size, nth = [], 0, nth + 1 if b == own else 0
                own, task = b, b // each
                held.append(d)
                size += len(d)
        if held:
            train(held, [own, nth])
        if weight:
            yield _cut(task, weight, (mean / weight).astype("<f2"))

    number = F.floor(unit_hash(F.col("h"), F.lit(6)) * blocks).cast("int")
    dealt = tokens.where(F.octet_length("tokens") > 0).select("h", "tokens", number.alias("block"))
    dealt = dealt.repartitionById(tasks, F.expr(f"block div {each}").cast("int")).sortWithinPartitions("block", "h", "tokens")
    mean = _averaged(dealt.select("tokens", "block").mapInArrow(run, VECTORS), weighted=True)
    start.unpersist()
    return net.load(mean)


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id_col, n_tokens, log_prob (the sum over all tokens) and mean_log_prob of each row of df.

    Null texts and those without a word have no tokens, log_prob 0 and a null mean. Null ids and
    repeated rows are rows like others. Other columns of df aren't read. An empty table gives
    an empty one."""
    tokens = stash(tokenized(df, id_col, text_col), "lm_tokens")
    net = tokens.sparkSession.sparkContext.broadcast(fit(tokens, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = _arrays(batch)
            n, sums = np.array([len(d) for d in docs], dtype=np.int64), net.value.scores(docs) if docs else np.zeros(0)
            sums = np.where(n > 0, sums, 0.0)
            mean = pa.array(sums / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(sums), mean], ["id", "n_tokens", "log_prob", "mean_log_prob"])

    schema = T.StructType([tokens.schema["id"], *(T.StructField(x, t) for x, t in (("n_tokens", T.LongType()), ("log_prob", T.DoubleType()), ("mean_log_prob", T.DoubleType())))])
    return tokens.select("id", "tokens").mapInArrow(run, schema).withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))
