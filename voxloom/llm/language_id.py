"""Language identification with a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows of WINDOW bytes (the last one ends with the
text, so it may overlap; a shorter text is filled up with spaces that don't count). One GRU
reads each window from left to right, another from right to left, and a softmax over
both states gives every position the probabilities of the languages. A document's
probabilities are the mean over its positions. The network is trained here, in numpy, by
backpropagation through time (Adam, cross-entropy at every position), on a bounded
sample of labelled documents: about PER_LANGUAGE documents a language and SPANS spans of
each, chosen by hash, so the driver holds no more than that many spans a language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import c, documents, slices, unit_hash

WINDOW, HIDDEN, PER_LANGUAGE, SPANS, STEPS, BATCH, BLOCK = 64, 10, 500, 3, 500, 192, 4096
UNKNOWN, LEAST_SCORE = "und", 0.3


def gru(table: np.ndarray, u: np.ndarray, x: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (T, H, B) of a GRU over the bytes x (T, B). table (3H, 256) has what each byte adds
    to the update gate, the reset gate and the candidate, u (3H, H) what the state adds; the
    gates' rows are halved, as they go through tanh. keep: gets what backward() needs."""
    h3, size = table.shape[0], x.shape[1]
    n = h3 // 3
    out = np.zeros((len(x), n, size), dtype=np.float32)
    h = np.zeros((n, size), dtype=np.float32)
    g = np.empty((h3, size), dtype=np.float32)
    for t in range(len(x)):
        np.take(table, x[t], axis=1, out=g, mode="clip")
        a = u @ h
        gates = np.tanh(g[: 2 * n] + a[: 2 * n])
        gates += 1
        gates *= 0.5
        z, r = gates[:n], gates[n:]
        cand = np.tanh(g[2 * n :] + r * a[2 * n :])
        if keep is not None:
            keep.append((h, z, r, cand, a[2 * n :]))
        h = np.add(cand, z * (h - cand), out=out[t])
    return out


def backward(u: np.ndarray, x: np.ndarray, keep: list, dh_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of table and u, given those of the states."""
    n = u.shape[1]
    du, dtable = np.zeros_like(u), np.zeros((u.shape[0], 256), dtype=np.float32)
    dh = np.zeros_like(dh_out[0])
    for t in range(len(x) - 1, -1, -1):
        h, z, r, cand, an = keep[t]
        d = dh + dh_out[t]
        dcand = d * (1 - z) * (1 - cand * cand)
        dgates = np.concatenate([d * (h - cand) * z * (1 - z) * 2, dcand * an * r * (1 - r) * 2])
        da = np.concatenate([dgates, dcand * r])
        du += da @ h.T
        for i, row in enumerate(np.concatenate([dgates, dcand])):
            dtable[i] += np.bincount(x[t], weights=row, minlength=256)
        dh = d * z + u.T @ da
    return dtable, du


@dataclass
class Model:
    languages: list[str]
    params: list[np.ndarray]  # tables and u of both directions, output weights (L, 2H), bias

    def probabilities(self, x: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(T, L, B) probabilities at every position of x (T, B), and both states (T, 2H, B)."""
        t1, u1, t2, u2, w, b = self.params
        both = np.concatenate([gru(t1, u1, x, keep and keep[0]), gru(t2, u2, x[::-1], keep and keep[1])[::-1]], axis=1)
        logits = np.matmul(w, both)
        logits += b[:, None]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits, both

    def positions(self, text: str) -> list[str]:
        """The language at each byte of a text."""
        x, lengths = windows([text.encode()])
        p = self.probabilities(x)[0].argmax(axis=1)  # (T, B)
        n = len(text.encode())
        labels = [""] * n
        for i in range(x.shape[1]):
            at = max(0, min(i * WINDOW, n - WINDOW))
            for t in range(int(lengths[i])):
                labels[at + t] = self.languages[p[t, i]]
        return labels

    def documents(self, raw: list[bytes]) -> np.ndarray:
        """(documents, L) mean probabilities of texts, none of them empty."""
        x, lengths = windows(raw)
        owner = np.repeat(np.arange(len(raw)), [max(1, -(-len(b) // WINDOW)) for b in raw])
        sums = np.zeros((len(raw), len(self.languages)))
        for at in range(0, x.shape[1], BLOCK):
            cut = slice(at, at + BLOCK)
            p = self.probabilities(x[:, cut])[0]
            own = np.flatnonzero(lengths[cut] < WINDOW)
            for i in own:
                p[lengths[at + i] :, :, i] = 0
            of_window = p.sum(axis=0)
            for k in range(len(self.languages)):
                sums[:, k] += np.bincount(owner[cut], weights=of_window[k], minlength=len(raw))
        return sums / sums.sum(axis=1, keepdims=True)


def windows(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(WINDOW, n) bytes of the windows of texts, and the bytes in each that count."""
    filled = [b if len(b) >= WINDOW else b.ljust(WINDOW) for b in raw]
    flat = np.frombuffer(b"".join(filled), dtype=np.uint8)
    starts, lengths, at = [], [], 0
    for b, f in zip(raw, filled):
        n = max(1, -(-len(b) // WINDOW))
        own = np.arange(n) * WINDOW
        own[-1] = len(f) - WINDOW
        starts.append(own + at)
        lengths.append(np.full(n, min(len(b), WINDOW)))
        at += len(f)
    starts = np.concatenate(starts)
    return np.ascontiguousarray(flat[starts[:, None] + np.arange(WINDOW)].T), np.concatenate(lengths)


def train(texts: list[str], labels: list[str], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, seed: int = 2) -> Model | None:
    """A network for the languages that labels names; None if there is no text to learn from."""
    rows = [(t.encode(), y) for t, y in zip(texts, labels) if t]
    if not rows:
        return None
    languages = sorted({y for _, y in rows})
    x = windows([b[:WINDOW] for b, _ in rows])[0]
    y = np.array([languages.index(v) for _, v in rows])
    of = [np.flatnonzero(y == k) for k in range(len(languages))]
    rng = np.random.default_rng(seed)
    h3 = 3 * hidden
    init = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    params = [init(h3, 256, scale=0.3), init(h3, hidden, scale=hidden**-0.5), init(h3, 256, scale=0.3), init(h3, hidden, scale=hidden**-0.5), init(len(languages), 2 * hidden, scale=0.3), np.zeros(len(languages), np.float32)]
    model, m1, m2 = Model(languages, params), [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        at = np.concatenate([rng.choice(own, -(-batch // len(of))) for own in of])
        bx, by = x[:, at], y[at]
        keep: tuple[list, list] = ([], [])
        p, both = model.probabilities(bx, keep)
        p[:, by, np.arange(len(at))] -= 1
        p /= p.shape[0] * len(at)
        dboth = np.matmul(params[4].T, p)
        g1, g2 = backward(params[1], bx, keep[0], dboth[:, :hidden]), backward(params[3], bx[::-1], keep[1], dboth[::-1, hidden:])
        grads = [*g1, *g2, np.matmul(p, both.transpose(0, 2, 1)).sum(axis=0), p.sum(axis=(0, 2))]
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for q, g, a, b in zip(params, grads, m1, m2):
            g = g * min(1.0, 1 / (norm + 1e-9))
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            q -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return model


def sample(df: DataFrame, id_col: str, text_col: str, lang_col: str, learn: Column, per_language: int = PER_LANGUAGE, spans: int = SPANS) -> tuple[list[str], list[str]]:
    """Distinct spans of texts, and their languages: of about per_language documents a language. Rows that are
    repeated are drawn together, and count once."""
    usable = df.where(learn & c(lang_col).isNotNull() & (F.length(c(text_col)) > 0))
    rates = {r[0]: min(1.0, per_language / r[1]) for r in usable.groupBy(c(lang_col)).count().collect()}
    if not rates:
        return [], []
    rate = F.element_at(F.create_map(*[F.lit(x) for pair in rates.items() for x in pair]), c(lang_col))
    h = F.xxhash64(c(text_col), c(id_col))
    wide = F.greatest(F.length(c(text_col)) - WINDOW, F.lit(1))
    cut = [F.substring(c(text_col), (1 + F.pmod(F.shiftright(h, 7 * k), wide)).cast("int"), F.lit(WINDOW)) for k in range(spans)]
    rows = usable.where(unit_hash(h) < rate).select(c(lang_col).cast("string").alias("y"), F.explode(F.array(*cut)).alias("x")).distinct().collect()
    rows = sorted((r["y"], r["x"]) for r in rows)
    return [x for _, x in rows], [y for y, _ in rows]


def predict(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """id_col, what more names, lang_pred and score (its probability) of each row of df.

    A null text and one without a letter is `und` with score 0, as is every text where no
    language was learnt. Null ids and repeated rows are rows like others; columns beyond
    those named aren't read. An empty table gives an empty one.
    """
    rows = df.select(c(id_col), *more, F.when(c(text_col).rlike(r"\p{L}"), c(text_col)).alias("_text"))
    kept = [x for x in rows.schema if x.name != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "_text"):
                texts = piece.column("_text").to_pylist()
                lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                at = [i for i, t in enumerate(texts) if t] if model else []
                if at:
                    p = model.documents([texts[i].encode() for i in at])
                    score[at] = p.max(axis=1)
                    for i, k in zip(at, p.argmax(axis=1).tolist()):
                        lang[i] = model.languages[k]
                yield pa.RecordBatch.from_arrays([*(piece.column(x.name) for x in kept), pa.array(lang), pa.array(score)], [*(x.name for x in kept), "lang_pred", "score"])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def held_out(id_col: str) -> Column:
    """Documents that nothing is learnt from; a null id is no such document, but not learnt from either."""
    return F.pmod(F.crc32(c(id_col).cast("string").cast("binary")), F.lit(4)) == 2


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    return train(*sample(df, id_col, text_col, lang_col, ~held_out(id_col)))


def reject_unknown(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = LEAST_SCORE) -> DataFrame:
    """The rows of df, with df's columns, whose language is found: not `und`, with a score of at
    least `least`. Null texts go; the rules are predict's."""
    model = learn(df, id_col, text_col, lang_col)
    names = df.columns
    numbered = df.select(*[c(x).alias(f"c{i}") for i, x in enumerate(names)])
    found = predict(numbered, model, f"c{names.index(id_col)}", f"c{names.index(text_col)}", *[F.col(f"c{i}").alias(f"k{i}") for i in range(len(names))])
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(*[F.col(f"k{i}").alias(x) for i, x in enumerate(names)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, learn(docs), "doc_id", "text", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"))
