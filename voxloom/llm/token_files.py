"""Token-id files with Elias-Fano document boundaries.

A file set is a folder that Spark writes and commits. Its unit is a block, a
self-contained byte string in the format below: the ids of whole documents one
after another, 2 bytes each while the vocabulary allows, else 4, and two monotone
sequences in Elias-Fano form, the documents' ends within the block and the
documents' ids. Such a sequence of n values below u takes about 2 + log2(u / n) bits a value;
every SAMPLE-th one's place in the high bits is kept, so that select reads a few
bytes to return any offset. Blocks hold at most BLOCK_TOKENS ids, or one longer document.

Block format, little-endian: b"VXEF", u8 version, u8 bytes an id, u64 documents, u64 leading
documents without an id, i64 least id, sequence of ends, sequence of (id - least id), ids.
Sequence: u64 n, u8 low bits l, u32 bytes of the low part, of the high part, of the samples; the parts.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import c, documents, new_dir, slices

MAGIC, VERSION, SAMPLE, BLOCK_TOKENS, END_ID = b"VXEF", 1, 64, 1 << 20, 1
#: Texts of these characters have no white space but ASCII's and nothing to compose across it.
PLAIN = re.compile(r"[\t-\r\x20-\x7e\xc0-\xff]*")
CACHE_WORDS = 1_400_000


class EliasFano:
    """A monotone sequence of non-negative integers."""

    def __init__(self, n: int, l: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.l, self.low, self.high, self.samples = n, l, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        l = max(0, ((top + 1) // n).bit_length() - 1) if n else 0
        bits = ((values[:, None] >> np.arange(l, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        low = np.packbits(bits.ravel(), bitorder="little")
        ones = (values >> np.uint64(l)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        high[ones] = 1
        return cls(n, l, low, np.packbits(high, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), dtype=np.int64)
        at = i[:, None] * self.l + np.arange(self.l)
        bits = (self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return (bits.astype(np.int64) << np.arange(self.l)).sum(axis=1)

    def select(self, i: int) -> int:
        """The i-th value, from the sample before it, its low bits and the bytes between."""
        at = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, at >> 3
        window = int(self.high[byte]) >> (at & 7) << (at & 7)
        while window.bit_count() <= left:
            left -= window.bit_count()
            byte += 1
            window = int(self.high[byte])
        for _ in range(left):
            window &= window - 1
        place = byte * 8 + (window & -window).bit_length() - 1
        return ((place - i) << self.l) | int(self._low(np.array([i]))[0])

    def selected(self, first: int, last: int) -> np.ndarray:
        """The values of places first to last, as select gives each: one stretch of SAMPLE of them after another,
        from its sample and the bytes up to the next one's."""
        out = np.empty(max(0, last - first), dtype=np.int64)
        for k in range(first // SAMPLE, -(-last // SAMPLE)):
            a, b = max(first, k * SAMPLE), min(last, (k + 1) * SAMPLE)
            at = int(self.samples[k])
            end = int(self.samples[k + 1]) if k + 1 < len(self.samples) else 8 * len(self.high)
            ones = np.flatnonzero(np.unpackbits(self.high[at >> 3 : (end + 7) >> 3], bitorder="little")) + (at & ~7)
            i = np.arange(a, b)
            ones = ones[np.searchsorted(ones, at) :][i - k * SAMPLE]
            out[a - first : b - first] = ((ones - i) << self.l) | self._low(i)
        return out

    def pack(self) -> bytes:
        parts = [x.tobytes() for x in (self.low, self.high, self.samples)]
        return struct.pack("<QBIII", self.n, self.l, *map(len, parts)) + b"".join(parts)

    @classmethod
    def unpack(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        n, l, *sizes = struct.unpack_from("<QBIII", data, at)
        at += struct.calcsize("<QBIII")
        parts = []
        for size in sizes:
            parts.append(np.frombuffer(data, np.uint8, size, at))
            at += size
        return cls(n, l, parts[0], parts[1], parts[2].view("<u4")), at


def pack_block(doc_ids: list[int | None], tokens: list[np.ndarray], id_bytes: int) -> bytes:
    """doc_ids ascend, those without an id first; tokens has the ids of each document."""
    nulls = sum(d is None for d in doc_ids)
    ids = np.array(doc_ids[nulls:], dtype=np.int64)
    least = int(ids[0]) if len(ids) else 0
    ends = np.cumsum([len(t) for t in tokens])
    head = MAGIC + struct.pack("<BBQQq", VERSION, id_bytes, len(doc_ids), nulls, least)
    flat = np.concatenate(tokens).astype(f"<u{id_bytes}")
    return head + EliasFano.encode(ends).pack() + EliasFano.encode(ids.view(np.uint64) - np.uint64(least & (1 << 64) - 1)).pack() + flat.tobytes()


class Block:
    """A block as read: doc_id(i), bounds(i) and tokens(i) of its i-th document."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        if bytes(view[:4]) != MAGIC:
            raise ValueError("not a token block")
        version, id_bytes, self.n, self.nulls, self.least = struct.unpack_from("<BBQQq", view, 4)
        if version != VERSION:
            raise ValueError(f"block version {version}")
        self.ends, at = EliasFano.unpack(view, 4 + struct.calcsize("<BBQQq"))
        self.ids, at = EliasFano.unpack(view, at)
        self.flat = np.frombuffer(view, f"<u{id_bytes}", offset=at)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.least + self.ids.select(i - self.nulls)

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def stretches(self, most: int = 64 * SAMPLE) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
        """Ids, starts and ends of at most `most` documents after another: no table of all of them is made."""
        for a in range(0, self.n, most):
            b = min(self.n, a + most)
            ends = self.ends.selected(a, b)
            before = np.r_[self.ends.select(a - 1) if a else 0, ends[:-1]]
            ids = self.ids.selected(max(0, a - self.nulls), max(0, b - self.nulls)) + self.least
            yield [None] * (b - a - len(ids)) + ids.tolist(), before, ends

    def tokens(self, i: int) -> np.ndarray:
        a, b = self.bounds(i)
        return self.flat[a:b]


class Encoder:
    """Token ids of texts with a tokenizers file. The tokenizer never joins what white space
    parts, so texts of plain characters are split there, each distinct word is encoded once by
    the library, and words' ids are put together again; other texts, and those that may
    hold special tokens, are encoded by the library as they are. The first CACHE_WORDS words are
    kept, later ones for the call only: frequent words come early."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.id_bytes = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        # with a tokenizer that lower-cases, fewer words are distinct if that is done first
        self.lower = self._ids(["A" + chr(0xC0)]) == self._ids(["a" + chr(0xE0)])
        self.words: dict[bytes, int] = {}
        self.ends, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)  # word i has flat[ends[i] : ends[i + 1]]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if PLAIN.fullmatch(t) and not any(s in t for s in self.specials)]
        words = [texts[i].lower().encode().split() for i in plain] if self.lower else [texts[i].encode().split() for i in plain]
        flat = [w for ws in words for w in ws]
        of = np.fromiter(map(self.words.get, flat, repeat(-1)), np.int64, len(flat))
        absent = np.flatnonzero(of < 0).tolist()
        new = dict.fromkeys(flat[j] for j in absent)
        ids = self._ids([w.decode() for w in new])
        for n, w in enumerate(new, len(self.words)):
            new[w] = n
        of[absent] = [new[flat[j]] for j in absent]
        ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(x) for x in ids], dtype=np.int64)])
        table = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), np.uint32, int(ends[-1] - self.ends[-1]))])
        room = CACHE_WORDS - len(self.words)
        if room > 0:
            self.words.update(islice(new.items(), room))
            self.ends = ends[: len(self.words) + 1]
            self.flat = table[: self.ends[-1]]
        sizes = np.diff(ends)[of]
        upto = np.cumsum(sizes)
        every = table[np.repeat(ends[of] - (upto - sizes), sizes) + np.arange(upto[-1] if len(of) else 0)]
        at = np.cumsum([0, *map(len, words)])
        cut = np.r_[0, upto][at]
        for k, i in enumerate(plain):
            out[i] = every[cut[k] : cut[k + 1]]
        rest = [i for i in range(len(texts)) if out[i] is None]
        for i, e in zip(rest, self._ids([texts[i] for i in rest])):
            out[i] = np.array(e, dtype=np.uint32)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One a worker process: what it has learnt serves all its tasks."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write_token_files(df: DataFrame, path: str, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write the ids of all texts of df to path, in ascending order of id_col.

    Null texts count as empty: they have the end id alone. Rows with null ids come first;
    rows with equal ids come in the order of a hash of their texts. An empty table gives an
    empty file set. Other columns of df aren't read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer_file), TaskContext.get().partitionId()
        doc_ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = before = block = 0

        def full() -> pa.RecordBatch:
            blob = pack_block(doc_ids, tokens, enc.id_bytes if end_id < 1 << 8 * enc.id_bytes else 4)
            columns = [[part], [block], [before], [len(doc_ids)], [held], [blob]]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], ["part", "block", "before", "n_docs", "n_tokens", "data"])

        for batch in batches:
            for piece in slices(batch, "text"):
                for d, ids in zip(piece.column("id").to_pylist(), enc.encode(piece.column("text").to_pylist())):
                    if held and held + len(ids) + 1 > block_tokens:
                        yield full()
                        block, before, held = block + 1, before + held, 0
                        doc_ids, tokens = [], []
                    doc_ids.append(d)
                    tokens.append(np.append(ids, np.uint32(end_id)))
                    held += len(ids) + 1
        if held:
            yield full()

    rows = df.select(c(id_col).cast("long").alias("id"), F.coalesce(c(text_col), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text"))
    ordered.mapInArrow(run, "part int, block long, before long, n_docs long, n_tokens long, data binary").write.parquet(path)


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """id_col, start, n_tokens and ids_crc32 of each document in the files at path.
    The driver holds a number for each of the files' parts."""
    blocks = spark.read.parquet(path)
    totals = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    first, base = {}, 0
    for part in sorted(totals):
        first[part], base = base, base + totals[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, data in zip(*(batch.column(x) for x in ("part", "before", "data"))):
                block = Block(data.as_buffer())
                for ids, starts, ends in block.stretches():
                    crc = [zlib.crc32(block.flat[a:b].astype("<u4").data) for a, b in zip(starts.tolist(), ends.tolist())]
                    columns = [pa.array(ids, pa.int64()), pa.array(starts + first[part.as_py()] + before.as_py()), pa.array(ends - starts), pa.array(crc, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, [id_col, "start", "n_tokens", "ids_crc32"])

    return blocks.select("part", "before", "data").mapInArrow(run, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_dir(spark, "token_files")
    write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path)
