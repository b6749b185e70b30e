"""Suffix-array dedup: repeated passages found by column-wise construction.

A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller
id. Strings are brought together by their minimizer, the least hash among their
KMER-byte substrings: equal strings have equal minimizers.

1. Rows are written once, in chunks of CHUNK_ROWS rows, fewer where texts are long, as a table bucketed by chunk, so that what
   is found out about a chunk comes back to its texts while these stay where they are. A row whose
   whole text a smaller id has too is settled there and takes no further part.
2. Each chunk names its distinct minimizers; those that no second document has are struck out.
3. Strings that overlap and share a minimizer make one segment, of fewer than 2 * length bytes.
   A chunk sends its distinct segments, with the least and the greatest id that has each, to the
   minimizer's bucket, so a passage that very many documents share travels once a chunk.
4. A bucket's segments are a collection of documents whose suffix array is built column
   by column (class Collection): each round inserts one symbol of every segment into the
   collection's Burrows-Wheeler transform and brings the common prefixes up to date, both
   kept as files in memory that are read and written from start to end: a bucket's collection is small,
   and a worker's own disk isn't used. Neighbours with `length` symbols
   in common form the groups of equal strings; the least id of each goes back to the chunks.
5. Each chunk marks the bytes that such strings cover, and returns what is left.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import c, chunked, documents, stash

LENGTH, KMER, CHUNK_ROWS, BLOCK, BUCKET_ROWS = 50, 24, 1000, 1 << 16, 640
ODD = np.random.default_rng(6).integers(1 << 62, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64)
NO_ID = (1 << 63) - 1


class Collection:
    """Burrows-Wheeler transform and common prefixes of a growing collection of byte strings.

    Round j inserts the suffix of length j of every string that has one. The suffixes
    that start with a symbol stand in the order of that symbol's occurrences in the transform,
    so the place of a new suffix follows from the occurrence it stems from; its common
    prefix with the one before it is one more than the least of the common prefixes between both
    occurrences. End marks come first, each string's its own. Two files, in memory, hold, for each suffix
    in order, the symbol before it (0: none) and its common prefix with the one before (255 at
    most); a round reads both and writes both anew."""

    def __init__(self, text: np.ndarray, ends: np.ndarray):
        self.text, self.files = text, [b"", b""]
        self.starts, self.ends = np.r_[0, ends[:-1]].astype(np.int64), ends.astype(np.int64)
        self.at = self.ends.copy()  # start of each string's last inserted suffix
        self.write(self._before(self.at, self.starts), np.zeros(len(ends), np.uint8))

    def _before(self, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.where(at > starts, self.text[np.maximum(at - 1, 0)].astype(np.int16) + 1, 0).astype(np.uint8)

    def write(self, *arrays: np.ndarray) -> None:
        self.files = [x.tobytes() for x in arrays]

    def read(self) -> list[np.ndarray]:
        return [np.frombuffer(x, np.uint8) for x in self.files]

    def build(self) -> Collection:
        open_ = np.flatnonzero(self.at > self.starts)
        where = open_.copy()  # of each open string's last suffix, among all suffixes
        while len(open_):
            where = self._round(open_, where)
            more = self.at[open_] > self.starts[open_]
            open_, where = open_[more], where[more]
        return self

    def _occurrences(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Places in order of symbols, the inverse, and how many of them have no symbol."""
        order = np.argsort(symbols, kind="stable").astype(np.int32)
        rank = np.empty(len(order), dtype=np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        return order, rank, len(symbols) - np.count_nonzero(symbols)

    def _round(self, open_: np.ndarray, where: np.ndarray) -> np.ndarray:
        symbols, common = self.read()
        n, strings = len(symbols), len(self.ends)
        order, rank, closed = self._occurrences(symbols)
        k = rank[where].astype(np.int64)
        new = strings + k - closed
        old = np.ones(n + len(open_), dtype=bool)
        old[new] = False
        symbols2, common2 = np.empty(len(old), np.uint8), np.empty(len(old), np.uint8)
        symbols2[old], common2[old] = symbols, common
        self.at[open_] -= 1
        symbols2[new] = self._before(self.at[open_], self.starts[open_])
        # common prefixes of the new suffixes and of those that follow them
        touched = np.zeros(n + 1, dtype=bool)
        touched[k], touched[k + 1] = True, True
        t = np.flatnonzero(touched[:n])
        same = t > closed
        same[same] = symbols[order[t[same]]] == symbols[order[t[same] - 1]]
        common2[strings + t[~same] - closed] = 0
        t = t[same]
        if len(t):
            lo, hi = order[t - 1] + 1, order[t] + 1
            down = np.argsort(-lo)  # reduceat takes one element only between a span and an earlier one
            spans = np.stack([lo[down], hi[down]], axis=1).ravel()
            least = np.minimum.reduceat(np.append(common, np.uint8(255)), spans)[::2]
            common2[strings + t[down] - closed] = np.minimum(least, 254) + 1
        self.write(symbols2, common2)
        return new

    def places(self) -> np.ndarray:
        """The start of each suffix in order, found by walking every string from its end mark."""
        symbols, _ = self.read()
        _, rank, closed = self._occurrences(symbols)
        out = np.empty(len(symbols), dtype=np.int64)
        where, at = np.arange(len(self.ends)), self.ends.copy()
        starts = self.starts
        while len(where):
            out[where] = at
            more = at > starts
            where, at, starts = len(self.ends) + rank[where[more]].astype(np.int64) - closed, at[more] - 1, starts[more]
        return out


def least_of_equal(text: np.ndarray, ends: np.ndarray, least: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each place of the strings, the smallest of `least` (a number a string) over the strings that
    hold the `length` bytes starting there; NO_ID where fewer bytes are left."""
    out = np.full(len(text), NO_ID, dtype=np.int64)
    if not len(text):
        return out
    built = Collection(text, ends).build()
    places, common = built.places(), built.read()[1]
    owner = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))[np.minimum(places, len(text) - 1)]
    deep = (np.arange(len(places)) >= len(ends)) & (places + length <= ends[owner])  # end marks come first
    heads = np.flatnonzero(np.r_[True, common[1:] < length])
    group = np.minimum.reduceat(np.where(deep, least[owner], NO_ID), heads)
    out[places[deep]] = np.repeat(group, np.diff(np.r_[heads, len(places)]))[deep]
    return out


def window_hashes(text: np.ndarray, length: int = LENGTH, kmer: int = KMER) -> np.ndarray:
    """The minimizer, a 64-bit hash, of the `length` bytes at each place that has as many."""
    n = len(text) - length + 1
    out = np.empty(max(n, 0), dtype=np.uint64)
    wide = length - kmer + 1
    for at in range(0, n, BLOCK):
        h = BYTES[text[at : at + BLOCK + length - 1]]
        powers, size = {1: h}, 1
        while size * 2 <= kmer:
            h = powers[size]
            powers[size * 2] = h[:-size] * ODD[size.bit_length()] + h[size:]
            size *= 2
        whole, done = powers[size], size
        while done < kmer:
            part = 1 << ((kmer - done).bit_length() - 1)
            whole = whole[: len(powers[part]) - done] * ODD[7] + powers[part][done:][: len(whole)]
            done += part
        whole ^= whole >> np.uint64(31)
        whole *= ODD[0]
        whole ^= whole >> np.uint64(29)
        least, size = whole, 1
        while size * 2 <= wide:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < wide:
            least = np.minimum(least[: len(least) - (wide - size)], least[wide - size :])
        out[at : at + BLOCK] = least[:BLOCK]
    return out


def joined(texts: pa.ChunkedArray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of texts, one after another without those to skip; where each starts and ends."""
    raw = [b"" if s else t.as_py() for t, s in zip(texts, skip)]
    ends = np.cumsum([len(x) for x in raw])
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.r_[0, ends[:-1]].astype(np.int64), ends


def minimizers(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of places with one minimizer: first place, number of places, bucket, and 32 more bits."""
    least = window_hashes(text, length)
    n = len(least)
    doc = np.repeat(np.arange(len(ends)), ends - starts)[:n]
    valid = np.arange(n) + length <= ends[doc] if n else np.zeros(0, bool)
    change = np.r_[True, (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | (valid[1:] != valid[:-1])] if n else np.zeros(0, bool)
    heads = np.flatnonzero(change)
    counts = np.diff(np.r_[heads, n])
    heads, counts = heads[valid[heads]], counts[valid[heads]]
    most = length - KMER + 1  # of places that share a k-mer; longer runs repeat it
    pieces = -(-counts // most)
    if len(heads) and pieces.max() > 1:
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        heads, counts = np.repeat(heads, pieces) + nth * most, np.minimum(np.repeat(counts, pieces) - nth * most, most)
    mixed = least[heads] * ODD[1]
    return heads, counts, ((mixed & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64), (mixed >> np.uint64(32)).astype(np.uint32)


def stretches(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of sorted keys, and where each starts, with the end of all."""
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return keys[at], np.append(at, len(keys))


def distinct(lens: np.ndarray, body: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """The distinct strings of those that lie in body one after another, as (text, ends), and which
    of them each is."""
    wide = int(lens.max())
    inside = np.arange(wide) < lens[:, None]
    cells = np.zeros((len(lens), wide + 2), dtype=np.uint8)  # the size and an end that isn't zero go last
    cells[:, :-2][inside] = body
    cells[:, -2], cells[:, -1] = lens, 1
    uniq, of = np.unique(cells.view(f"S{wide + 2}").ravel(), return_inverse=True)
    cells = uniq.view(np.uint8).reshape(len(uniq), -1)
    text = cells[:, :-2][np.arange(wide) < cells[:, -2:-1]]
    return (text, np.cumsum(cells[:, -2].astype(np.int64))), of.ravel()


MESSAGE = "chunk long, bucket int, data binary"
COPIES = -1


def _rows(chunk: int, buckets: list[int], blobs: list[bytes]) -> pa.Table:
    return pa.table([pa.array([chunk] * len(blobs), pa.int64()), pa.array(buckets, pa.int32()), pa.array(blobs, pa.binary())], ["chunk", "bucket", "data"])


def _split(right: pa.Table) -> tuple[np.ndarray, list[tuple[int, memoryview]]]:
    """Ids of rows that are copies, and the other messages."""
    rows = list(zip(right.column("bucket").to_pylist(), right.column("data").to_pylist()))
    copies = np.frombuffer(b"".join(d for b, d in rows if b == COPIES), ">i8")
    return copies.astype(np.int64), [(b, d) for b, d in rows if b != COPIES]


def _ids(left: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return left.column("rid").to_numpy(), left.column("id").fill_null(NO_ID).to_numpy()


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """The messages (chunk, data) of each bucket, of rows sorted by bucket."""
    bucket, held = None, []
    for batch in batches:
        for k, b, d in zip(*(batch.column(x).to_pylist() for x in ("chunk", "bucket", "data"))):
            if b != bucket:
                if held:
                    yield bucket, held
                bucket, held = b, []
            held.append((k, d))
    if held:
        yield bucket, held


def _spread(messages: DataFrame) -> DataFrame:
    return messages.repartition("bucket").sortWithinPartitions("bucket", "chunk")


def removals(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """id_col, n_bytes, n_removed, n_spans (maximal runs that go), spans (start and end of each, in bytes),
    kept (the bytes left) and kept_sha256 of each row of df.

    A byte goes if a string of `length` bytes that covers it also starts in a row with a smaller
    id. A null text counts as empty and keeps nothing. A null id counts as greater than any
    other, and no smaller than another null; repeated rows (same id) don't take from each
    other. The table of the rows stays, unnamed but for the session, in the shared folder. Texts shorter than `length` stay. Other columns of df aren't read. An empty table
    gives an empty one. Unlike the text, what is kept may end within a character."""
    if length <= KMER or length > 127:
        raise ValueError(f"length must be from {KMER + 1} to 127")
    spark = df.sparkSession
    rows = df.select(c(id_col).cast("long").alias("id"), F.encode(F.coalesce(c(text_col), F.lit("")), "UTF-8").alias("text"))
    table = chunked(rows, "suffix_rows", chunk_rows)
    # a bucket for so many rows, so that its collection fits a processor's cache; two a task at least
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), table.count() // BUCKET_ROWS)
    by_chunk = lambda messages: table.groupBy("chunk").cogroup(messages.groupBy("chunk"))

    # rows whose text a smaller id has
    same = table.where(F.octet_length("text") >= length).select("rid", "chunk", F.coalesce("id", F.lit(NO_ID)).alias("id"), F.sha2("text", 256).alias("sha"))
    same = stash(same, "suffix_texts")
    # a chunk asks and is told once for all its copies of a text, so a crowd of copies isn't one task's
    asking = same.groupBy("chunk", "sha").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n"))
    first = asking.groupBy("sha").agg(F.min("low").alias("least"), F.sum("n").alias("n")).where("n > 1").select(F.col("sha").alias("s"), "least")
    told = asking.join(first, (F.col("sha") == F.col("s")) & (F.col("high") > F.col("least"))).select(F.col("chunk").alias("k"), "s", "least")
    copies = same.join(told, (F.col("chunk") == F.col("k")) & (F.col("sha") == F.col("s")) & (F.col("id") > F.col("least"))).select("chunk", F.lit(COPIES).alias("bucket"), F.unhex(F.lpad(F.hex("rid"), 16, "0")).alias("data"))
    copies = stash(copies, "suffix_copies")

    def name_minimizers(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _rows(0, [], [])
        rids, ids = _ids(left)
        skip = np.isin(rids, _split(right)[0])
        text, starts, ends = joined(left.column("text"), skip)
        heads, _, bucket, h = minimizers(text, starts, ends, buckets, length)
        doc = np.searchsorted(ends, heads, "right")
        key = (bucket.astype(np.uint64) << np.uint64(32)) | h
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
        twice = doc[first] != doc[np.r_[first[1:], len(key)] - 1] if len(key) else np.zeros(0, bool)
        key = key[first]
        some, at = stretches((key >> np.uint64(32)).astype(np.int64))
        low = (key & np.uint64(0xFFFFFFFF)).astype("<u4")
        blobs = [struct.pack("<I", b - a) + low[a:b].tobytes() + np.packbits(twice[a:b]).tobytes() for a, b in zip(at, at[1:])]
        return _rows(left.column("chunk")[0].as_py(), some.tolist(), blobs)

    def strike_single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in by_bucket(batches):
            parts, twice = [], []
            for _, d in held:
                (n,) = struct.unpack_from("<I", d)
                parts.append(np.frombuffer(d, "<u4", n, 4))
                twice.append(np.unpackbits(np.frombuffer(d, np.uint8, offset=4 + 4 * n), count=n).astype(bool))
            values, inverse, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            shared = counts > 1
            shared[inverse[np.concatenate(twice)]] = True
            keep = shared[inverse]
            at = np.cumsum([0, *map(len, parts)])
            blobs = [p[keep[a:b]].tobytes() for p, a, b in zip(parts, at, at[1:])]
            some = [(k, d) for (k, _), d in zip(held, blobs) if d]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in some], pa.int64()), pa.array([bucket] * len(some), pa.int32()), pa.array([d for _, d in some], pa.binary())], ["chunk", "bucket", "data"])

    shared = _spread(by_chunk(copies).applyInArrow(name_minimizers, MESSAGE)).mapInArrow(strike_single, MESSAGE)

    def send_segments(left: pa.Table, right: pa.Table) -> pa.Table:
        copied, messages = _split(right)
        if not left.num_rows or not messages:
            return _rows(0, [], [])
        rids, ids = _ids(left)
        text, starts, ends = joined(left.column("text"), np.isin(rids, copied))
        heads, counts, bucket, h = minimizers(text, starts, ends, buckets, length)
        wanted = np.sort(np.concatenate([(np.uint64(b) << np.uint64(32)) | np.frombuffer(d, "<u4") for b, d in messages]))
        key = (bucket.astype(np.uint64) << np.uint64(32)) | h
        hit = wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key
        heads, counts, bucket = heads[hit], counts[hit], bucket[hit]
        doc = np.searchsorted(ends, heads, "right")
        sizes = counts + length - 1
        wide = 2 * length  # the bucket first, the bytes, the size and an end that isn't zero
        padded = np.append(text, np.zeros(wide, np.uint8))
        cells = np.zeros((len(heads), 4 + wide + 2), dtype=np.uint8)
        cells[:, :4] = bucket.astype(">u4").view(np.uint8).reshape(-1, 4)
        cells[:, 4:-2] = np.where(np.arange(wide) < sizes[:, None], padded[heads[:, None] + np.arange(wide)], 0)
        cells[:, -2], cells[:, -1] = sizes, 1
        uniq, owner = np.unique(cells.view(f"S{cells.shape[1]}").ravel(), return_inverse=True)
        owner = owner.ravel()
        lo, hi = np.full(len(uniq), NO_ID), np.full(len(uniq), -NO_ID)
        np.minimum.at(lo, owner, ids[doc])
        np.maximum.at(hi, owner, ids[doc])
        cells = uniq.view(np.uint8).reshape(len(uniq), -1)
        of = cells[:, :4].copy().view(">u4").ravel().astype(np.int64)
        lens = cells[:, -2]
        some, at = stretches(of)
        blobs = []
        for x, y in zip(at, at[1:]):
            s = slice(x, y)
            body = cells[s, 4:-2][np.arange(wide) < lens[s, None]]
            blobs.append(struct.pack("<I", y - x) + lens[s].tobytes() + lo[s].astype("<i8").tobytes() + hi[s].astype("<i8").tobytes() + body.tobytes())
        # what the chunk itself has to remember: of each segment, its row, its place there and which of its bucket's it is
        used = np.unique(doc)
        memo = struct.pack("<II", len(used), len(owner)) + rids[used].astype("<i8").tobytes() + ids[used].astype("<i8").tobytes()
        for x in (np.searchsorted(used, doc), heads - starts[doc], of[owner], owner - at[np.searchsorted(some, of[owner])]):
            memo += x.astype("<u4").tobytes()
        return _rows(left.column("chunk")[0].as_py(), [*some.tolist(), -2], [*blobs, memo])

    both = shared.unionByName(copies)
    sent = stash(by_chunk(both).applyInArrow(send_segments, MESSAGE), "suffix_segments")

    def group_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in by_bucket(batches):
            lens, lo, hi, body, chunk, nth = [], [], [], [], [], []
            for k, d in held:
                (n,) = struct.unpack_from("<I", d)
                lens.append(np.frombuffer(d, np.uint8, n, 4))
                lo.append(np.frombuffer(d, "<i8", n, 4 + n))
                hi.append(np.frombuffer(d, "<i8", n, 4 + 9 * n))
                body.append(np.frombuffer(d, np.uint8, offset=4 + 17 * n))
                chunk.append(np.full(n, k))
                nth.append(np.arange(n))
            lens, lo, hi, body, chunk, nth = map(np.concatenate, (lens, lo, hi, body, chunk, nth))
            uniq, of = distinct(lens, body)
            text, ends = uniq
            least = np.full(len(ends), NO_ID)
            np.minimum.at(least, of, lo)
            found = least_of_equal(text, ends, least, length)
            # runs of places with one value, of each distinct segment
            own = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
            change = np.r_[True, (found[1:] != found[:-1]) | (own[1:] != own[:-1]), True]
            a, b = np.flatnonzero(change[:-1] & (found < NO_ID)), np.flatnonzero(change[1:] & (found < NO_ID)) + length
            u = own[a]
            value, base = found[a], np.r_[0, ends[:-1]][u]
            a, b = a - base, b - base
            # and of every chunk's segments, where one of its ids is greater
            runs = np.bincount(u, minlength=len(ends))
            first = np.cumsum(runs) - runs
            k = runs[of]
            s = np.repeat(np.arange(len(of)), k)
            r = np.repeat(first[of] - (np.cumsum(k) - k), k) + np.arange(k.sum())
            good = value[r] < hi[s]
            s, r = s[good], r[good]
            cut = np.flatnonzero(np.r_[True, chunk[s][1:] != chunk[s][:-1]]) if len(s) else np.zeros(0, int)
            blobs = []
            for x, y in zip(cut, np.r_[cut[1:], len(s)]):
                z = slice(x, y)
                blobs.append(struct.pack("<I", y - x) + b"".join(v.astype("<u4").tobytes() for v in (nth[s[z]], a[r[z]], b[r[z]])) + value[r[z]].astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(chunk[s[cut]], pa.int64()), pa.array([bucket] * len(cut), pa.int32()), pa.array(blobs, pa.binary())], ["chunk", "bucket", "data"])

    answers = _spread(sent.where("bucket >= 0")).mapInArrow(group_equal, MESSAGE)

    def spans_of(rows: pa.Table) -> pa.Table:
        kinds = rows.column("bucket").to_pylist()
        data = rows.column("data").to_pylist()
        empty = pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32())], ["chunk", "rid", "first", "last"])
        memo = next((d for k, d in zip(kinds, data) if k == -2), None)
        got = [(k, d) for k, d in zip(kinds, data) if k >= 0]
        if memo is None or not got:
            return empty
        n_rows, n = struct.unpack_from("<II", memo)
        rids, ids = (np.frombuffer(memo, "<i8", n_rows, 8 + 8 * n_rows * i) for i in range(2))
        row, start, bucket, nth = (np.frombuffer(memo, "<u4", n, 8 + 16 * n_rows + 4 * n * i).astype(np.int64) for i in range(4))
        keys, froms, tos, least = [], [], [], []
        for k, d in got:
            (m,) = struct.unpack_from("<I", d)
            s, a, b = (np.frombuffer(d, "<u4", m, 4 + 4 * m * i).astype(np.int64) for i in range(3))
            keys.append(k << 32 | s)
            froms.append(a)
            tos.append(b)
            least.append(np.frombuffer(d, "<i8", m, 4 + 12 * m))
        key, a, b, least = map(np.concatenate, (keys, froms, tos, least))
        order = np.argsort(key, kind="stable")
        key, a, b, least = key[order], a[order], b[order], least[order]
        asked = bucket << 32 | nth
        lo, hi = np.searchsorted(key, asked, "left"), np.searchsorted(key, asked, "right")
        k = hi - lo
        occurrence = np.repeat(np.arange(n), k)
        at = np.repeat(lo - (np.cumsum(k) - k), k) + np.arange(k.sum())
        good = least[at] < ids[row[occurrence]]
        occurrence, at = occurrence[good], at[good]
        r, f, t = row[occurrence], start[occurrence] + a[at], start[occurrence] + b[at]
        if not len(r):
            return empty
        order = np.lexsort((f, r))
        r, f, t = r[order], f[order], t[order]
        far = 1 << 40  # rows apart, so that a running maximum stays within the row
        reach = np.maximum.accumulate(t + r * far)
        head = np.r_[True, f[1:] + r[1:] * far > reach[:-1]]
        tail = np.r_[head[1:], True]
        chunk = rows.column("chunk")[0].as_py()
        return pa.table([pa.array([chunk] * int(head.sum()), pa.int64()), pa.array(rids[r[head]], pa.int64()), pa.array(f[head].astype(np.int32)), pa.array((reach[tail] - r[tail] * far).astype(np.int32))], ["chunk", "rid", "first", "last"])

    found = sent.where("bucket = -2").unionByName(answers).groupBy("chunk").applyInArrow(spans_of, "chunk long, rid long, first int, last int")
    whole = copies.select("chunk", F.conv(F.hex("data"), 16, 10).cast("long").alias("rid"), F.lit(0).alias("first"), F.lit((1 << 31) - 1).alias("last"))

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        spans: dict[int, list[tuple[int, int]]] = {}
        for r, a, b in zip(*(right.column(x).to_pylist() for x in ("rid", "first", "last"))):
            spans.setdefault(r, []).append((a, b))
        size, gone, pieces, kept, sha = [], [], [], [], []
        for r, t in zip(left.column("rid").to_pylist(), left.column("text").to_pylist()):
            own = sorted((a, min(b, len(t))) for a, b in spans.get(r, ()))
            rest, at = [], 0
            for a, b in own:
                rest.append(t[at:a])
                at = b
            rest = b"".join([*rest, t[at:]])
            size.append(len(t))
            gone.append(len(t) - len(rest))
            pieces.append([{"start": a, "end": b} for a, b in own])
            kept.append(rest)
            sha.append(hashlib.sha256(rest).hexdigest())
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        columns = [left.column("id"), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(map(len, pieces), pa.int64()), pa.array(pieces, span), pa.array(kept, pa.binary()), pa.array(sha, pa.string())]
        return pa.Table.from_arrays(columns, ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept", "kept_sha256"])

    schema = "id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept binary, kept_sha256 string"
    return by_chunk(found.unionByName(whole)).applyInArrow(cut, schema).withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removals(documents(spark, sf_dir)).drop("spans", "kept")


ORACLE = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, {2 * LENGTH}) AS s FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - {LENGTH - 1}, 0))) AS i FROM d)),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM w),
g AS (SELECT DISTINCT doc_id, i + k AS i FROM m, range(0, {LENGTH}) r(k) WHERE least < doc_id),
r AS (SELECT doc_id, count(*) AS n, count_if(last IS NULL OR last < i - 1) AS runs FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS last FROM g) GROUP BY doc_id),
b AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS x FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2)) AS i FROM d)),
k AS (SELECT b.doc_id, string_agg(x, '' ORDER BY b.i) AS h FROM b LEFT JOIN g ON b.doc_id = g.doc_id AND b.i = g.i WHERE g.i IS NULL GROUP BY b.doc_id)
SELECT d.doc_id, (len(d.h) // 2)::BIGINT AS n_bytes, coalesce(r.n, 0)::BIGINT AS n_removed, coalesce(runs, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.h, ''))) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)
"""
