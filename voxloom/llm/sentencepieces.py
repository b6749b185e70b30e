"""SentencePiece encoding and decoding with a relational lattice.

A text is put in the model's form (spaces become the mark, one mark goes first) and cut into
units that no piece crosses: marks and the letters or the other characters that follow.
Every distinct unit is a word of the lattice: its substrings, no longer than the longest piece
with their first PREFIX characters, are exploded and equi-joined to the piece table, the edges so
found are grouped by unit, and a fold with Spark's higher-order aggregate picks the segmentation.

For a unigram model the fold is Viterbi: at each place the best sum of scores, of equals the path
whose last piece is longest. For a BPE model no sum of scores gives the model's own encoding, which
merges, again and again, the best-scored pair of neighbours, the first of equals; there
the fold makes these merges over the edges in order of rank. Characters without a piece become byte
pieces.

Texts are read once: each task cuts its rows into chunks of about CHUNK_BYTES and writes a row for
each, in which texts are lists of word numbers, words lists of unit numbers. Units among
the most frequent of a sample (CACHED of them at most) are encoded first and broadcast; the
others go to the lattice with the chunks that have them and their places there, and their ids go
back to these chunks, where the bucketed table of chunks stays. A unit that very many chunks have goes
in several parts. Units of more than LONG characters, whose lattice would be too much for one row,
are encoded in place, by a heap (BPE) or a Viterbi loop with the same rules.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bucketed, c, documents, slices

MARK = "▁"
LETTERS = "a-zA-Z\u00c0-\u024f"
FINE = re.compile(f"{MARK}*[{LETTERS}]+|{MARK}*[^{MARK}\\n{LETTERS}]+|{MARK}+|\\n")
COARSE = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
WHOLE = re.compile("(?s).+")
CACHED, SAMPLE_CHARS, CHUNK_BYTES, LONG, PREFIX, CHUNKS_A_PART, UNITS_A_TASK = 200_000, 30_000_000, 6 << 20, 250, 4, 8192, 50_000
MOST_BROADCAST = 1_000_000
#: Bits of an edge, a long: rank (BPE) or end (unigram) of 22, start of 8, length of 8, odd of 1, id of 21.
RANK_AT, START_AT, SIZE_AT, ODD_AT = 38, 30, 22, 21
NO_RANK, SPELT = (1 << 22) - 1, (1 << 21) - 1
NEXT = (1 << 32) - 1
NTH_BITS = 24  # of a unit's place among the rare ones of a chunk
MASKED = 61  # characters of units whose boundaries fit the bits of a long


@dataclass(frozen=True)
class Model:
    pieces: tuple[str, ...]  # by id
    scores: tuple[float, ...]
    usable: tuple[bool, ...]  # those that a text can be cut into
    bytes_at: int | None  # id of the first byte piece
    unknown: int
    bpe: bool

    @property
    def units(self) -> re.Pattern:
        """The finest way to cut texts that no piece crosses."""
        own = [p for p, u in zip(self.pieces, self.usable) if u]
        return next(x for x in (FINE, COARSE, WHOLE) if all(x.fullmatch(p) for p in own))

    @property
    def longest(self) -> int:
        return max(len(p) for p, u in zip(self.pieces, self.usable) if u)

    @property
    def unknown_score(self) -> float:
        """What a character without a piece costs in a unigram model."""
        return min(s for s, u in zip(self.scores, self.usable) if u) - 10

    def order(self) -> np.ndarray:
        """The rank of each piece's score, the best first."""
        return np.unique(-np.array(self.scores), return_inverse=True)[1]

    def ranks(self) -> dict[str, tuple[int, int]]:
        """(rank, id) of each piece."""
        order = self.order()
        return {p: (int(order[i]), i) for i, (p, u) in enumerate(zip(self.pieces, self.usable)) if u}

    def odd(self) -> set[str]:
        """Pieces that may come to be by a merge of a part that ranks after them."""
        ranks = self.ranks()
        rank = lambda x: (ranks[x][0] if len(x) > 1 else -1) if x in ranks else None
        out = set()
        for p, (r, _) in ranks.items():
            for k in range(1, len(p)):
                a, b = rank(p[:k]), rank(p[k:])
                if a is not None and b is not None and max(a, b) >= r:
                    out.add(p)
        return out


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value) of a protocol buffer message; only numbers and lengths of bytes are told apart."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at : at + size]
            at += size


def load_model(path: str) -> Model:
    """Reads the pieces of a model file, and from its settings whether it is BPE or unigram. Files with
    settings that encode() doesn't follow are refused: another kind of model, normalization, removal
    of white space, a mark that goes last or not at all, user-defined pieces, no byte pieces."""
    import sentencepiece

    with open(path, "rb") as f:
        fields = list(message_fields(f.read()))
    # field numbers and defaults of the public message definition
    trainer, normal = ({k: v for n, d in fields if n == field for k, v in message_fields(d)} for field in (2, 3))
    kinds = {dict(message_fields(d)).get(3, 1) for n, d in fields if n == 1}
    kind = trainer.get(3, 1)
    faults = {
        "its kind of model": kind not in (1, 2), "normalization": bool(normal.get(2)), "no mark in front": normal.get(3, 1) == 0, "removal of white space": normal.get(4, 1) == 1,
        "spaces that stay": normal.get(5, 1) == 0, "a mark behind": trainer.get(24, 0) == 1, "user-defined pieces": 4 in kinds, "no byte pieces": 6 not in kinds,
    }
    if any(faults.values()):
        raise ValueError(f"{path} can't be used: {', '.join(k for k, v in faults.items() if v)}")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    byte_ids = [i for i in range(n) if sp.is_byte(i)]
    usable = tuple(not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n))
    return Model(tuple(sp.id_to_piece(i) for i in range(n)), tuple(sp.get_score(i) for i in range(n)), usable, byte_ids[0], sp.unk_id(), kind == 2)


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def words_of(text: str, pattern: re.Pattern) -> list[str]:
    """Words such that the units of MARK + word, one word after another, are those of the text."""
    if not text:
        return []
    if pattern is WHOLE:
        return [marked(text)[1:]]
    if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
        return [x[1:] for x in COARSE.findall(marked(text))]
    return text.split(" ")


def merge(unit: str, ranks: dict[str, tuple[int, int]], spell) -> list[int]:
    """BPE of one unit with a heap: for units too long for a row's lattice."""
    n = len(unit)
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(a: int) -> None:
        if a >= 0 and ends[a] < n and (e := ranks.get(unit[a : ends[ends[a]]])):
            heapq.heappush(heap, (e[0], a, ends[a], ends[ends[a]]))

    for a in range(n - 1):
        offer(a)
    while heap:
        _, a, mid, end = heapq.heappop(heap)
        if before[a] is None or ends[a] != mid or mid >= n or before[mid] is None or ends[mid] != end:
            continue
        ends[a], before[mid] = end, None
        if end < n:
            before[end] = a
        offer(before[a])
        offer(a)
    out, a = [], 0
    while a < n:
        out += [ranks[x][1]] if (x := unit[a : ends[a]]) in ranks else spell(x)
        a = ends[a]
    return out


def best_path(unit: str, ranks: dict[str, tuple[int, int]], model: Model, spell) -> list[int]:
    """Viterbi of one unit, for units too long for a row's lattice."""
    low, longest = model.unknown_score, model.longest
    best, took = [0.0], [(0, None)]
    for e in range(1, len(unit) + 1):
        top, of = -np.inf, None
        for s in range(max(0, e - longest), e):  # the first of equals stays
            hit = ranks.get(unit[s:e])
            if hit or s == e - 1:
                score = best[s] + (model.scores[hit[1]] if hit else low)
                if of is None or score > top:
                    top, of = score, (s, hit[1] if hit else None)
        best.append(top)
        took.append(of)
    out, e = [], len(unit)
    while e:
        s, i = took[e]
        out.append([i] if i is not None else spell(unit[s:e]))
        e = s
    return [i for x in reversed(out) for i in x]


def id_bytes(model: Model) -> int:
    return 2 if len(model.pieces) < 1 << 16 else 3


def lattice(units: DataFrame, model: Model) -> DataFrame:
    """units (unit and part, together distinct, none empty or longer than LONG, and places) with edges: a long
    for each substring that is a piece, and for each character that is none, in order of rank (BPE) or of
    end and start (unigram). Grouping needs no exchange where units come dealt by unit and part."""
    if len(model.pieces) > SPELT or model.longest > LONG:
        raise ValueError("too many or too long pieces")
    spark, odd = units.sparkSession, model.odd() if model.bpe else set()
    own, reach = [], {}
    for p, (rank, i) in model.ranks().items():
        high = 0 if not model.bpe else rank if len(p) > 1 else NO_RANK
        own.append((p, high << RANK_AT | (p in odd) << ODD_AT | i))
        if len(p) >= PREFIX:
            reach[p[:PREFIX]] = max(len(p), reach.get(p[:PREFIX], 0))
    pieces = spark.createDataFrame(pa.table([pa.array([p for p, _ in own]), pa.array([x for _, x in own], pa.int64())], ["piece", "cell"]))
    heads = spark.createDataFrame(pa.table([pa.array(list(reach), pa.string()), pa.array(list(reach.values()), pa.int32())], ["head", "most"]))
    if len(own) <= MOST_BROADCAST:
        pieces, heads = F.broadcast(pieces), F.broadcast(heads)
    starts = units.select("unit", "part", "places", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("s"))
    starts = starts.withColumn("head", F.expr(f"substring(unit, s + 1, {PREFIX})")).join(heads, "head", "left")
    most = F.least(F.coalesce("most", F.lit(PREFIX - 1)), F.length("unit") - F.col("s"))
    spans = starts.select("unit", "part", "places", "s", F.explode(F.sequence(F.lit(1), most)).alias("l"))
    # the places go with one row of each unit
    spans = spans.select("unit", "part", F.expr("if(s = 0 AND l = 1, places, NULL)").alias("places"), "s", "l", F.expr("substring(unit, s + 1, l)").alias("piece"))
    found = spans.join(pieces, "piece", "left").where("cell IS NOT NULL OR l = 1")
    spelt = (NO_RANK << RANK_AT if model.bpe else 0) | SPELT
    end = "" if model.bpe else f" + shiftleft(bigint(s + l), {RANK_AT})"
    edge = F.expr(f"coalesce(cell, {spelt}L) + shiftleft(bigint(s), {START_AT}) + shiftleft(bigint(l), {SIZE_AT}){end}")
    return found.groupBy("unit", "part").agg(F.first("places", ignorenulls=True).alias("places"), F.sort_array(F.collect_list(edge)).alias("edges"))


def _start(x: str) -> str:
    return f"int(shiftrightunsigned({x}, {START_AT}) & 255)"


def _size(x: str) -> str:
    return f"int(shiftrightunsigned({x}, {SIZE_AT}) & 255)"


class Mask:
    """Where symbols begin and end, as bits of a long. Negative: not known."""

    unknown = "-1L"
    first = "shiftleft(1L, length(unit) + 1) - 1L"

    @staticmethod
    def _ends(x: str) -> str:
        return f"(shiftleft(1L, {_start(x)}) | shiftleft(1L, {_start(x)} + {_size(x)}))"

    @staticmethod
    def _all(x: str) -> str:
        return f"shiftleft(shiftleft(1L, {_size(x)} + 1) - 1L, {_start(x)})"

    def pair(self, b: str, x: str) -> str:
        """Whether edge x is two neighbouring symbols."""
        return f"(({b} & {self._ends(x)}) = {self._ends(x)} AND bit_count({b} & {self._all(x)}) = 3)"

    def joined(self, b: str, x: str) -> str:
        return f"(({b} & ~{self._all(x)}) | {self._ends(x)})"

    def symbol(self, b: str, x: str) -> str:
        return f"({b} & {self._all(x)}) = {self._ends(x)}"


class Letters(Mask):
    """The same as a text of 0 and 1, for longer units."""

    unknown = "''"
    first = "repeat('1', length(unit) + 1)"

    def pair(self, b: str, x: str) -> str:
        return f"substring({b}, {_start(x)} + 1, {_size(x)} + 1) RLIKE '^10*10*1$'"

    def joined(self, b: str, x: str) -> str:
        return f"concat(substring({b}, 1, {_start(x)} + 1), repeat('0', {_size(x)} - 1), substring({b}, {_start(x)} + {_size(x)} + 1))"

    def symbol(self, b: str, x: str) -> str:
        return f"substring({b}, {_start(x)} + 1, {_size(x)} + 1) = concat('1', repeat('0', {_size(x)} - 1), '1')"


def _fold_bpe(df: DataFrame) -> DataFrame:
    """df with path: the edges of BPE's symbols. Merges are made in one pass over the edges in order of
    rank. That is BPE's order unless a merge makes a pair that ranks no later than itself, which only
    the odd edges can be; such units, found in passing, are merged by rounds, each of which takes the
    first edge that is a pair."""
    df = df.withColumn("merges", F.expr(f"filter(edges, x -> shiftrightunsigned(x, {RANK_AT}) < {NO_RANK}L)"))
    df = df.withColumn("odd", F.expr(f"filter(merges, x -> (x & {1 << ODD_AT}L) <> 0L)"))
    for name, board, fits in (("mask", Mask(), f"length(unit) <= {MASKED}"), ("letters", Letters(), f"length(unit) > {MASKED}")):
        late = f"exists(odd, y -> shiftrightunsigned(y, {RANK_AT}) <= shiftrightunsigned(x, {RANK_AT}) AND {board.pair('c', 'y')})"
        after = f"if(size(odd) = 0, {board.joined('b', 'x')}, element_at(transform(array({board.joined('b', 'x')}), c -> if({late}, {board.unknown}, c)), 1))"
        once = f"aggregate(merges, {board.first}, (b, x) -> if(b <> {board.unknown} AND {board.pair('b', 'x')}, {after}, b))"
        best = f"get(filter(merges, x -> {board.pair('b', 'x')}), 0)"
        rounds = f"aggregate(sequence(1, length(unit)), {board.first}, (b, k) -> element_at(transform(array({best}), x -> if(x IS NULL, b, {board.joined('b', 'x')})), 1))"
        df = df.withColumn(name, F.expr(f"if({fits}, {once}, NULL)"))
        df = df.withColumn(name, F.expr(f"if({name} = {board.unknown}, {rounds}, {name})"))
    # each column is named twice: what is named once is put in place, here into the lambda, and computed for each edge
    symbol = f"CASE WHEN mask IS NOT NULL THEN {Mask().symbol('mask', 'x')} WHEN letters IS NOT NULL THEN {Letters().symbol('letters', 'x')} END"
    return df.withColumn("path", F.expr(f"sort_array(transform(filter(edges, x -> {symbol}), x -> x & {(1 << RANK_AT) - 1}L))")).drop("merges", "odd", "mask", "letters", "edges")


def _fold_viterbi(df: DataFrame, model: Model) -> DataFrame:
    """df with path: the edges of the best path. best[e] is the best score of a path to e and took[e] its
    last edge; edges come by end and start, and the first of equal ones stays."""
    scores = ",".join(repr(float(s)) for s in model.scores)
    score = f"if((x & {SPELT}L) = {SPELT}L, {model.unknown_score!r}D, from_json('[{scores}]', 'array<double>')[int(x & {SPELT}L)])"
    end = f"int(shiftrightunsigned(x, {RANK_AT}))"
    new = f"a.best[{_start('x')}] + {score}"
    step = f"""if(size(a.best) = {end}, struct(concat(a.best, array({new})) AS best, concat(a.took, array(x)) AS took),
      if({new} > a.best[{end}], struct(concat(slice(a.best, 1, {end}), array({new})) AS best, concat(slice(a.took, 1, {end}), array(x)) AS took), a))"""
    df = df.withColumn("took", F.expr(f"aggregate(edges, struct(array(0D) AS best, array(0L) AS took), (a, x) -> {step}).took"))
    back = f"if(a.e = 0, a, struct({_start('took[a.e]')} AS e, concat(array(took[a.e]), a.path) AS path))"
    path = f"aggregate(sequence(1, length(unit)), struct(length(unit) AS e, cast(array() AS array<bigint>) AS path), (a, k) -> {back}).path"
    return df.withColumn("path", F.expr(path)).drop("took", "edges")


def encode_units(units: DataFrame, model: Model) -> DataFrame:
    """units, as lattice() has them, with ids: id_bytes() for each."""
    width = 2 * id_bytes(model)
    found = lattice(units, model)
    found = _fold_bpe(found) if model.bpe else _fold_viterbi(found, model)
    if model.bytes_at is None:
        spelt = f"'{model.unknown:0{width}X}'"
    else:
        hexed = f"hex(encode(substring(unit, {_start('p')} + 1, 1), 'UTF-8'))"
        spelt = f"array_join(transform(sequence(0, length({hexed}) div 2 - 1), k -> lpad(hex(int(conv(substring({hexed}, 2 * k + 1, 2), 16, 10)) + {model.bytes_at}), {width}, '0')), '')"
    ids = f"unhex(array_join(transform(path, p -> if((p & {SPELT}L) = {SPELT}L, {spelt}, lpad(hex(p & {SPELT}L), {width}, '0'))), ''))"
    return found.withColumn("ids", F.expr(ids)).drop("path")


def unpacked(ids: bytes, width: int) -> np.ndarray:
    powers = np.array([1 << 8 * i for i in range(width - 1, -1, -1)], dtype=np.int32)
    return np.frombuffer(ids, np.uint8).reshape(-1, width).astype(np.int32) @ powers


def planes(x: np.ndarray) -> bytes:
    """Numbers below 2^32 as their four bytes, all first bytes first, which compress better so."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def gathered(flat: np.ndarray, ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs `which` of flat, of which run i is flat[ends[i] : ends[i + 1]], one after another, and their lengths."""
    sizes = np.diff(ends)[which]
    upto = np.cumsum(sizes)
    return flat[np.repeat(ends[which] - (upto - sizes), sizes) + np.arange(upto[-1] if len(which) else 0)], sizes


def pack(batches: Iterator[pa.RecordBatch], width: int, most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """(place, ids) as (chunk, data), a row for each chunk and at most `most` rows: what goes back to a chunk from
    one task, compressed."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        place = table.column("place").to_numpy()
        order = np.argsort(place)
        place, ids = place[order], table.column("ids").to_pylist()
        ids = [ids[i] for i in order.tolist()]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // width
        chunk, nth = place >> NTH_BITS, place & ((1 << NTH_BITS) - 1)
        cuts = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1], True]).tolist()
        blobs = [zlib.compress(struct.pack("<I", b - a) + planes(np.diff(nth[a:b], prepend=0)) + planes(sizes[a:b]) + b"".join(ids[a:b]), 1) for a, b in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(chunk[cuts[:-1]]), pa.array(blobs, pa.binary())], ["chunk", "data"])

    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= most:
            yield packed(held)
            held, n = [], 0
    if held:
        yield packed(held)


def unpack(blobs: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a chunk's rare units in their order, one after another, and how many each has."""
    nths, sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
    for blob in map(zlib.decompress, blobs):
        (n,) = struct.unpack_from("<I", blob)
        nths.append(np.cumsum(from_planes(blob[4 : 4 + 4 * n])))
        sizes.append(from_planes(blob[4 + 4 * n : 4 + 8 * n]))
        ids.append(blob[4 + 8 * n :])
    nth, sizes = np.concatenate(nths), np.concatenate(sizes)
    order = np.argsort(nth)
    return gathered(unpacked(b"".join(ids), width), np.r_[0, np.cumsum(sizes)], order)[0], sizes[order]


def _frequent(texts: DataFrame, units: re.Pattern, cached: int) -> DataFrame | None:
    """The most frequent units of a sample of about SAMPLE_CHARS characters. What is drawn only decides
    which way a unit's ids come."""
    n = texts.count()
    if not n or not cached:
        return None
    mean = texts.where(F.rand(9) < min(1.0, 2000 / n)).agg(F.avg(F.length("text"))).first()[0] or 1.0
    drawn = texts.where(F.rand(10) < min(1.0, SAMPLE_CHARS / mean / n)).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for t in batch.column("text").to_pylist():
                counts.update(units.findall(marked(t)))
        short = [(u, k) for u, k in counts.items() if len(u) <= LONG]
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in short], pa.string()), pa.array([k for _, k in short], pa.int64())], ["unit", "n"])

    return drawn.mapInArrow(run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "unit").limit(cached).select("unit")


class Cutter:
    """Cuts the texts of a chunk into words and units."""

    def __init__(self, model: Model, have: dict[str, int]):
        self.model, self.have, self.pattern, self.ranks = model, have, model.units, None

    def encode_long(self, unit: str) -> list[int]:
        self.ranks = self.ranks or self.model.ranks()
        low = self.model.bytes_at
        spell = (lambda x: [b + low for b in x.encode()]) if low is not None else (lambda x: [self.model.unknown])
        return merge(unit, self.ranks, spell) if self.model.bpe else best_path(unit, self.ranks, self.model, spell)

    def cut(self, texts: list[str]) -> tuple[dict[str, bytes], list[str]]:
        """words of each text, numbers of these words among the distinct ones, units of each distinct word, numbers
        of these units (the cached ones first, then the rare ones of this chunk, then its long ones; NEXT where a
        rare one comes for the first time), the ids of the long ones and their lengths; and the rare ones."""
        words = [words_of(t, self.pattern) for t in texts]
        flat = [w for ws in words for w in ws]
        place = dict.fromkeys(flat)
        for n, w in enumerate(place):
            place[w] = n
        numbers = np.fromiter(map(place.__getitem__, flat), np.int64, len(flat))
        # the most frequent first, which makes the numbers small
        order = np.argsort(-np.bincount(numbers, minlength=len(place)), kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        distinct = list(place)
        have, findall, first = self.have, self.pattern.findall, len(self.have)
        rare: dict[str, int] = {}
        long: dict[str, int] = {}
        counts, refs = [], []
        for i in order.tolist():
            w = distinct[i]
            known = have.get(MARK + w)
            if known is not None:
                counts.append(1)
                refs.append(known)
                continue
            units = findall(MARK + w)
            counts.append(len(units))
            for u in units:
                known = have.get(u)
                if known is None and len(u) <= LONG:
                    known = rare.get(u)
                    if known is None:
                        known = NEXT
                        rare[u] = first + len(rare)
                elif known is None:
                    known = -1 - long.setdefault(u, len(long))
                refs.append(known)
        refs = np.array(refs, dtype=np.int64)
        refs = np.where(refs < 0, first + len(rare) - 1 - refs, refs)
        own = [self.encode_long(u) for u in long]
        parts = {
            "texts": np.array([len(ws) for ws in words]), "words": rank[numbers], "units": np.array(counts),
            "refs": refs, "own": np.array([i for x in own for i in x]), "own_sizes": np.array([len(x) for x in own]),
        }
        return {k: planes(v) for k, v in parts.items()}, list(rare)


PARTS = ("texts", "words", "units", "refs", "own", "own_sizes")


def encode(df: DataFrame, model: str | Model, id_col: str = "doc_id", text_col: str = "text", cached: int = CACHED, chunk_bytes: int = CHUNK_BYTES, decoded: bool = False) -> DataFrame:
    """id_col, ids (array of int), n_tokens and ids_crc32 (unsigned, of the ids as little-endian unsigned
    32-bit integers) of each row of df; with decoded also text_crc32, of the text that the ids decode to.

    ids are what the library gives for the model file. A null text counts as empty and has
    no ids. Null ids and repeated rows are rows like others. Other columns of df aren't
    read. An empty table gives an empty one. A very long text is a chunk of its own."""
    spark, model = df.sparkSession, load_model(model) if isinstance(model, str) else model
    rows = df.select(c(id_col).alias("id"), F.coalesce(c(text_col), F.lit("")).alias("text"))
    first = _frequent(rows.select("text"), model.units, cached)
    width = id_bytes(model)
    have: dict[str, int] = {}
    blobs: list[bytes] = []
    if first is not None:
        got = encode_units(first.withColumns({"part": F.lit(0), "places": F.lit(0)}).repartition("unit"), model).select("unit", "ids")
        for batch in got.toArrow().to_batches():  # at most `cached` rows
            have.update(zip(batch.column("unit").to_pylist(), range(len(have), len(have) + batch.num_rows)))
            blobs += batch.column("ids").to_pylist()
    units = spark.sparkContext.broadcast(have)
    known = spark.sparkContext.broadcast((unpacked(b"".join(blobs), width), np.cumsum([0, *(len(x) // width for x in blobs)])))
    id_type = rows.schema["id"].dataType

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, chunk = Cutter(model, units.value), TaskContext.get().partitionId() << 18
        held, size = [], 0

        def full() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            parts, rare = cutter.cut(table.column("text").to_pylist())
            ids = pa.ListArray.from_arrays(pa.array([0, table.num_rows], pa.int32()), table.column("id").combine_chunks())
            columns = [pa.array([chunk], pa.int64()), ids, pa.array([rare], pa.list_(pa.string())), pa.array([len(rare)], pa.int32()), *(pa.array([parts[x]], pa.binary()) for x in PARTS)]
            return pa.RecordBatch.from_arrays(columns, ["chunk", "id", "rare", "n_rare", *PARTS])

        for batch in batches:
            for piece in slices(batch, "text", chunk_bytes):
                if held and size + piece.column("text").nbytes > chunk_bytes:
                    yield full()
                    held, size, chunk = [], 0, chunk + 1
                held.append(piece)
                size += piece.column("text").nbytes
        if held:
            yield full()

    fields = [("chunk", T.LongType()), ("id", T.ArrayType(id_type)), ("rare", T.ArrayType(T.StringType())), ("n_rare", T.IntegerType()), *((x, T.BinaryType()) for x in PARTS)]
    table = bucketed(rows.mapInArrow(chunks, T.StructType([T.StructField(*x) for x in fields])), "pieces_chunks", "chunk")
    n, total = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_rare"), F.lit(0))).first()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // UNITS_A_TASK)  # small ones: a unit becomes many edges
    asked = table.select("chunk", F.posexplode("rare").alias("nth", "unit"))
    asked = asked.select("unit", F.expr(f"int(pmod(xxhash64(chunk), {max(1, n // CHUNKS_A_PART)}))").alias("part"), F.expr(f"shiftleft(chunk, {NTH_BITS}) + nth").alias("place"))
    asked = asked.repartition(tasks, "unit", "part").groupBy("unit", "part").agg(F.collect_list("place").alias("places"))
    answers = encode_units(asked, model).select(F.explode("places").alias("place"), "ids")
    answers = answers.mapInArrow(lambda batches: pack(batches, width), "chunk long, data binary")

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {x: left.column(x)[0] for x in left.column_names}
        texts, words, counts, refs, own, own_sizes = (from_planes(row[x].as_buffer().to_pybytes()) for x in PARTS)
        flat, ends = known.value
        rare, sizes = unpack(right.column("data").to_pylist(), width)
        if len(sizes) != row["n_rare"].as_py():
            raise RuntimeError(f"{len(sizes)} of {row['n_rare'].as_py()} units have ids")
        new = refs == NEXT
        refs[new] = len(ends) - 1 + np.arange(np.count_nonzero(new))
        flat = np.concatenate([flat, rare, own.astype(np.int32)])
        ends = np.concatenate([ends, ends[-1] + np.cumsum(np.r_[sizes, own_sizes], dtype=np.int64)])
        spelt, k = gathered(flat, ends, refs)  # the distinct words' ids
        upto = np.r_[0, np.cumsum(k)]
        every, k = gathered(spelt, upto[np.r_[0, np.cumsum(counts)]], words)
        cut = np.r_[0, np.cumsum(k)][np.r_[0, np.cumsum(texts)]]
        raw = every.astype("<u4")
        crc = [zlib.crc32(raw[a:b].data) for a, b in zip(cut.tolist(), cut[1:].tolist())]
        ids = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(every, pa.int32()))
        more = [pa.array([zlib.crc32(t) for t in Speller(model).texts(every, cut)], pa.int64())] if decoded else []
        return pa.Table.from_arrays([row["id"].values, ids, pa.array(np.diff(cut), pa.int64()), pa.array(crc, pa.int64()), *more], schema.fieldNames())

    figures = ["n_tokens", "ids_crc32", *["text_crc32"] * decoded]
    schema = T.StructType([rows.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType())), *(T.StructField(x, T.LongType()) for x in figures)])
    both = table.drop("rare").groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return both.applyInArrow(assemble, schema).withColumnRenamed("id", id_col)


class Speller:
    """The bytes of ids: the pieces' own, one after another."""

    def __init__(self, model: Model):
        spelt = []
        for i, p in enumerate(model.pieces):
            byte = model.bytes_at is not None and model.bytes_at <= i < model.bytes_at + 256
            spelt.append(bytes([i - model.bytes_at]) if byte else p.replace(MARK, " ").encode() if model.usable[i] else " ⁇ ".encode() if i == model.unknown else b"")
        self.flat, self.ends = np.frombuffer(b"".join(spelt), np.uint8), np.cumsum([0, *map(len, spelt)])

    def texts(self, ids: np.ndarray, cut: np.ndarray) -> Iterator[bytes]:
        """The text, in UTF-8, of each run of ids from one cut to the next; the space that encoding puts first goes."""
        every, sizes = gathered(self.flat, self.ends, ids)
        raw, at = every.tobytes(), np.r_[0, np.cumsum(sizes)][cut].tolist()
        for a, b in zip(at, at[1:]):
            yield raw[a + 1 : b] if raw[a : a + 1] == b" " and a < b else raw[a:b]


def decode(df: DataFrame, model: str | Model, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """df with text_col, the text of ids_col; null for null ids, empty for no ids."""
    model = load_model(model) if isinstance(model, str) else model
    own = [x for x in df.columns if x != text_col]
    schema = T.StructType([*(df.schema[x] for x in own), T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(model)
        for batch in batches:
            ids = batch.column(ids_col)
            cut = np.r_[0, np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))].astype(np.int64)
            texts = [t.decode("utf-8", "replace") if v else None for t, v in zip(speller.texts(ids.flatten().to_numpy(zero_copy_only=False), cut), ids.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*map(batch.column, own), pa.array(texts, pa.string())], schema.fieldNames())

    return df.mapInArrow(run, schema)


def round_trip(docs: DataFrame) -> DataFrame:
    """doc_id, ids, n_tokens, ids_crc32 and text_crc32, the crc32 of the text that the ids decode to."""
    import public_tokenizers

    return encode(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded=True)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir)).drop("ids")


def by_rank(model: Model) -> Model:
    """A unigram model of a BPE model's pieces: the log-probability of a piece falls with its rank, as Zipf's
    law has it. Nothing is trained; it lets texts be cut by the best sum of scores."""
    order = model.order()
    used = np.log(np.sum(1.0 / (order[list(model.usable)] + 2.0)))
    return replace(model, scores=tuple((-np.log(order + 2.0) - used).tolist()), bpe=False)


def viterbi_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures for texts cut by Viterbi, with the unigram model of the file's pieces."""
    import public_tokenizers

    return encode(documents(spark, sf_dir), by_rank(load_model(public_tokenizers.path("piece_bpe_32k.model"))), decoded=True).drop("ids")
