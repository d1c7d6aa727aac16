"""Shingle-set Jaccard join by vertical partitioning of the global shingle order, with partial overlaps summed per pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthframe.llm.common import arrow_map, saved
from growthframe.llm.components import connected_components

#: Shingles that are looked at together when frequent ones are counted.
CHUNK = 1 << 21
#: Bytes of joined texts that are taken at a time.
JOINED = 1 << 20
#: Frequent shingles that the global order knows by their count (16 bytes each: a broadcast of 8 MiB at most).
FREQUENT = 1 << 19
#: Fragments of the global order.
FRAGMENTS = 8
#: Sets of one shared shingle that are compared with one another at a time; those that are compared first; sets that all blocks of the latter hold.
BLOCK, HOME, LEADERS = 768, 256, 4
#: Blocks to which one copy of a set's text goes.
CELLS = 1024
#: Shared marks that travel with a set, by which a pair is known to be met elsewhere too; of a set with more of them, the first
#: ones and the last ones before the one at hand (only saves work).
LISTED, FIRST, LAST = 64, 4, 10
#: Bits of a parity sketch at most (only saves work).
SKETCH = 1 << 12
#: Bits, at most, of the table by which tasks drop texts that no block needs (only saves work).
SIEVE = 1 << 25
#: Cells of a matrix of sets by shingles that are multiplied at a time.
CELL_RUN = 1 << 22

#: Where the size classes begin: each reaches a quarter further than its first size.
_EDGES = [1]
while _EDGES[-1] < 1 << 40:
    _EDGES.append(max(_EDGES[-1] + 1, _EDGES[-1] * 5 // 4))
_EDGES = np.array(_EDGES)

_RANDOM = np.random.default_rng(20240412)
_VALUE = _RANDOM.integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]  # A-Z as a-z
_SOLID = np.ones(256, bool)
_SOLID[[32, *range(9, 14)]] = False
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(1 << 16, b, np.uint64)])) for b in (_BASE, pow(_BASE, -1, 1 << 64))]


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(odd)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    while len(_POWERS[0]) <= n:
        for k, p in enumerate(_POWERS):
            _POWERS[k] = np.concatenate([p, p * p[-1] * p[1]])
    return _POWERS


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of joined texts, and where each begins: polynomials of the bytes, from prefix sums."""
    change = np.flatnonzero(np.diff(_SOLID[data].view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    begin, end = change[::2], change[1::2]
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[:len(data)], out=total[1:])
    return _mixed((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64)), begin


def _shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingles of all texts, each with the number of its text, in order of both.

    A text of fewer words has its whole sequence as its one shingle; one without words has none."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    words, begin = _words(data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    whose = np.searchsorted(ends, begin, "right")
    n = np.bincount(whose, minlength=len(texts))
    first = np.cumsum(n) - n
    some, few = np.flatnonzero(n >= width), np.flatnonzero((n > 0) & (n < width))
    count = n[some] - width + 1
    doc = np.repeat(some, count)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[doc]

    def together(at: np.ndarray, length: int) -> np.ndarray:
        h = np.full(len(at), length, np.uint64)
        for k in range(length):
            h = _mixed(h * np.uint64(_BASE) + words[at + k])
        return h

    ids, docs = [together(at, width)], [doc]
    for length in range(1, width):
        short = few[n[few] == length]
        ids.append(together(first[short], length))
        docs.append(short)
    ids, doc = np.concatenate(ids), np.concatenate(docs)
    order = np.lexsort((ids, doc))
    ids, doc = ids[order], doc[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (doc[1:] != doc[:-1])
    return ids[new], doc[new]


def _chunks(texts: list) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about JOINED bytes, with the number of the first; a longer text stands alone."""
    first, held, size = 0, [], 0
    for t in texts:
        if held and size + len(t or b"") > JOINED:
            yield first, held
            first, held, size = first + len(held), [], 0
        held.append(t or b"")
        size += len(held[-1])
    if held:
        yield first, held


def frequent(docs: DataFrame, width: int) -> DataFrame:
    """``(token, n)``: the shingles that most texts hold, about; at most ``FREQUENT`` of them.

    Tasks send what they meet in two texts or more of a chunk. Only the global order rests on the counts: any order gives
    the same links."""

    def counted(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if parts:
            flat = np.sort(np.concatenate(parts))
            first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
            n = np.diff(np.append(first, len(flat)))
            yield pa.record_batch([pa.array(flat[first[n > 1]].view(np.int64)), pa.array(n[n > 1])], names=["token", "n"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for _, texts in _chunks(batch.column(0).to_pylist()):
                parts.append(_shingles(texts, width)[0])
                size += len(parts[-1])
                if size >= CHUNK:
                    yield from counted(parts)
                    parts, size = [], 0
        yield from counted(parts)

    met = arrow_map(docs.select(F.col("text").cast("binary")), of, "token long, n long")
    return met.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(FREQUENT)


class Order:
    """The global order: shingles that aren't known as frequent by their value, then the frequent ones by count and value."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order]

    def count(self, ids: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(ids), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, ids), len(self.tokens) - 1)
        return np.where(self.tokens[at] == ids, self.counts[at], 0)

    def sort(self, ids: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, docs), in order of both, with each document's shingles in the global order."""
        n = self.count(ids)
        rare = n == 0
        key = np.where(rare, 0, 1)
        known = np.flatnonzero(~rare)
        if len(known):  # rare ones keep their places among themselves
            order = np.lexsort((ids, n, key, docs))
            return ids[order], docs[order]
        return ids, docs

    def fragment(self, ids: np.ndarray) -> np.ndarray:
        """The order is cut at equal distances of value, and before the frequent shingles."""
        return np.where(self.count(ids) > 0, FRAGMENTS - 1, (ids >> np.uint64(32)).astype(np.int64) * (FRAGMENTS - 1) >> 32)


def _signature(ids: np.ndarray) -> np.ndarray:
    return _mixed(ids * np.uint64(0xD6E8FEB86659FD93) + np.uint64(99))


def _most_apart(total, percent: int):
    """A bound on the number of shingles that only one of two linked sets holds; ``total``: the sum of their sizes."""
    return total * (100 - percent) // (100 + percent)


def _marks(ids: np.ndarray, doc: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(marks, how many of each set): hashes of what a set holds in each part of the order of values.

    For a class of sizes the order is cut into one part more than linked sets can differ in shingles if the larger one
    is of that class, so that linked sets agree in a whole part. A set takes part in its own class and in those that a larger
    set linked with it may be of. Where linked sets are equal there are no marks."""
    parts = np.append(_most_apart(2 * (_EDGES[1:] - 1), percent) + 1, 1)
    own, last = (np.searchsorted(_EDGES, k, "right") - 1 for k in (n, 100 * n // percent))
    value, place = _mixed(ids ^ np.uint64(_BASE)), ids >> np.uint64(32)
    marks, whose = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for further in range(int((last - own).max(initial=-1)) + 1):
        sort = own + further
        many = np.where((n > 0) & (sort <= last), parts[np.minimum(sort, len(parts) - 1)], 0)
        many[many == 1] = 0
        start = np.cumsum(many) - many
        taking = many[doc] > 0
        whole = doc[taking]
        cell = start[whole] + (place[taking] * many[whole].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        # sums of halves are exact in doubles
        low, high = (np.bincount(cell, half.astype(np.float64), many.sum()).astype(np.uint64) for half in (value[taking] & np.uint64(0xFFFFFFFF), value[taking] >> np.uint64(32)))
        of = np.repeat(np.arange(len(n)), many)
        part = (sort[of] << 32) + np.arange(len(of)) - start[of]
        marks.append(_mixed(_mixed(low + (high << np.uint64(32))) + _mixed(part.astype(np.uint64))))
        whose.append(of)
    marks, whose = np.concatenate(marks), np.concatenate(whose)
    return marks[np.argsort(whose, kind="stable")], np.bincount(whose, minlength=len(n))


def _sketches(ids: np.ndarray, doc: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, how many of each set): whether an odd number of shingles falls in each of 64 cells or more, a power of two.

    Two sketches differ in no more cells than their sets differ in shingles. Cells are the last bits of the values, so that halves
    laid over one another give the sketch of half as many."""
    bits = np.left_shift(1, np.ceil(np.log2(np.clip(n + 1, 64, SKETCH))).astype(np.int64))
    start = np.cumsum(bits) - bits
    odd = np.bincount(start[doc] + (ids & (bits[doc] - 1).astype(np.uint64)).astype(np.int64), minlength=bits.sum()) & 1
    return np.packbits(odd.astype(np.uint8)), bits // 8


def _lists(kind, lengths: np.ndarray, flat: pa.Array) -> pa.Array:
    return kind.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), flat)


def _sets(width: int, percent: int):
    """(id, n, sig, marks, sketch) of each document: size and identifier of its set, marks of which every other set linked with it
    shares one, and a parity sketch."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _chunks(batch.column(1).to_pylist()):
                ids, doc = _shingles(texts, width)
                n = np.bincount(doc, minlength=len(texts))
                start = np.cumsum(n) - n
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_signature(ids), dtype=np.uint64)])
                sig = _mixed(sums[start + n] - sums[start] + n.astype(np.uint64))
                marks, many = _marks(ids, doc, n, percent)
                marks = _lists(pa.ListArray, many, pa.array(marks.view(np.int64)))
                packed, size = _sketches(ids, doc, n)
                ends = pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int32))
                sketch = pa.Array.from_buffers(pa.binary(), len(texts), [None, ends, pa.py_buffer(packed)])
                yield pa.record_batch([batch.column(0).slice(first, len(texts)), pa.array(n, pa.int64()), pa.array(sig.view(np.int64)), marks, sketch],
                                      names=["id", "n", "sig", "marks", "sketch"])

    return of


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, without repeats, whose mark another set has too; they come in order of mark and set."""
    held, met = np.zeros((2, 0), np.int64), False  # the last row, and whether the one before it has its mark
    for batch in batches:
        rows = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
        same = rows[0, 1:] == rows[0, :-1]
        rows = rows[:, np.append(True, ~same | (rows[1, 1:] != rows[1, :-1]))[:rows.shape[1]]]
        if not rows.shape[1]:
            continue
        same = rows[0, 1:] == rows[0, :-1]
        keep = np.append(met, same)[:-1] | same
        met = bool(np.append(met, same)[-1])
        held = rows[:, -1:]
        if keep.any():
            yield pa.record_batch([pa.array(c[:-1][keep]) for c in rows], names=["token", "sig"])
    if met:
        yield pa.record_batch([pa.array(c) for c in held], names=["token", "sig"])


def _common(who: np.ndarray, tokens: np.ndarray, many: int) -> np.ndarray:
    """How many tokens each two of ``many`` sets have in common, in runs of tokens, so that only the result is a whole matrix."""
    by = np.argsort(tokens, kind="stable")
    tokens, who = tokens[by], who[by]
    first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else np.zeros(0, np.int64)
    length = np.diff(np.append(first, len(tokens)))
    shared = np.repeat(length > 1, length)
    who, column = who[shared], np.repeat(np.arange((length > 1).sum()), length[length > 1])
    total, step = np.zeros((many, many), np.float32), max(1, CELL_RUN // many)
    cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + step, step))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        has = np.zeros((many, min(step, column[b - 1] + 1 - k * step if b > a else 1)), np.float32)
        has[who[a:b], column[a:b] - k * step] = 1
        total += has @ has.T
    return total


def _differing(sketches: list[bytes]) -> np.ndarray:
    """In how many cells each two sketches differ, all laid over to the length of the shortest."""
    bits = 8 * min(map(len, sketches))
    odd = np.stack([np.bitwise_xor.reduce(np.frombuffer(s, np.uint8).reshape(-1, bits // 8), axis=0) for s in sketches])
    total, step = np.zeros((len(odd), len(odd)), np.float32), max(1, CELL_RUN // len(odd) // 8)
    for k in range(0, bits // 8, step):
        signs = 1 - 2 * np.unpackbits(odd[:, k:k + step], axis=1).astype(np.float32)
        total += signs @ signs.T
    return (bits - total) / 2


def _candidates(percent: int):
    """One row for each block pair of a shared mark: its sets that take part in a candidate pair.

    A pair is left out if the sizes exclude a link, if both sets are known to be connected, if their sketches differ in more cells than
    linked sets differ in shingles, or if both share an earlier mark (then it is a candidate there)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for key, same, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                m = members.values
                sig, n, side, label, earlier = (m.field(k).to_numpy(zero_copy_only=False) for k in range(5))
                many, listed = len(sig), m.field(5)
                ok = label[:, None] != label[None]
                ok &= 100 * np.minimum(n[:, None], n[None]) >= percent * np.maximum(n[:, None], n[None])
                ok &= np.triu(np.ones((many, many), bool), 1) if same else (side[:, None] == 0) & (side[None] == 1)
                if ok.any():
                    ok &= _differing(m.field(6).to_pylist()) <= _most_apart(n[:, None] + n[None], percent)
                if ok.any():
                    flat, length = listed.flatten().to_numpy(zero_copy_only=False), listed.value_lengths().to_numpy(zero_copy_only=False)
                    who = np.repeat(np.arange(many), length)
                    place = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
                    before = place < earlier[who]
                    ok &= _common(who[before], flat[before], many) == 0
                used = np.flatnonzero(ok.any(0) | ok.any(1))
                if len(used):
                    out[0].append(key)
                    out[1].append(sig[used])
                    out[2].append(n[used])
            if out[0]:
                yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.list_(pa.int64()))], names=["key", "sigs", "sizes"])

    return of


def _sieve(keys: DataFrame) -> np.ndarray:
    """A table of bits, 16 for each ``key`` up to ``SIEVE``, in which those at the last bits of the keys are set."""
    bits = max(64, min(SIEVE, 1 << (16 * keys.count()).bit_length()))
    words = keys.groupBy(F.expr(f"shiftright(key & {bits - 1}L, 6)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(key & 63 AS INT)))").alias("set")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[words["word"].to_numpy()] = words["set"].to_numpy().view(np.uint64)
    return table


def _packed(sieve):
    """Texts in compressed form, as they cross the network: those that the table lets through."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, squeeze = sieve.value, zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) & np.uint64(64 * len(table) - 1)
            some = batch.filter(pa.array((table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)))
            yield pa.record_batch([some.column(0), pa.array([squeeze(t or b"") for t in some.column(1).to_pylist()], pa.binary())], names=["key", "text"])

    return of


def _segments(order, width: int):
    """(at, fragment, tokens): the shingles of each set, by fragments of the global order, with the places where they are counted."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = order.value
        for batch in batches:
            for first, texts in _chunks([zstandard.decompress(t) for t in batch.column(1).to_pylist()]):
                ids, doc = _shingles(texts, width)
                ids, doc = known.sort(ids, doc)
                cell = doc * FRAGMENTS + known.fragment(ids)
                new = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(ids)), pa.int32()), pa.array(ids.view(np.int64)))
                at = batch.column(0).slice(first, len(texts)).take(pa.array(cell[new] // FRAGMENTS))
                yield pa.record_batch([at, pa.array(cell[new] % FRAGMENTS, pa.int32()), lists], names=["at", "fragment", "tokens"])

    return of


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, counts): how many shingles each two sets of a block share in one fragment, as the upper triangle of a matrix."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        keys, counts = [], []
        for key, many, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            slot = members.values.field(0).to_numpy(zero_copy_only=False)
            lists = members.values.field(1)
            tokens = lists.flatten().to_numpy(zero_copy_only=False)
            who = np.repeat(slot, lists.value_lengths().to_numpy(zero_copy_only=False))
            total = _common(who, tokens, many)
            keys.append(key)
            counts.append(squeeze(total[np.triu_indices(many, 1)].astype(np.int32).tobytes()))
        if keys:
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(counts, pa.binary())], names=["key", "counts"])


def _linked(percent: int):
    """(u, v): a spanning forest of the links of each block, from the sum of its partial counts over all fragments."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for k in range(batch.num_rows):
                sigs, n = (batch.column(c)[k].values.to_numpy() for c in (0, 1))
                i, j = np.triu_indices(len(sigs), 1)
                common = np.zeros(len(i), np.int64)
                for counts in batch.column(2)[k].as_py():
                    common += np.frombuffer(zstandard.decompress(counts), np.int32)
                good = 100 * common >= percent * (n[i] + n[j] - common)
                if good.any():
                    label = np.arange(len(sigs))
                    i, j = i[good], j[good]
                    while True:  # smallest label on both ends of every link
                        low = np.minimum(label[i], label[j])
                        new = label.copy()
                        np.minimum.at(new, i, low)
                        np.minimum.at(new, j, low)
                        new = new[new]
                        if (new == label).all():
                            break
                        label = new
                    moved = np.flatnonzero(label != np.arange(len(sigs)))
                    us.append(sigs[moved])
                    vs.append(sigs[label[moved]])
            if us:
                yield pa.record_batch([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    return of


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(sig, text)``: the compressed text of each ``(sig, key)``.

    Texts cross the network once, and only those that are wanted beside a few others, whichever way Spark joins them."""
    sieve = docs.sparkSession.sparkContext.broadcast(_sieve(wanted.select("key")))
    packed = arrow_map(docs.select("key", "text"), _packed(sieve), "key long, text binary")
    return packed.groupBy("key").agg(F.first("text").alias("text")).join(wanted, "key").select("sig", "text")


def _block_links(docs: DataFrame, classes: DataFrame, blocks: DataFrame, order, width: int, percent: int) -> DataFrame:
    """``(u, v)``: links that connect what the links inside each block connect.

    ``blocks`` holds ``(key, sigs, sizes)``. One document of each set gives its shingles; they go to the blocks of the set by
    fragments of the global order."""
    rows = blocks.select("key", F.size("sigs").alias("many"), F.posexplode("sigs").alias("slot", "sig"))
    parts = rows.groupBy("sig").agg(F.ceil(F.count("*") / CELLS).alias("parts"))
    cells = saved(rows.join(parts, "sig").groupBy("sig", F.pmod(F.xxhash64("key"), "parts")).agg(F.collect_list(F.struct("key", "many", "slot")).alias("at")).select("sig", "at"), "set-blocks")
    texts = _texts(docs, saved(classes.join(cells, "sig", "left_semi").select("sig", "key"), "block-texts"))
    kind = cells.schema["at"].dataType.simpleString()
    segments = arrow_map(texts.join(cells, "sig").select("at", "text"), _segments(order, width), f"at {kind}, fragment int, tokens array<bigint>")
    pieces = segments.select(F.explode("at").alias("at"), "fragment", "tokens").select("at.*", "fragment", "tokens")
    pieces = pieces.groupBy("key", "many", "fragment").agg(F.collect_list(F.struct("slot", "tokens")).alias("members"))
    partial = arrow_map(pieces.select("key", "many", "members"), _partial, "key long, counts binary")
    summed = partial.groupBy("key").agg(F.collect_list("counts").alias("counts"))  # one for each fragment
    return arrow_map(blocks.join(summed, "key").select("sigs", "sizes", "counts"), _linked(percent), "u long, v long")


def _homes(tokens: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``(key, sigs, sizes)``: blocks of sets that have their most frequent mark in common.

    Each set is in one block; the ``LEADERS`` of a mark, sets drawn by hash, are in all of its blocks."""
    most = tokens.join(tokens.groupBy("token").agg(F.count("*").alias("m")), "token")
    home = most.groupBy("sig").agg(F.max(F.struct("m", "token"))["token"].alias("token")).join(classes.select("sig", "n", "sketch"), "sig")
    home = saved(home, "homes")
    leaders = [F.min(F.struct(F.xxhash64("sig", F.lit(k)), "sig"))["sig"].alias(f"l{k}") for k in range(LEADERS)]
    heads = home.groupBy("token").agg(F.ceil(F.count("*") / HOME).cast("int").alias("blocks"), F.count("*").alias("m"), *leaders).where("m > 1")
    heads = heads.select("token", "blocks", F.array_distinct(F.array(*[f"l{k}" for k in range(LEADERS)])).alias("leaders"))
    own = home.join(heads.select("token", "blocks"), "token").withColumn("block", F.pmod(F.xxhash64("sig", F.lit(11)), "blocks").cast("int"))
    led = home.join(heads.where("blocks > 1").select("token", "blocks", F.explode("leaders").alias("sig")), ["token", "sig"])
    led = led.withColumn("home", F.pmod(F.xxhash64("sig", F.lit(11)), "blocks").cast("int"))
    led = led.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("block <> home")
    cols = ["token", "block", "sig", "n", "sketch"]
    none = F.array().cast("array<bigint>").alias("listed")
    grouped = own.select(cols).union(led.select(cols)).groupBy(F.xxhash64("token", "block").alias("key"), F.lit(True).alias("same")).agg(
        F.collect_list(F.struct("sig", "n", F.lit(0).alias("side"), F.col("sig").alias("label"), F.lit(0).alias("i"), none, "sketch")).alias("members"))
    return arrow_map(grouped.where("size(members) > 1"), _candidates(percent), "key long, sigs array<bigint>, sizes array<bigint>")


def _block_pairs(tokens: DataFrame, classes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``(key, sigs, sizes)``: the sets of each block pair of a shared mark that may be linked and aren't known to be connected.

    Marks that only sets of one label share need no look. Sets of one label that alone fill a block stay among themselves, so
    that they meet the blocks of the others and not one another."""
    known = tokens.join(labels, "sig", "left").withColumn("label", F.coalesce("root", "sig")).drop("root")
    known = saved(known, "labelled-tokens")
    open_ = known.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("token")
    mixed = saved(known.join(open_, "token"), "mixed-tokens")
    by_label = mixed.groupBy("token", "label").agg(F.count("*").alias("m"))
    large = by_label.where(f"m >= {BLOCK}").select("token", "label", F.ceil(F.col("m") / BLOCK).cast("int").alias("cuts"))
    small = by_label.where(f"m < {BLOCK}").groupBy("token").agg(F.ceil(F.sum("m") / BLOCK).cast("int").alias("cuts")).select("token", F.lit(None).cast("long").alias("label"), "cuts")
    areas = saved(large.union(small), "areas")
    blocks = areas.groupBy("token").agg(F.sum("cuts").alias("blocks"))
    block = F.struct(F.coalesce("area", F.lit(0)).alias("area"), F.col("area").isNotNull().alias("alone"), F.pmod(F.xxhash64("sig", F.lit(11)), "cuts").cast("int").alias("cut"))
    own = mixed.join(areas.where("label IS NOT NULL").select("token", "label", F.col("label").alias("area"), F.col("cuts").alias("of_label")), ["token", "label"], "left")
    own = own.join(areas.where("label IS NULL").select("token", F.col("cuts").alias("of_rest")), "token", "left")
    own = own.withColumn("cuts", F.coalesce("of_label", F.coalesce("of_rest", F.lit(1)))).join(blocks, "token").select("sig", "token", "label", block.alias("block"), "blocks")
    earlier = own.groupBy("sig").agg(F.array_sort(F.collect_list(F.struct("token", "label", "block", "blocks"))).alias("all"))
    members = earlier.select("sig", "all", F.posexplode("all").alias("i", "e"))
    around = f"concat(slice(all, 1, least(i, {FIRST})), slice(all, greatest(1 + {FIRST}, i - {LAST - 1}), least(greatest(i - {FIRST}, 0), {LAST})))"
    whole = f"size(all) <= {LISTED}"
    members = members.select("sig", "e.*", F.expr(f"IF({whole}, i, least(i, {FIRST + LAST}))").alias("i"), F.expr(f"transform(IF({whole}, all, {around}), x -> x.token)").alias("listed"))
    members = members.join(classes.select("sig", "n", "sketch"), "sig")
    # most marks have one block, whose sets needn't be joined with those of others
    others = areas.select("token", F.struct(F.coalesce("label", F.lit(0)).alias("area"), F.col("label").isNotNull().alias("alone")).alias("a"), F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"))
    others = others.select("token", F.struct("a.area", "a.alone", "cut").alias("other"))
    paired = members.where("blocks > 1").join(others, "token").where("NOT (block.alone AND other.alone AND block.area = other.area)")
    paired = paired.unionByName(members.where("blocks = 1").withColumn("other", F.col("block")))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    grouped = paired.groupBy(F.xxhash64("token", low, high).alias("key"), (low == high).alias("same")).agg(
        F.collect_list(F.struct("sig", "n", F.when(F.col("block") == low, 0).otherwise(1).alias("side"), "label", "i", "listed", "sketch")).alias("members"))
    return arrow_map(grouped.where("size(members) > 1"), _candidates(percent), "key long, sigs array<bigint>, sizes array<bigint>")


def set_links(docs: DataFrame, sets: DataFrame, order, width: int, percent: int) -> DataFrame:
    """``(u, v)``: links that connect exactly the sets that are connected by pairs with ``percent`` of their union in common.

    First each set is compared within one block, which connects most of a family at the price of sending its shingles once;
    then all candidate pairs that this has not connected."""
    marks = sets.select(F.explode("marks").alias("token"), "sig").repartition("token").sortWithinPartitions("token", "sig")
    tokens = saved(arrow_map(marks, _shared, "token long, sig long"), "shared-marks")
    classes = sets.join(tokens.select("sig").distinct(), "sig", "left_semi").groupBy("sig").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("key").alias("key"))
    classes = saved(classes, "classes")
    near = saved(_block_links(docs, classes, saved(_homes(tokens, classes, percent), "home-blocks"), order, width, percent), "home-links")
    labels = connected_components(near).withColumnRenamed("node", "sig")
    pairs = saved(_block_pairs(tokens, classes, labels, percent), "block-pairs")
    far = _block_links(docs, classes, pairs, order, width, percent)
    return labels.select(F.col("sig").alias("u"), F.col("root").alias("v")).where("u <> v").union(far)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90) -> DataFrame:
    """``(id, n_shingles, component, kept)`` per row: rows whose sets of distinct shingles overlap in ``percent`` of their union
    or more are linked; ``component`` is the smallest id that a row reaches.

    Lower-cases A-Z, takes words separated by space and 0x09 to 0x0D, and their distinct ``width``-word shingles (fewer
    words: the whole sequence as one). Rows without words, and NULL texts, have an empty set and are linked with nothing.

    Equal sets are one node. The order of shingles by value is cut into one part more than linked sets of a size can differ in
    shingles, so that they agree in a whole part; its hash is a mark. A shared mark's sets, in blocks, give candidate pairs, kept as
    matrices of block pairs, never as one row for each pair. The global order, frequent shingles last, is cut into fragments; in each the
    shared shingles of each two sets of a block pair are counted separately, and the partial counts are summed per pair. A block
    pair gives a spanning forest of its links. Sets of a mark that many share are dealt into blocks by hash.

    Shingles, parts, and sets, are compared by 64-bit hashes. NULL ids take part and are ignored in the minimum. ``kept`` marks the
    row of each component that stays (smallest id; repeats of it are marked too). Repeated rows give repeated results; other
    columns play no part; an empty table gives an empty one."""
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    known = frequent(slim, width).toArrow()
    order = docs.sparkSession.sparkContext.broadcast(Order(known["token"].to_numpy().view(np.uint64), known["n"].to_numpy()))
    kind = docs.schema[id_col].dataType.simpleString()
    row = arrow_map(slim.select(F.struct("id", "key").alias("id"), F.col("text").cast("binary")), _sets(width, percent),
                    f"id struct<id: {kind}, key: bigint>, n long, sig long, marks array<bigint>, sketch binary")
    sets = saved(row.select("id.id", "id.key", "n", "sig", "marks", "sketch"), "sets")
    links = set_links(slim.select("key", F.col("text").cast("binary").alias("text")), sets, order, width, percent)
    roots = connected_components(links)
    of = sets.select("id", "n", "sig").join(roots, F.col("sig") == F.col("node"), "left").select("id", "n", F.when(F.col("n") > 0, F.coalesce("root", "sig")).alias("root"))
    of = saved(of, "set-roots")
    least = of.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least"))
    full = of.where("root IS NOT NULL").join(least, "root").select("id", F.col("n").alias("n_shingles"), F.col("least").alias("component"))
    alone = of.where("root IS NULL").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component"))
    return full.union(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component")))
