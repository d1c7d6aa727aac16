"""Repeated byte strings: sampled suffixes in q-gram buckets, refined until every repeated string is known."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthframe.llm.common import arrow_map, saved
from growthframe.llm.suffixes import Q, buckets, joined_bytes, refine, samples

#: Bytes of text that are sorted into buckets at a time; a longer text is taken in overlapping parts.
CHUNK = 1 << 18
#: Starts that are judged together in the last refinement: what they add on a side fits in a long.
STEP = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hash(*parts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(parts[0]), np.uint64)
    for level, part in enumerate(parts):
        out = refine(out ^ part.astype(np.uint64), max(1, len(out)), level) * _MIX
    return out


def _parts(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Joined texts of about CHUNK bytes: bytes, bounds, and of each part its text and its place in that text."""
    held, rows, places, size = [], [], [], 0
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), CHUNK):
            part = text[at:at + CHUNK + length - 1]
            held.append(part)
            rows.append(k)
            places.append(at)
            size += len(part)
            if size >= CHUNK:
                yield *joined_bytes(held), np.array(rows), np.array(places)
                held, rows, places, size = [], [], [], 0
    if held:
        yield *joined_bytes(held), np.array(rows), np.array(places)


def _suffix_rows(length: int):
    """(gram, whole, key, place) of every sampled suffix. ``whole`` names all bytes of the strings that chose it."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for k in range(0, whole_batch.num_rows, 2000):
                batch = whole_batch.slice(k, 2000)
                keys = batch.column(0).to_numpy()
                for data, bounds, rows, places in _parts([t or b"" for t in batch.column(1).to_pylist()], length):
                    grams, wide = buckets(data, Q, 256)
                    first, last, place = samples(grams, bounds, length)
                    size = last - first + length
                    whole = _hash(wide[first], wide[first + np.minimum(256, size - 256)], wide[last + length - 256], size, place - first)
                    part = np.searchsorted(bounds, first, "right") - 1
                    begin = first - bounds[part] + places[part]
                    packed = begin << 20 | (last - first) << 10 | (place - first)
                    yield pa.record_batch([pa.array(grams[place].view(np.int64)), pa.array(whole.view(np.int64)),
                                           pa.array(keys[rows[part]]), pa.array(packed)], names=["gram", "whole", "key", "place"])

    return of


def _block_rows(length: int):
    """(core, left, right, low, high, key, at) of every block of STEP starts of the given suffixes.

    ``core`` names the bytes that all strings of a block share, ``left`` and ``right`` are the
    STEP - 1 bytes on its sides; ``low`` to ``high`` are the starts that chose the suffix."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for k in range(0, whole_batch.num_rows, 200):
                batch = whole_batch.slice(k, 200)
                texts = [zstandard.decompress(t) for t in batch.column(1).to_pylist()]
                lists = batch.column(2)
                counts = np.diff(lists.offsets.to_numpy())
                items = lists.flatten()
                place, gram, many = (items.field(j).to_numpy(zero_copy_only=False) for j in range(3))
                data, bounds = joined_bytes([*texts, bytes(256)])
                wide, = buckets(data, 256)
                doc = np.repeat(np.arange(len(counts)), counts)
                begin, span, inside = place >> 20, place >> 10 & 1023, place & 1023
                at, far, near = bounds[doc] + begin + inside, inside, inside - span  # strings start `near` to `far` bytes before
                blocks = far // STEP - near // STEP + 1
                who = np.repeat(np.arange(len(at)), blocks)
                block = np.arange(len(who)) - np.repeat(np.cumsum(blocks) - blocks, blocks) + near[who] // STEP
                p, least = at[who], block * STEP
                most = least + STEP - 1
                core = _hash(wide[p - least], wide[p - most + length - 256], gram[who].view(np.uint64), block)
                left, right = np.zeros(len(who), np.int64), np.zeros(len(who), np.int64)
                for j in range(STEP - 1):
                    left = left << 8 | data[np.maximum(p - most + j, 0)]
                    right = right << 8 | data[np.minimum(p - most + length + j, len(data) - 1)]
                yield pa.record_batch([
                    pa.array(core.view(np.int64)), pa.array(left), pa.array(right),
                    pa.array(np.maximum(near[who] - least, 0), pa.int8()), pa.array(np.minimum(far[who] - least, STEP - 1), pa.int8()),
                    pa.array(batch.column(0).to_numpy()[doc[who]]), pa.array(p - bounds[doc[who]] - least), pa.array(many[who])],
                    names=["core", "left", "right", "low", "high", "key", "at", "many"])

    return of


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the spans of each text and take them out."""
    for whole in batches:
        for k in range(0, whole.num_rows, 1000):
            batch = whole.slice(k, 1000)
            out: list[list] = [[], [], [], []]
            for packed, spans in zip(batch.column(1).to_pylist(), batch.column(2)):
                text = zstandard.decompress(packed) if packed else b""
                merged = np.zeros((0, 2), np.int64)
                if spans.is_valid and len(spans):
                    begin, end = (spans.values.field(j).to_numpy() for j in range(2))
                    order = np.argsort(begin, kind="stable")
                    begin, reach = begin[order], np.maximum.accumulate(end[order])
                    new = np.flatnonzero(np.append(True, begin[1:] > reach[:-1]))
                    merged = np.stack([begin[new], np.append(reach[new[1:] - 1], reach[-1])], 1)
                edges = [0, *merged.reshape(-1).tolist(), len(text)]
                out[0].append(len(text))
                out[1].append(int((merged[:, 1] - merged[:, 0]).sum()))
                out[2].append([{"first": a, "past": b} for a, b in merged.tolist()])
                out[3].append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            span = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))
            yield pa.record_batch([batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], span),
                                   pa.array(out[3], pa.binary())], names=["id", "n_bytes", "n_removed", "spans", "kept"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in compressed form: they cross the network twice."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array([squeeze(t or b"") for t in batch.column(2).to_pylist()], pa.binary())], names=["id", "key", "text"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """``(id, n_bytes, n_removed, spans, kept)`` per row: bytes covered by a ``length``-byte string that starts twice or more.

    Texts are UTF-8 bytes (NULL: empty); strings lie in one text and are judged on the input; overlapping
    repeats count. ``spans`` are the maximal removed runs, ``kept`` the other bytes.

    Each string chooses the q-gram in it with the smallest identifier, so equal strings choose alike and one
    suffix in about a hundred stands for all. Identifiers of 2n bytes come from those of n bytes, at this and
    at the later offset, as far as they are needed. Suffixes alone in their q-gram bucket hold no
    repeat. A bucket is refined by the identifier of all bytes of the strings that chose the suffix: twice
    the same, and all these strings repeat. What stays open (edges of repeats) is refined by blocks of
    ``STEP`` starts, and blocks that are neither equal nor alone by single starts. Hot buckets are only ever
    aggregated and joined, one row for each different context, never paired.

    Texts and buckets are told apart by 64-bit identifiers. Repeated rows repeat each other's bytes, so all
    of them lose these; other columns play no part; an empty table gives an empty one."""
    if not 256 + Q <= length <= 448:
        raise ValueError("length must lie between 320 and 448 bytes")
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("key"), F.col(text_col).cast("binary").alias("text"))
    found = arrow_map(slim.select("key", "text"), _suffix_rows(length), "gram long, whole long, key long, place long")
    shared = found.groupBy("gram").agg(F.min("whole").alias("one"), F.max("whole").alias("two"), F.count("*").alias("n")).where("n > 1")
    # written first: a join of two plain shuffles can be split where a gram holds a large share of the rows
    shared = saved(shared.select("gram", (F.col("one") != F.col("two")).alias("mixed")), "grams")
    inside = saved(found.join(shared, "gram"), "suffixes")

    mixed = inside.where("mixed")
    wholes = saved(mixed.groupBy("gram", "whole").agg(F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("at")), "contexts")
    twice = mixed.join(wholes.where("n > 1").select("gram", "whole"), ["gram", "whole"]).select("key", "place")
    spans = inside.where("NOT mixed").select("key", "place").union(twice)
    begin = F.shiftright("place", 20)
    spans = spans.select("key", begin.alias("first"), (begin + F.shiftright("place", 10).bitwiseAND(F.lit(1023)) + length).alias("past"))

    per_text = wholes.groupBy(F.col("at.key").alias("key")).agg(F.collect_list(F.struct(F.col("at.place").alias("place"), "gram", (F.col("n") > 1).alias("many"))).alias("suffixes"))
    packed = arrow_map(slim, _packed, "id " + slim.schema["id"].dataType.simpleString() + ", key long, text binary")
    texts = packed.groupBy("key").agg(F.first("text").alias("text"))
    blocks = arrow_map(texts.join(per_text, "key").select("key", "text", "suffixes"), 
        _block_rows(length), "core long, left long, right long, low byte, high byte, key long, at long, many boolean")
    blocks = saved(blocks, "blocks")
    same = [f"min({c}) = max({c})" for c in ("left", "right")]
    full = f"min(high) = {STEP - 1} AND max(low) = 0"
    groups = blocks.groupBy("core").agg(F.count("*").alias("n"), F.expr(" AND ".join([*same, full])).alias("equal")).where("n > 1")
    known = blocks.join(saved(groups.select("core", "equal"), "cores"), "core")
    settled = known.where("equal AND NOT many").select("key", (F.col("at") - (STEP - 1)).alias("first"), (F.col("at") + length).alias("past"))
    # the string that starts d bytes further back has d more bytes on the left and d fewer on the right
    single = known.where("NOT equal").select("core", "left", "right", "key", "at", "many", F.explode(F.sequence(F.col("low").cast("int"), F.col("high").cast("int"))).alias("d"))
    single = single.selectExpr("core", "d", "left & (shiftleft(1L, 8 * d) - 1) AS l", "shiftright(right, 8 * d) AS r", "key", "at", "many")
    again = single.groupBy("core", "d", "l", "r").agg(F.count("*").alias("n")).where("n > 1").select("core", "d", "l", "r")
    again = saved(again, "strings")
    ends = single.where("NOT many").join(again, ["core", "d", "l", "r"]).selectExpr("key", "at - d AS first", f"at - d + {length} AS past")

    spans = spans.union(settled).union(ends).distinct()
    of = spans.groupBy("key").agg(F.collect_list(F.struct("first", "past")).alias("spans"))
    kept = packed.join(of.withColumnRenamed("key", "k"), F.col("key") == F.col("k"), "left").select("id", "text", "spans")
    return arrow_map(kept, _cut, f"id {slim.schema['id'].dataType.simpleString()}, n_bytes long, n_removed long, spans array<struct<first: bigint, past: bigint>>, kept binary")
