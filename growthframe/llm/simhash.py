"""SimHash near-duplicates: fingerprints of word shingles, exact tiled comparison, connected components."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthframe.llm.common import arrow_map, saved, word_pieces
from growthframe.llm.components import connected_components

#: A fingerprint's population is counted in PARTS words of 16 bits.
PARTS = 4
#: Fingerprints in a block of a tile, about.
BLOCK = 2048


def _shingle_hashes(data: bytes, width: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of ``data``, in pieces; the whole sequence if it has fewer words."""
    carry: list[bytes] = []
    seen = False
    for words in word_pieces(data):
        words = carry + words
        if len(words) >= width:
            seen = True
            cut = map(b" ".join, zip(*(words[k:] for k in range(width))))
            yield np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(seed)), np.uint64, len(words) - width + 1)
            carry = words[len(words) - width + 1:]
        else:
            carry = words
    if not seen and carry:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carry), seed)], np.uint64)


def _bit_sums(hashes: list[np.ndarray]) -> np.ndarray:
    """Per array, how often each of the 64 bits is set."""
    flat = np.concatenate(hashes)
    bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    starts = np.cumsum([0, *map(len, hashes[:-1])])
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def _fingerprints(texts: list, width: int, seed: int) -> np.ndarray:
    """A fingerprint for each text: a bit is set if it is in over half the shingles' hashes."""
    ones, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if held:
            np.add.at(ones, [k for k, _ in held], _bit_sums([h for _, h in held]))
            held.clear()

    waiting = 0
    for k, data in enumerate(texts):
        for h in _shingle_hashes((data or b"").lower(), width, seed):  # bytes.lower: A-Z alone
            held.append((k, h))
            total[k] += len(h)
            waiting += len(h)
            if waiting > 1 << 18:
                flush()
                waiting = 0
    flush()
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(np.int64).reshape(-1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """``(id, key, fp)`` per row: a hash of the text, and the 64-bit SimHash of the whole text, signed. No words (or NULL): 0."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = _fingerprints(batch.column(2).to_pylist(), width, seed)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fp, pa.int64())], names=["id", "key", "fp"])

    text = F.col(text_col)
    return arrow_map(docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), text.cast("binary").alias("text")), of, "id long, key long, fp long")


def _offsets(radius: int) -> list[int]:
    """Codes of the population differences within ``radius`` over all parts: one of each pair +d, -d, and 0."""
    half = [d for d in itertools.product(range(-radius, radius + 1), repeat=PARTS)
            if sum(map(abs, d)) <= radius and d >= (0,) * PARTS]
    return [sum(x << (5 * k) for k, x in enumerate(d)) for d in half]


def _spanning(i: np.ndarray, j: np.ndarray, n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the root of each, for the bipartite links (i, j): as many links as nodes at most."""
    label = np.arange(n + m)
    j = j + n
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    nodes = np.flatnonzero(label != np.arange(n + m))
    return nodes, label[nodes]


def _compare(radius: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = batch.column(0), batch.column(1)
            a, b = one.values.to_numpy().view(np.uint64), two.values.to_numpy().view(np.uint64)
            a_at, b_at = one.offsets.to_numpy(), two.offsets.to_numpy()
            us, vs = [], []
            for k in range(batch.num_rows):
                x, y = a[a_at[k]:a_at[k + 1]], b[b_at[k]:b_at[k + 1]]
                i, j = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= radius)
                if len(i) and not (len(x) == len(y) == len(i) and (x == y).all()):  # more than each with itself
                    both = np.concatenate([x, y]).view(np.int64)
                    nodes, roots = _spanning(i, j, len(x), len(y))
                    us.append(both[nodes])
                    vs.append(both[roots])
            if us:
                yield pa.record_batch([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    return of


def hamming_links(prints: DataFrame, fp: str = "fp", radius: int = 3) -> DataFrame:
    """``(u, v)``: links that connect exactly what all pairs of distinct fingerprints within ``radius`` bits connect.

    Fingerprints lie in tiles by the population counts of their four 16-bit words. Two that differ in
    at most ``radius`` bits have counts that differ by ``radius`` at most in sum, so other tile pairs
    are skipped. There are at most 17^4 tiles: their sizes are a table of bounded size, whatever the input. A large
    tile is dealt into blocks of about ``BLOCK`` by a hash. Each block pair is compared in full by
    exclusive-or and bit counts, and gives a spanning forest of its links, never all pairs."""
    f = F.col(fp)
    pops = [F.bit_count(F.shiftrightunsigned(f, 16 * k).bitwiseAND(F.lit(65535))) for k in range(PARTS)]
    tile = sum((p * F.lit(1 << (5 * k)) for k, p in enumerate(pops)), F.lit(0)).cast("int")
    rows = prints.where(f.isNotNull()).select(f.alias("fp"), tile.alias("tile"))
    sizes = saved(rows.groupBy("tile").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n")), "tiles")
    cut = rows.join(F.broadcast(sizes), "tile")  # at most 83,521 rows of 8 bytes
    blocks = cut.groupBy("tile", F.pmod(F.xxhash64("fp", F.lit(7)), "n").cast("int").alias("block")).agg(F.collect_list("fp").alias("fps"))
    blocks = saved(blocks, "blocks")
    near = F.array(*[F.lit(x) for x in _offsets(radius)])
    to = blocks.select(F.explode(F.transform(near, lambda x: x + F.col("tile"))).alias("to"), "tile", "block", "fps")
    other = F.broadcast(sizes.select(F.col("tile").alias("to"), F.col("n").alias("m")))
    to = to.join(other, "to").select("to", "tile", "block", "fps", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("slot"))
    to = to.where("to != tile OR slot >= block").select("to", "slot", F.col("fps").alias("far"))
    own = blocks.select(F.col("tile").alias("to"), F.col("block").alias("slot"), F.col("fps").alias("own"))
    return arrow_map(own.join(to, ["to", "slot"]).select("own", "far"), _compare(radius), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3, seed: int = 42) -> DataFrame:
    """``(id, key, fp, component, kept)`` per row of ``docs``; ``component`` is the smallest id that the row reaches.

    Lower-cases A-Z, takes words separated by space and 0x09 to 0x0D, and their ``width``-word
    shingles, repeats included (fewer words: the whole sequence; none, or a NULL text: fingerprint
    0, linked like any other). Equal fingerprints are one node; others link at ``radius`` differing
    bits or fewer. ``kept`` marks the row of each component that stays: smallest id (NULL last), then
    text hash; repeats of that row are marked too. NULL ids take part and are ignored in the minimum (a
    component of NULL ids alone has NULL). Other columns play no part. An empty table gives an
    empty one."""
    rows = saved(fingerprints(docs, id_col, text_col, width, seed), "prints")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    prints = saved(rows.groupBy("fp").agg(F.min(place).alias("place")), "distinct-prints")
    roots = connected_components(hamming_links(prints, "fp", radius))
    of = prints.join(roots, prints.fp == roots.node, "left").select("fp", "place", F.coalesce("root", "fp").alias("root"))
    least = of.groupBy("root").agg(F.min("place").alias("least"))
    return rows.join(of.join(least, "root").select("fp", "least"), "fp").select(
        "id", "key", "fp", F.col("least.id").alias("component"), (place == F.col("least")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps its first row; a row loaded twice stays once."""
    # plain keys without NULLs: the partitioning of the duplicates serves the join too, so texts are shuffled once, repeats combined before
    kept = near_duplicates(docs, id_col, text_col, width, radius, seed).where("kept")
    kept = kept.select(F.col("id").isNull().alias("none"), F.coalesce(F.col("id").cast("long"), F.lit(0).cast("long")).alias("i"), F.col("key").alias("k")).distinct()
    row = docs.select(F.struct("*").alias("row"), F.col(id_col).isNull().alias("none"), F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("i"), F.xxhash64(F.col(text_col)).alias("k"))
    keys = ["none", "i", "k"]
    return row.dropDuplicates(keys).join(kept, keys, "left_semi").select("row.*")
