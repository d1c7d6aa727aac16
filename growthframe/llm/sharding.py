"""Sharding by extendible hashing: only buckets over the byte limit split, on one more hash bit (native)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from growthframe.llm.common import saved

#: Hash bits in all, and bits by which a directory may grow in one round.
HASH_BITS, ROUND_BITS = 60, 12
#: Rows that are numbered together where rows of one hash are dealt into parts.
SLOT = 1 << 16


def _hash(id_col: str, text_col: str):
    """60 bits of MD5 over id and text: copies under other ids spread, repeats of one row don't."""
    parts = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(parts.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _buckets(rows: DataFrame, limit: int) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """Directories ``(cell, depth, prefix, shard_bytes)`` with the bits by which they are indexed, and the full hashes whose rows are still too many bytes."""
    sizes = saved(rows.groupBy("h").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n"), F.max("n_bytes").alias("most")), "hash-sizes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    # the first directory has some cells for each shard that the bytes need, so that only uneven cells go to a further round
    left, above, step, out, alone = sizes, 0, min(HASH_BITS, max(ROUND_BITS, (total // limit).bit_length() + 3)), [], None
    while True:
        top = min(above + step, HASH_BITS)
        step = ROUND_BITS
        # one row for each cell of the round, then one for each prefix of a cell: small beside the rows
        cells = left.groupBy(F.shiftright("h", HASH_BITS - top).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.min("h").alias("low"), F.max("h").alias("high"))
        depth = F.explode(F.sequence(F.lit(above), F.lit(top))).alias("depth")
        nodes = cells.select("cell", "bytes", "low", "high", depth).selectExpr("depth", f"shiftright(cell, {top} - depth) AS prefix", "bytes", "low", "high")
        nodes = saved(nodes.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high")), "nodes")
        fit = nodes.where(F.col("bytes") <= limit).drop("low", "high")
        parent = nodes.where(F.col("bytes") > limit).selectExpr("depth + 1 AS depth", "prefix AS parent")
        leaves = fit.withColumn("parent", F.shiftright("prefix", 1)).join(parent, ["depth", "parent"], "left_semi").drop("parent")
        leaves = leaves.union(fit.where(F.col("depth") == 0)) if above == 0 else leaves
        bits = leaves.agg(F.max("depth")).first()[0]
        if bits is not None:
            span = F.expr(f"sequence(shiftleft(prefix, {bits} - depth), shiftleft(prefix + 1, {bits} - depth) - 1)")
            out.append((bits, leaves.select(F.explode(span).alias("cell"), "depth", "prefix", F.col("bytes").alias("shard_bytes"))))
        full = nodes.where((F.col("depth") == top) & (F.col("bytes") > limit))
        # a full cell of one hash can't split any further
        one = full.where("low = high").select(F.col("low").alias("h"))
        alone = one if alone is None else alone.union(one)
        full = full.where("low != high").select(F.col("prefix").alias("cell"))
        if full.isEmpty():
            return out, sizes.join(alone, "h", "left_semi")
        left = left.join(full, F.shiftright(left.h, HASH_BITS - top) == full.cell, "left_semi")
        above = top


def assign_shards(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``shard``, ``depth`` and ``shard_bytes`` (in place of columns of these names).

    A row's bytes are those of its text in UTF-8 (NULL: none). ``shard`` spells the ``depth`` hash bits that name
    the bucket; a bucket over ``limit`` bytes splits on one more bit, others stay, until all fit. The
    directory of a round is indexed by as many bits as its deepest bucket has; the first round has bits for some cells per
    shard that all bytes need, and where they don't suffice, the next round goes 12 bits on below the full cells alone.

    Rows that agree in id and text can't be told apart by any hash bit: where they exceed the limit together
    they are dealt into parts by their number (``shard`` ends in ``.part``), for which they are written once: numbers
    taken from a plan that runs twice needn't agree. A single row over the limit is a shard of its own (part 0). NULL ids hash by their text; an empty table gives an empty one."""
    new = ("n_bytes", "shard", "depth", "shard_bytes")
    rows = docs.select(F.struct(*[c for c in docs.columns if c not in new]).alias("row"), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"), _hash(id_col, text_col).alias("h"))
    return _assigned(rows, limit).select("row.*", *new)


def _assigned(rows: DataFrame, limit: int) -> DataFrame:
    directories, full = _buckets(rows.select("h", "n_bytes"), limit)
    bits = F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth").cast("int"), F.lit("0"))
    done = None
    for index, directory in directories:
        at = F.shiftright("h", HASH_BITS - index)
        one = rows.join(directory, at == directory.cell).select("row", "n_bytes", F.when(F.col("depth") == 0, "").otherwise(bits).alias("shard"), F.col("depth").cast("long").alias("depth"), "shard_bytes")
        done = one if done is None else done.union(one)
    # rows of the full hashes: written once with a number that stays, dealt into slots of about SLOT rows, counted slot by slot
    slot = F.floor(F.rand(7) * F.ceil(F.col("n") / SLOT)).cast("int")
    same = rows.join(full.withColumnRenamed("h", "g"), F.col("h") == F.col("g")).withColumn("slot", slot).withColumn("number", F.monotonically_increasing_id())
    same = saved(same, "full-rows")
    held = same.groupBy("h", "slot").agg(F.count("*").alias("c"))
    before = held.select(F.col("h").alias("h0"), F.col("slot").alias("slot0"), (F.sum("c").over(Window.partitionBy("h").orderBy("slot")) - F.col("c")).alias("before"))
    numbered = same.withColumn("k", F.row_number().over(Window.partitionBy("h", "slot").orderBy("number")) - 1)
    numbered = numbered.join(before, (F.col("h") == F.col("h0")) & (F.col("slot") == F.col("slot0")))
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("most")))
    part = F.floor((F.col("before") + F.col("k")) / each)
    name = F.lpad(F.conv(F.col("h").cast("string"), 10, 2), HASH_BITS, "0")
    dealt = numbered.select("row", "n_bytes", F.concat_ws(".", name, part.cast("string")).alias("shard"), F.lit(HASH_BITS).cast("long").alias("depth"),
                            (F.least(each, F.col("n") - part * each) * F.col("most")).cast("long").alias("shard_bytes"))
    return dealt if done is None else done.union(dealt)


def write_shards(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """``docs`` as one Parquet folder per shard under ``path``."""
    assigned = assign_shards(docs, limit, id_col, text_col)
    assigned.repartition("shard").write.partitionBy("shard").parquet(path)
