"""Line de-duplication: repeated line runs found by hashes of fixed runs of lines (native)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthframe.llm.common import saved

#: A word is a run of anything but space and the bytes 0x09 to 0x0D.
WORD = "[^\\\\x20\\\\x09-\\\\x0D]+"


def _runs(docs: DataFrame, id_col: str, text_col: str, min_lines: int, min_words: int) -> DataFrame:
    """``(id, key, first, last, size, name)``: the smallest qualifying line runs of each document.

    Runs of fixed length stand in for a suffix array with LCP intervals: the name of 2n lines is a hash of
    two names of n lines, up to ``min_lines`` only, and the name of any length m between is a hash of the two
    overlapping names of the largest power of two. Equal (name, size) means equal lines; longer runs that
    documents share are not followed further."""
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("key"), F.split(text_col, "\n", -1).alias("lines"))
    seq = F.expr(f"filter(transform(lines, (x, i) -> struct(i AS ln, xxhash64(x) AS h, regexp_count(x, '{WORD}') AS w)), s -> s.w > 0)")
    # repeated rows of one document are that document once
    df = base.where("size(lines) > 0").select("id", "key", seq.alias("seq")).where("size(seq) > 0")
    df = df.select("id", "key", F.col("seq.ln").alias("ln"), F.col("seq.w").alias("w"), F.col("seq.h").alias("n1"))
    power = 1
    while power * 2 <= min_lines:
        df = df.withColumn(f"n{power * 2}", F.expr(f"transform(n{power}, (x, i) -> xxhash64(x, get(n{power}, i + {power}), 0))"))
        power *= 2

    def name(m: int) -> str:
        p = 1 << (m.bit_length() - 1)
        return f"xxhash64(get(n{p}, i), get(n{p}, i + {m - p}), {m})"

    def words(m: int, at: str) -> str:
        return " + ".join([f"get(w, {at} + {k})" for k in range(m)]) or "0"

    options = []
    for m in range(1, min_lines + 1):
        enough = "true" if m == min_lines else f"{words(m, 'i')} >= {min_words}"
        # smallest from its first line on, or smallest up to its last line
        small = "true" if m == 1 else f"({words(m - 1, 'i')} < {min_words} OR {words(m - 1, '(i + 1)')} < {min_words})"
        options.append(f"IF(i + {m} <= size(w) AND {enough} AND {small}, "
                       f"named_struct('first', get(ln, i), 'last', get(ln, i + {m - 1}), 'size', {m}, 'name', {name(m)}), NULL)")
    runs = F.expr(f"flatten(transform(w, (y, i) -> filter(array({', '.join(options)}), r -> r IS NOT NULL)))")
    return df.select("id", "key", F.explode(runs).alias("r")).select("id", "key", "r.*")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 4, min_words: int = 50) -> DataFrame:
    """``(id, key, runs)``: per document the maximal line runs to delete, sorted, as ``array<struct<first, last>>``.

    Members of one interval (equal name and size) are occurrences of one run. The first of
    them in (id, text, line) order stays; the others are later copies. Touching or overlapping later
    copies in a document join into maximal runs."""
    found = saved(_runs(docs, id_col, text_col, min_lines, min_words), "line-runs")  # read twice: split and hashed once
    at = F.struct(F.col("id").isNull().alias("none"), "id", "key", "first")
    first = found.groupBy("name", "size").agg(F.min(at).alias("at"), F.max(at).alias("to")).where("at < to").select("name", "size", F.col("at").alias("at0"))
    later = found.join(first, ["name", "size"]).where(at > F.col("at0")).select("id", "key", "first", "last").distinct()
    # a maximal run starts where a line run begins after everything before it has ended
    edges = later.selectExpr("id", "key", "first", "last",
                             "coalesce(max(last) OVER (PARTITION BY id, key ORDER BY first, last ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -9) AS reach")
    runs = edges.selectExpr("*", "sum(IF(first > reach + 1, 1, 0)) OVER (PARTITION BY id, key ORDER BY first, last ROWS UNBOUNDED PRECEDING) AS run")
    runs = runs.groupBy("id", "key", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return runs.groupBy("id", "key").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))


#: Lines that stay, from the sorted runs that go.
KEPT = ("flatten(transform(sequence(0, size(runs)), j -> slice(lines, IF(j = 0, 1, get(runs, j - 1).last + 2), "
        "IF(j = size(runs), size(lines), get(runs, j).first) - IF(j = 0, 0, get(runs, j - 1).last + 1))))")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 4, min_words: int = 50) -> DataFrame:
    """Delete later copies of repeated line runs from ``text_col``; all other columns stay as they are.

    A text is its ``\\n``-separated lines; the line-ID sequence holds the lines with a word. A run of
    successive such lines counts if it has ``min_lines`` lines or ``min_words`` words. An occurrence of
    a counting run is deleted, with blank lines inside it, if the same run starts earlier:
    in a smaller ``id_col`` (NULL last, then by text hash) or higher up in the same text; runs are judged on
    the input. Lines are compared by 64-bit hashes of whole lines.

    Added columns (replacing columns of these names): ``n_lines``, ``n_removed`` (lines), ``n_runs``
    (maximal deleted runs). A NULL text stays NULL with zeros; an empty text is one line without
    words. Rows that agree in id and text are one document loaded twice and get one result. An empty
    table gives an empty one."""
    runs = repeated_runs(docs, id_col, text_col, min_lines, min_words)
    old = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("i"), F.xxhash64(F.col(text_col)).alias("k"))
    df = old.join(runs, old.i.eqNullSafe(runs.id) & (old.k == runs.key), "left")
    df = df.select("row", F.split(F.col("row")[text_col], "\n", -1).alias("lines"), "runs")
    n = F.expr("CASE WHEN lines IS NULL THEN 0L ELSE cast(size(lines) AS bigint) END")
    gone = F.expr("coalesce(aggregate(runs, 0L, (s, r) -> s + r.last - r.first + 1), 0L)")
    text = F.expr(f"CASE WHEN runs IS NULL THEN row.`{text_col}` ELSE array_join({KEPT}, '\n') END")
    new = ("n_lines", "n_removed", "n_runs")
    return df.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns if c not in new],
                     n.alias("n_lines"), gone.alias("n_removed"), F.expr("coalesce(cast(size(runs) AS bigint), 0L)").alias("n_runs"))


def keep_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` after `dedup_lines`, with its own columns: ``length_col`` follows the text, and a document of which lines were deleted
    and no word is left goes. A NULL text, and one that had no words before, stays."""
    done = dedup_lines(docs, id_col, text_col)
    if length_col in docs.columns:
        done = done.withColumn(length_col, F.length(text_col).cast("long"))
    emptied = (F.col("n_removed") > 0) & ~F.col(text_col).rlike(r"[^\x20\x09-\x0D]")
    return done.where(~emptied).select(*docs.columns)
