import pytest
from pyspark.sql import types as T

#: Columns whose names clash with those that operators work with or add.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in ("id", "key", "row", "shard", "ids", "n_lines", "fp", "h", "name", "quality", "tokens")],
])
CLASH = ("x",) * 11


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with clashing extra columns, from (doc_id, text[, lang]) rows, over several partitions."""

    def of(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", None if r[1] is None else len(r[1]), *CLASH) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return of


@pytest.fixture(scope="session")
def odd():
    """Rows every operator must take: NULLs in any column, empty and blank texts, repeated rows, ties, a very long text."""
    words = " ".join(f"w{k % 977}x{k % 31}" for k in range(60_000))
    return [
        (1, None, "en"), (None, "a b c d e"), (None, None, None), (2, ""), (3, " \n\t \n"), (4, "one"), (4, "one"), (5, "one"),
        (6, "two\nwords here\n" * 3, None), (6, "another text under the same id"), (7, words), (8, words), (9, "é ß 日本 👍🏽 ▁ \x00 end"), (10, "x" * 5000),
    ]
