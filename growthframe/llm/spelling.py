"""Spelling variants: PartEnum signatures of letter multisets, an equi-join on them, exact verification."""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthframe.llm.common import arrow_map, saved

#: A run is a longest stretch of these letters.
_RUN = re.compile("[A-Za-z\u00C0-\u00FF]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Words that a task holds at a time, and characters of a text whose runs are listed at once.
HELD, LONG = 1 << 18, 1 << 20
#: One edit changes a letter multiset, as a binary vector over (letter, how many-th), in DISTANCE places at most.
DISTANCE = 2
#: The places are dealt into PARTS; a signature leaves DISTANCE of them out.
PARTS = 7
#: Words of one signature that are compared with one another at a time.
BLOCK = 1024


def _runs(text: str) -> Iterator[tuple[str, int]]:
    """The different runs of a text with their numbers; a long text gives them part by part."""
    if len(text) <= LONG:
        yield from Counter(_RUN.findall(text)).items()
        return
    held: Counter = Counter()
    for m in _RUN.finditer(text):
        held[m.group()] += 1
        if len(held) > HELD:
            yield from held.items()
            held = Counter()
    yield from held.items()


def _counted(least_length: int, thin: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def sent() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                head = zlib.crc32(f"{i}:".encode())
                for run, n in _runs(text or ""):
                    word = run if run.islower() else run.translate(_LOWER)
                    h = zlib.crc32(word.encode(), head)
                    if h % thin == 0:
                        k = h % len(word)
                        word = word[:k] + word[k + 1:]
                    if len(word) >= least_length:
                        held[word] = held.get(word, 0) + n
                if len(held) > HELD:
                    yield sent()
                    held.clear()
        if held:
            yield sent()

    return of


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_n: int = 3, thin: int = 97) -> DataFrame:
    """``(word, n)``: words of ``least_length`` code points that occur ``least_n`` times, over whole texts.

    A run has A-Z lower-cased, and nothing else. Where ``thin`` divides the CRC-32 of ``<id>:<run>``, the code point at
    that number modulo the length is left out. A NULL text has no runs, a NULL id is an empty one. Tasks count the
    runs of a text, then the words of many texts, and send them about ``HELD`` at a time; Spark adds them up."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    met = arrow_map(rows, _counted(least_length, thin), "word string, n long")
    return met.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def signatures(word: str) -> list[int]:
    """One for each way to leave out DISTANCE of the PARTS: multisets that differ in DISTANCE places share at least one.

    A place is a letter with its number among equal letters; it belongs to a part by both."""
    parts: list[list[str]] = [[] for _ in range(PARTS)]
    before, number = "", 0
    for c in sorted(word):
        number = number + 1 if c == before else 0
        before = c
        parts[(ord(c) * 5 + number * 3) % PARTS].append(c + chr(number + 1 if number < 0xD7FF else 0x10000 + number % 0xFFFFF))
    joined = ["".join(p) for p in parts]
    return [xxhash.xxh64_intdigest("\0".join([str(k), *(p for j, p in enumerate(joined) if j not in out)]).encode(), 5) - (1 << 63)
            for k, out in enumerate(itertools.combinations(range(PARTS), DISTANCE))]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    many = len(list(itertools.combinations(range(PARTS), DISTANCE)))
    for batch in batches:
        words = batch.column(0).to_pylist()
        flat = pa.array([s for w in words for s in signatures(w)], pa.int64())
        lists = pa.ListArray.from_arrays(pa.array(range(0, many * (len(words) + 1), many), pa.int32()), flat)
        yield pa.record_batch([batch.column(0), batch.column(1), lists], names=["word", "n", "signatures"])


def near_words(counts: DataFrame) -> DataFrame:
    """``(a, b, a_n, b_n)``: each two of the words that are one inserted, deleted or replaced code point apart, once (a < b).

    Words are joined on equal signatures; only pairs whose edit distance is 1 leave the join. A signature of many words is
    dealt into blocks of about ``BLOCK`` words by hash, and block pairs are joined, so that no task holds it whole."""
    signed = saved(arrow_map(counts.select("word", "n"), _signed, "word string, n long, signatures array<bigint>"), "signatures-of-words")
    rows = signed.select("word", "n", F.explode("signatures").alias("signature"))
    shared = saved(rows.groupBy("signature").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("m")).where("m > 1").drop("m"), "signatures")
    kept = saved(rows.join(shared, "signature").withColumn("block", F.pmod(F.xxhash64("word", F.lit(3)), "blocks").cast("int")), "signed-words")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    one = kept.select("signature", "block", other.alias("other"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    two = kept.select("signature", F.col("block").alias("other"), other.alias("block"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    # one edit leaves the half before it or the half after it as it is: told before the distance is worked out
    half = F.floor(F.least(F.length("a"), F.length("b")) / 2).cast("int")
    same = (F.left("a", half) == F.left("b", half)) | (F.right("a", half) == F.right("b", half))
    near = (F.col("a") < F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= 1) & same & (F.levenshtein("a", "b", 1) == 1)
    return one.join(two, ["signature", "block", "other"]).where(near).select("a", "b", "a_n", "b_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)``: where following the forms ends. Each form occurs twice as often at least, so
    chains are short; a round doubles the way that is followed."""
    now = saved(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        then = now.select(F.col("word").alias("w"), F.col("root").alias("further"))
        step = now.join(then, now.root == then.w).select("word", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved"))
        step = saved(step, "roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_n: int = 3, thin: int = 97) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of `word_counts`.

    ``n_near`` counts the words one edit away. ``form`` is the most frequent of them (of equals the smallest in code-point
    order) if it occurs at least twice as often as the word, else NULL; ``root`` is where following the forms ends, the
    word itself if there is none.

    One edit inserts or deletes a letter, or replaces one, so the letter multisets differ in two places at most, and
    `signatures` loses no pair. NULL and empty texts have no words; repeated rows count as often as they
    occur; other columns play no part; an empty table gives an empty one."""
    counts = saved(word_counts(docs, id_col, text_col, least_length, least_n, thin), "words")
    near = saved(near_words(counts), "near-words")
    both = near.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n"))
    both = both.union(near.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best"))
    enough = -F.col("best.minus") >= 2 * F.col("n")
    found = counts.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n"))
    found = saved(found, "forms")
    return found.join(roots(found), "word").select("word", "form", "root", "n", "n_near", "form_n")
