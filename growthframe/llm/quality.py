"""Quality rules: text statistics and the perplexity of a modified Kneser-Ney n-gram model."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthframe.llm.common import arrow_map, saved, word_pieces

# Model -----------------------------------------------------------------------------------------
# Runs of ORDER code points, of all documents, in tables that grow with the corpus. The most frequent n-grams travel to the tasks
# as sorted arrays of their hashes, a bounded table; all others are looked up by a join.

ORDER = 4
#: N-grams that tasks look up by themselves (16 bytes each).
FREQUENT = 1 << 20
#: Stands before a text, and for the code point 0 (fixed-width strings drop it at their end).
PAD, NUL = 0xFFFF, 0xFFFE
#: Characters that are joined before they are counted or scored, and different n-grams that a task holds.
_CHARS, _HELD = 1 << 20, 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _plain() -> np.ndarray:
    """What a code point of the first plane counts as: signs as one sign, digits as one digit, blanks as a space; all letters and
    marks of any script as themselves. A text that is strewn with signs is then easy to predict, and the lower edge of a band shows it."""
    out = np.arange(0x10000, dtype=np.uint32)
    for cp in range(0x10000):
        ch = chr(cp)
        kind = unicodedata.category(ch)
        if kind[0] == "S" or ch in "#*%&":
            out[cp] = ord("#")
        elif kind[0] == "N":
            out[cp] = ord("0")
        elif ch.isspace() and ch != "\n":
            out[cp] = ord(" ")
    out[0] = NUL
    return out


_PLAIN = _plain()


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the n-gram that ends at each character of the joined texts, where each text begins, the characters with pads
    before each text, and the place of each character among them."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate([[0], np.cumsum([*map(len, texts)])])
    at = np.arange(len(points)) + np.arange(1, len(texts) + 1).repeat(np.diff(starts)) * (ORDER - 1)
    line = np.full(len(points) + (len(texts) + 1) * (ORDER - 1), PAD, np.uint32)
    line[at] = np.where(points < 0x10000, _PLAIN[np.minimum(points, 0xFFFF)], points)
    h = np.zeros(len(points), np.uint64)
    for back in range(ORDER - 1, -1, -1):
        h = h * _ODD + line[at - back]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32)), starts, line, at


def _batched(parts: Iterator[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    held, n = [], 0
    for p in parts:
        held.append(p)
        n += len(p[1])
        if n >= _CHARS:
            yield held
            held, n = [], 0
    if held:
        yield held


def _pieces(texts: list) -> Iterator[tuple[int, str]]:
    """(number, part) of each text; a long one in parts that are counted and scored one after another, so that memory is bounded."""
    for i, t in enumerate(texts):
        for k in range(0, len(t or ""), _CHARS):
            yield i, t[k:k + _CHARS]


def _merged(parts: list) -> list:
    """Counts of equal hashes added up: [(hash, count, n-gram)] with one entry."""
    h, n, g = (np.concatenate(x) for x in zip(*parts))
    u, first, back = np.unique(h, return_index=True, return_inverse=True)
    return [(u, np.bincount(back, n, len(u)).astype(np.int64), g[first])]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list = []
    size = 0

    def sent() -> Iterator[pa.RecordBatch]:
        for h, n, g in _merged(parts) if parts else ():
            for k in range(0, len(h), 1 << 16):
                text = np.ascontiguousarray(g[k:k + (1 << 16)]).view(f"<U{ORDER}").reshape(-1).tolist()
                yield pa.record_batch([pa.array(text, pa.string()), pa.array(h[k:k + (1 << 16)].view(np.int64)), pa.array(n[k:k + (1 << 16)])], names=["gram", "h", "n"])

    for batch in batches:
        for held in _batched(_pieces(batch.column(0).to_pylist())):
            h, _, line, at = _grams([p for _, p in held])
            u, first, n = np.unique(h, return_index=True, return_counts=True)
            parts.append((u, n, line[at[first][:, None] + np.arange(1 - ORDER, 1)]))
            size += len(u)
            if size > 2 * _HELD:
                parts = _merged(parts)
                size = len(parts[0][0])
                if size > _HELD:
                    yield from sent()
                    parts, size = [], 0
    yield from sent()


def count_grams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(gram, h, n)``: every n-gram of the highest order with its hash and its number, over all characters of all documents.

    A task adds up its own n-grams and sends each once, or about ``_HELD`` at a time."""
    met = arrow_map(docs.select(F.col(text_col).alias("text")), _counted, "gram string, h long, n long")
    return met.groupBy("gram").agg(F.first("h").alias("h"), F.sum("n").alias("n"))


def train(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(h, n, logp)``: modified Kneser-Ney log probability of the last character of every n-gram that occurs, and its number.

    Each order takes its discounts for counts of 2 and of 3 or more from its counts of counts (four numbers); lower orders
    count in how many different longer n-grams each one ends (continuation counts). What was met once is discounted
    in full: the scored texts are part of the corpus, and an n-gram must not vouch for itself. Probabilities are interpolated from
    the shortest order up, by joins on the context and on the shorter n-gram."""
    top = saved(count_grams(docs, text_col), "grams")
    counts = {ORDER: top.select("gram", F.col("n").alias("c"))}
    for k in range(ORDER - 1, 0, -1):
        shorter = counts[k + 1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("c"))
        counts[k] = saved(shorter, f"grams-{k}")
    below = None
    for k in range(1, ORDER + 1):
        c = counts[k]
        many = c.agg(F.count("*"), *[F.count_if(F.col("c") == j) for j in (1, 2, 3, 4)]).first()
        n1, n2, n3, n4 = (max(1, x) for x in many[1:])
        y = n1 / (n1 + 2 * n2)
        two, more = min(max(2 - 3 * y * n3 / n2, 0.0), 1.9), min(max(3 - 4 * y * n4 / n3, 0.0), 2.85)
        d = F.when(F.col("c") == 1, 1.0).when(F.col("c") == 2, two).otherwise(more)
        c = c.withColumn("ctx", F.expr(f"left(gram, {k - 1})")).withColumn("own", F.col("c") - d).withColumn("d", d)
        of = c.groupBy("ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("off")).withColumnRenamed("ctx", "x")
        c = c.join(of, F.col("ctx") == F.col("x"))
        if below is None:
            low = F.lit(1.0 / (many[0] + 1))
        else:
            c = c.withColumn("short", F.expr("substring(gram, 2)")).join(below, "short")
            low = F.col("p")
        c = c.select("gram", ((F.col("own") + F.col("off") * low) / F.col("total")).alias("p"))
        below = c.select(F.col("gram").alias("short"), "p")
    return saved(top.join(below, F.col("gram") == F.col("short")).select("h", "n", F.log("p").alias("logp")), "model")


def frequent(model: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the ``FREQUENT`` most frequent n-grams, and their log probabilities."""
    t = model.orderBy(F.desc("n"), "h").limit(FREQUENT).select("h", "logp").toArrow()
    h, p = t["h"].to_numpy().view(np.uint64), t["logp"].to_numpy()
    order = np.argsort(h)
    return h[order], p[order]


def log_sums(known: tuple[np.ndarray, np.ndarray], texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text the sum of the log probabilities of its frequent n-grams; and (text, hash, number) of all others."""
    hashes, logs = known
    sums, who, rest = np.zeros(len(texts)), [], []
    for held in _batched(_pieces(texts)):
        h, starts, _, _ = _grams([p for _, p in held])
        at = np.minimum(np.searchsorted(hashes, h), max(len(hashes) - 1, 0))
        hit = hashes[at] == h if len(hashes) else np.zeros(len(h), bool)
        np.add.at(sums, [i for i, _ in held], np.add.reduceat(np.where(hit, logs[at] if len(hashes) else 0.0, 0.0), starts[:-1]))
        who.append(np.repeat([i for i, _ in held], np.diff(starts))[~hit])
        rest.append(h[~hit])
    who, rest = (np.concatenate([np.zeros(0, t), *x]) for x, t in ((who, np.int64), (rest, np.uint64)))
    order = np.lexsort((rest, who))
    who, rest = who[order], rest[order]
    first = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (rest[1:] != rest[:-1]))) if len(who) else np.zeros(0, np.int64)
    return sums, who[first], rest[first], np.diff(np.append(first, len(who)))


# Rules ------------------------------------------------------------------------------------------

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _repeated(hashes: np.ndarray) -> int:
    """Words in 8-word windows that are found twice or more."""
    n = len(hashes) - WINDOW + 1
    if n < 2:
        return 0
    window = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        window = window * _BASE + hashes[k:k + n]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(twice)
    step[at] += 1
    step[at + WINDOW] -= 1
    return int((np.cumsum(step) > 0).sum())


def base_statistics(data: bytes) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text in UTF-8."""
    hashes = [np.fromiter(map(hash, words), np.int64, len(words)) for words in word_pieces(data)]
    words = np.concatenate(hashes).view(np.uint64) if hashes else np.zeros(0, np.uint64)
    solid = data.translate(None, b" \t\n\r\x0b\x0c")
    chars = len(solid.decode("utf-8", "replace")) if not solid.isascii() else len(solid)
    lines = [x for x in data.split(b"\n") if x.strip()]
    return len(words), chars, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), _repeated(words)


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def scored(docs: DataFrame, model: DataFrame, text_col: str = "text") -> DataFrame:
    """``(row, rid, quality)``: the rows of ``docs`` with a struct of the base statistics, ``base_failed``, ``nll`` (mean negative log
    probability of a character; NULL without one) and ``n_chars``. Written once.

    Tasks add up what the frequent n-grams of a text give and note all others, which meet the whole model by a join on the hash. An
    n-gram that the model doesn't know (in other texts than it was trained on) counts as the least probable it knows."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent(model))
    kinds = [pa.field(c, pa.int64()) for c in STATISTICS] + [pa.field("base_failed", pa.bool_()), pa.field("part", pa.float64()), pa.field("n_chars", pa.int64())]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 2000):
                batch = whole.slice(k, 2000)
                texts = [t or "" for t in batch.column(2).to_pylist()]
                base = np.array([base_statistics(t.encode("utf-8", "replace")) for t in texts], np.int64).reshape(-1, len(STATISTICS))
                failed = (base[:, 0] < 20) | (100 * base[:, 4] > 30 * base[:, 0])
                sums, who, rest, n = log_sums(shared.value, texts)
                parts = [pa.array(base[:, j]) for j in range(len(STATISTICS))] + [pa.array(failed), pa.array(sums), pa.array([*map(len, texts)], pa.int64())]
                ends = pa.array(np.searchsorted(who, np.arange(len(texts) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, x) for x in (pa.array(rest.view(np.int64)), pa.array(n, pa.int32()))]
                yield pa.record_batch([batch.column(0), batch.column(1), pa.StructArray.from_arrays(parts, fields=kinds), *lists], names=["row", "rid", "found", "rest", "times"])

    kept = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("rid"), F.col(text_col).alias("text"))
    schema = f"row {docs.schema.simpleString()}, rid long, found struct<{', '.join(c + ': bigint' for c in STATISTICS)}, base_failed: boolean, part: double, n_chars: bigint>, rest array<bigint>, times array<int>"
    found = saved(arrow_map(kept, of, schema), "scored")  # the numbers of the rows stay as written
    rest = found.select("rid", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("rid", F.col("x.rest").alias("h"), F.col("x.times").alias("times"))
    least = model.agg(F.coalesce(F.min("logp"), F.lit(0.0)).alias("l")).scalar()
    sums = rest.join(model.select("h", "logp"), "h", "left").groupBy("rid").agg(F.sum(F.col("times") * F.coalesce("logp", least)).alias("more"))
    n = F.col("found.n_chars")
    nll = F.when(n > 0, -(F.col("found.part") + F.coalesce("more", F.lit(0.0))) / n)
    fields = [F.col(f"found.{c}").alias(c) for c in (*STATISTICS, "base_failed")]
    return found.join(sums, "rid", "left").select("row", "rid", F.struct(*fields, nll.alias("nll"), n.alias("n_chars")).alias("quality"))


def bands(values: DataFrame) -> DataFrame:
    """``(lang, middle, spread)`` of the mean log perplexity, from all documents of a language that pass the base rules.

    ``middle`` is the median. The mean over n characters strays from it by about ``spread`` / sqrt(n);
    ``spread`` is taken from the median of the distance times sqrt(n)."""
    good = values.where("NOT base_failed AND nll IS NOT NULL")
    middle = saved(good.groupBy(F.col("lang").alias("of")).agg(F.percentile_approx("nll", 0.5, 10000).alias("middle")), "middles")
    far = F.abs(F.col("nll") - F.col("middle")) * F.sqrt("n_chars")
    near = good.join(middle, good.lang.eqNullSafe(middle.of))
    return near.groupBy("of", "middle").agg((1.4826 * F.percentile_approx(far, 0.5, 10000)).alias("spread"))


def judged(found: DataFrame, limits: DataFrame, least: float = 0.02, reach: float = 4.0) -> DataFrame:
    """``found`` (row, lang, quality) with ``low``, ``high`` and ``kept``: the base rules hold and the mean log
    perplexity lies in its language's band, ``middle`` +- (``least`` + ``reach`` * ``spread`` / sqrt(n))."""
    half = least + reach * F.col("spread") / F.sqrt(F.greatest("quality.n_chars", F.lit(1)))
    both = found.join(limits, found.lang.eqNullSafe(limits.of), "left").withColumn("low", F.col("middle") - half).withColumn("high", F.col("middle") + half)
    verdict = ~F.col("quality.base_failed") & F.coalesce(F.col("quality.nll").between(F.col("low"), F.col("high")), F.lit(True))
    return both.withColumn("kept", verdict).drop("of", "middle", "spread")


def _values(found: DataFrame) -> DataFrame:
    return found.select("lang", "quality.base_failed", "quality.nll", "quality.n_chars")


def quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, the base statistics, ``base_failed``, ``perplexity`` (per character), ``low``, ``high`` and ``kept``.

    Words are separated by space and 0x09 to 0x0D. A document fails the base rules with fewer than
    20 words, or with over 30 % of its words in repeated 8-word windows. The others are rejected if
    their perplexity under the corpus' own model lies outside the band of their language (rows of
    NULL language are one language). A NULL text counts as empty and fails. Repeated rows give repeated
    results; other columns play no part; an empty table gives an empty one."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    found = scored(slim, train(docs, text_col), "text").select("row.id", "row.lang", "quality")
    found = saved(found, "quality")
    limits = saved(bands(_values(found)), "bands")
    out = judged(found, limits)
    return out.select(F.col("id").alias(id_col), *[F.col(f"quality.{c}").alias(c) for c in (*STATISTICS, "base_failed")],
                      F.exp("quality.nll").alias("perplexity"), F.exp("low").alias("low"), F.exp("high").alias("high"), "kept")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that `quality` keeps, unchanged. Rows are scored once and written with their score."""
    found = saved(scored(docs, train(docs, text_col), text_col).select("row", F.col("row")[lang_col].alias("lang"), "quality"), "judged")
    limits = saved(bands(_values(found)), "bands")
    return judged(found, limits).where("kept").select("row.*")
