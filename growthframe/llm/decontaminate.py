"""Benchmark decontamination: shared word runs and latent semantic search for benchmark items, then word alignment and an answer check."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthframe.llm.common import arrow_map
from growthframe.llm.word_stream import chunks, words_of

#: Buckets of hashed terms and latent dimensions: every matrix that is gathered or broadcast has TERMS x RANK cells at most.
BITS, RANK = 10, 128
TERMS = 1 << BITS
#: Words of the passages that the decomposition is fitted to; words of a block, by which search windows move on.
PASSAGE, BLOCK = 96, 8
#: Benchmark items that are searched for at a time.
ITEMS = 20_000
#: Successive words that make a candidate by themselves (all of an item of fewer words), and what their hashes are built with.
RUN = 3
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _places(text: np.ndarray) -> np.ndarray:
    """Place of each word in its text."""
    new = np.append(True, text[1:] != text[:-1]) if len(text) else np.zeros(0, bool)
    return np.arange(len(text)) - np.maximum.accumulate(np.where(new, np.arange(len(text)), 0))


def _runs(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on, across the ends of texts; those of fewer words are left out."""
    n = max(0, len(h) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _STEP + h[k:n + k]
    out ^= out >> np.uint64(32)
    return out * _STEP


def _words(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for first, texts in chunks([t or b"" for t in batch.column(column).to_pylist()]):
            yield batch, first, *words_of(texts)


def _passages(text: np.ndarray) -> np.ndarray:
    """Number of each word's passage: PASSAGE words of one text, fewer at its end."""
    return np.cumsum(_places(text) % PASSAGE == 0) - 1


def term_weights(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Inverse frequency of each term, from the passages of all documents, and how many documents have words.

    It is counted over the passages that the decomposition is fitted to, so that long documents, in which every
    term occurs, leave the terms apart; no weight is 0, so that what all passages hold can still be found."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, passages, n = np.zeros(TERMS, np.int64), 0, 0
        for _, _, h, text in _words(batches, 0):
            if len(text):
                passage = _passages(text)
                has = np.zeros((int(passage[-1]) + 1, TERMS), bool)
                has[passage, _terms(h)] = True
                seen += has.sum(0)
                passages += len(has)
                n += len(np.unique(text))
        yield pa.record_batch([pa.array(np.arange(TERMS + 2), pa.int32()), pa.array(np.append(seen, [passages, n]))], names=["term", "n"])

    rows = arrow_map(texts, of, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # TERMS + 2 rows
    n = np.zeros(TERMS + 2)
    for r in rows:
        n[r["term"]] = r["n"]
    return np.log((1.5 + n[-2]) / (0.5 + n[:-2])).astype(np.float32), int(n[-1])


def _gram_times(texts: DataFrame, weights: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """X'X times ``matrix`` for the TF-IDF matrix X of all passages: each task adds up its passages, Spark the tasks."""
    scaled = (matrix * weights[:, None]).astype(np.float32)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((TERMS, RANK))
        for _, _, h, text in _words(batches, 0):
            if len(text):
                passage = _passages(text)
                x = np.bincount(passage * TERMS + _terms(h), minlength=(passage[-1] + 1) * TERMS).reshape(-1, TERMS).astype(np.float32)
                total += x.T @ (x @ scaled)
        cells = (total * weights[:, None]).reshape(-1)
        yield pa.record_batch([pa.array(np.arange(len(cells)), pa.int32()), pa.array(cells)], names=["cell", "value"])

    found = arrow_map(texts, of, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()  # TERMS * RANK rows
    out = np.zeros(TERMS * RANK)
    out[found["cell"].to_numpy()] = found["value"].to_numpy()
    return out.reshape(TERMS, RANK)


def latent_space(docs: DataFrame, text_col: str = "text", seed: int = 1) -> np.ndarray:
    """Term vectors (TERMS x RANK) of the corpus' latent space, by a distributed randomised SVD with one power step.

    A random matrix is sent through X'X and orthogonalised; X'X in that basis gives singular values and
    right singular vectors. Vectors are scaled by weight over singular value, so that a passage's sum of them is its
    latent vector with equal variance in all directions. Directions are trusted by the number of documents: with
    few of them, against the rank, the scale is nearly the same for all directions."""
    texts = docs.select(F.col(text_col).cast("binary").alias("text"))
    weights, n = term_weights(texts)
    start = np.random.default_rng(seed).standard_normal((TERMS, RANK))
    basis = np.linalg.qr(_gram_times(texts, weights, start))[0]
    small = basis.T @ _gram_times(texts, weights, basis)
    value, turn = np.linalg.eigh((small + small.T) / 2)
    scale = np.sqrt(np.maximum(value, 0) + max(value.max(), 1e-9) * RANK / max(1, n))
    return (basis @ turn / scale * weights[:, None]).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-12)


def lcs(marks: dict[int, int], size: int, other: list[int], least: int = 0) -> int:
    """Length of the longest common subsequence of an item (bit masks of its words' places) and other words, 64 and
    more at a time; 0 if too few words are shared for it to reach ``least``."""
    shared = [marks[w] for w in other if w in marks]
    if len(shared) < least:
        return 0
    row = full = (1 << size) - 1
    for m in shared:
        hit = row & m
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


class Items:
    """A block of benchmark items: latent vectors by window size, their word runs, and what the alignment needs."""

    def __init__(self, space: np.ndarray, rows: list[tuple], share: float, answer_share: float):
        self.space, self.by_window = np.concatenate([space, np.zeros((1, RANK), np.float32)]), {}  # the last term is none
        groups: dict[int, list] = {}
        runs: dict[int, list] = {}
        for item, text in rows:
            h, _ = words_of([(text or "").encode()])
            n = len(h)
            if n:
                window = 3 * BLOCK
                while window < n + BLOCK - 1:  # some window of this size holds the whole item, wherever it starts
                    window += max(BLOCK, int(window * 0.7) // BLOCK * BLOCK)
                need = n if n < 8 else max(8, math.ceil(share * n))
                last = h[n - math.ceil(n / 3):].tolist()  # the answer: the last third of the item's words
                found = groups.setdefault(window, [])
                own = _runs(h, min(RUN, n))
                runs.setdefault(min(RUN, n), []).append((own, np.full(len(own), window), np.full(len(own), len(found)), np.arange(len(own))))
                found.append((item, h, need, last, math.ceil(answer_share * len(last))))
        masks = lambda words: {w: sum(1 << k for k, x in enumerate(words) if x == w) for w in set(words)}
        for window, found in groups.items():
            vectors = _unit(np.stack([space[_terms(h)].sum(0) for _, h, _, _, _ in found]))
            self.by_window[window] = vectors.astype(np.float32), [(i, masks(h.tolist()), len(h), need, masks(a), len(a), enough) for i, h, need, a, enough in found]
        self.runs = {}  # by run length: which leading bits occur, sorted hashes, and window, item and place of each
        for size, parts in runs.items():
            own, *rest = map(np.concatenate, zip(*parts))
            order, bits = np.argsort(own, kind="stable"), min(24, max(12, int(len(own)).bit_length() + 4))
            met = np.zeros(1 << bits, bool)
            met[own >> np.uint64(64 - bits)] = True
            self.runs[size] = np.uint64(64 - bits), met, own[order], [x[order] for x in rest]

    def candidates(self, h: np.ndarray, text: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(word of ``h``, window, item's number, place in the item) of every run that a text and an item share."""
        for size, (shift, met, own, rest) in self.runs.items():
            run = _runs(h, size)
            at = np.flatnonzero(met[run >> shift])
            at = at[text[at] == text[at + size - 1]]
            low, high = np.searchsorted(own, run[at], "left"), np.searchsorted(own, run[at], "right")
            times = high - low
            hit = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
            yield np.repeat(at, times), *[x[hit] for x in rest]

    def search(self, h: np.ndarray, text: np.ndarray, least: float) -> Iterator[tuple[int, object, float, int, int]]:
        """(text, item, cosine, common words, item's words) of every item found, over all windows of the texts."""
        if not self.by_window:
            return
        place = _places(text)
        docs, first = np.unique(text, return_index=True)
        words = np.diff(np.append(first, len(text)))
        blocks = -(-words // BLOCK)
        # a text's blocks in a row, then as many empty ones as the widest window has: no window reaches the next text
        gap = max(self.by_window) // BLOCK
        begin = np.cumsum(blocks + gap) - blocks - gap
        whose = np.repeat(np.arange(len(docs)), words)
        terms = np.full((int(begin[-1] + blocks[-1]) + gap, BLOCK), TERMS)
        terms[begin[whose] + place // BLOCK, place % BLOCK] = _terms(h)
        sums = self.space[terms[:, 0]]
        for k in range(1, BLOCK):
            sums += self.space[terms[:, k]]
        owner = np.repeat(np.arange(len(docs)), blocks)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        shared: dict[int, list] = {}
        for word, window, j, offset in self.candidates(h, text):
            # where the item would begin; candidates that begin in one block of a text are one
            begins = place[word] - offset
            key = np.unique(np.stack([window, whose[word], j, begins // BLOCK]), axis=1, return_index=True)[1]
            for w, *rest in zip(*(x[key].tolist() for x in (window, whose[word], j, begins))):
                shared.setdefault(w, []).append(rest)
        for window, (vectors, items) in self.by_window.items():
            m = window // BLOCK
            starts = (inside <= blocks[owner] - m) | (inside == 0)
            doc, at = owner[starts], inside[starts]
            z = _moving_sum(sums, m)[begin[doc] + at]
            cosine = z @ vectors.T
            cosine /= np.sqrt(np.einsum("ij,ij->i", z, z))[:, None] + 1e-12
            done = set()

            def aligned(d: int, j: int, low: int, high: int) -> int:
                """Words that the item and these of the text have in common, in order; 0 if too few, or too few of the answer."""
                _, marks, n, need, answer, size, enough = items[j]
                near = h[first[d] + max(0, low):first[d] + min(words[d], high)].tolist()
                common = lcs(marks, n, near, need)
                return common if common >= need and lcs(answer, size, near, enough) >= enough else 0

            for i, j in zip(*(x.tolist() for x in np.nonzero(cosine >= least))):
                d = int(doc[i])
                if (d, j) not in done and (common := aligned(d, j, (at[i] - 1) * BLOCK, (at[i] + m + 1) * BLOCK)):
                    done.add((d, j))
                    yield int(docs[d]), items[j][0], float(cosine[i, j]), common, items[j][2]
            for d, j, begins in shared.get(window, ()):
                low = begins - (window - items[j][2]) // 2 - BLOCK  # as many words as a window of the other way, around the item
                if (d, j) not in done and (common := aligned(d, j, low, low + window + 2 * BLOCK)):
                    done.add((d, j))
                    near = cosine[np.searchsorted(doc, d):np.searchsorted(doc, d, "right"), j]
                    yield int(docs[d]), items[j][0], float(near.max()), common, items[j][2]


def _moving_sum(rows: np.ndarray, m: int) -> np.ndarray:
    """Sum of ``m`` rows from each row on (fewer at the end), by doubling."""
    out, done, power, size = None, 0, rows, 1
    while True:
        if m & size:
            if out is None:
                out = power.copy()
            else:
                out[:len(rows) - done] += power[done:]
            done += size
        if done == m:
            return out
        power = np.concatenate([power[:len(rows) - size] + power[size:], power[len(rows) - size:]])
        size *= 2


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               least: float = 0.45, share: float = 0.6, answer_share: float = 0.5) -> DataFrame:
    """``(id, key, item_id, cosine, n_common, n_item)``: items of ``benchmark`` that documents hold, also in other words.

    Every item is a query against every window of every document, in two ways: places that share ``RUN`` successive
    words with the item (all of them, for an item of fewer) are candidates whatever their cosine, so no item that
    stands there word for word is lost; so are windows whose latent vectors have a cosine of ``least`` or more
    with the item's. Candidates are aligned: the longest common subsequence must have ``share``
    of the item's words (8 at least; all, for an item of fewer), and the item's last third, its answer,
    ``answer_share`` of its words. ``cosine`` is that of the first window found, or the document's highest for
    the item if only a shared run led to it. Words are lower-cased runs of letters, digits and characters beyond ASCII.

    Items are searched for in blocks of ``ITEMS``, so what is broadcast is bounded. NULL or empty
    texts and items match nothing; repeated rows give repeated results (``key`` is a hash of the text); an empty
    table on either side gives an empty result."""
    space = latent_space(docs, text_col)
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where("text IS NOT NULL")
    n = max(1, math.ceil(items.count() / ITEMS * 1.2)) if items.limit(ITEMS + 1).count() > ITEMS else 1
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("key"), F.col(text_col).cast("binary").alias("text"))
    kind = items.schema["item"].dataType.simpleString()
    found = None
    for k in range(n):
        rows = [(r["item"], r["text"]) for r in items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).collect()]
        one = arrow_map(slim, _searcher(docs.sparkSession.sparkContext.broadcast((space, rows)), least, share, answer_share, slim.schema["id"].dataType, items.schema["item"].dataType),
                              f"id {slim.schema['id'].dataType.simpleString()}, key long, item_id {kind}, cosine double, n_common long, n_item long")
        found = one if found is None else found.union(one)
    return found


def _searcher(shared, least: float, share: float, answer_share: float, id_type, item_type):
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(id_type), pa.int64(), to_arrow_type(item_type), pa.float64(), pa.int64(), pa.int64()]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*shared.value, share, answer_share)
        for batch, first, h, text in _words(batches, 2):
            if len(h):
                found = [(batch.column(0)[first + doc].as_py(), batch.column(1)[first + doc].as_py(), *rest) for doc, *rest in items.search(h, text, least)]
                if found:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), types)], names=["id", "key", "item_id", "cosine", "n_common", "n_item"])

    return of


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which `find_leaks` finds no item, unchanged."""
    bad = find_leaks(docs, benchmark, id_col, text_col, **options).select("id", "key").distinct()
    same = docs[id_col].eqNullSafe(bad["id"]) & F.xxhash64(docs[text_col]).eqNullSafe(bad["key"])
    return docs.join(bad, same, "left_anti")
