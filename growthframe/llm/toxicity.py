"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy, over overlapping windows."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthframe.llm.common import arrow_map, word_pieces

#: Words of a window, and words by which windows move on: every word lies in two.
WINDOW, STEP = 32, 16
#: Buckets of character 3-grams, sizes of the vectors of words and 3-grams, and of the state in each direction.
GRAMS, WORD_SIZE, GRAM_SIZE, STATE = 1 << 13, 8, 12, 8
#: Bytes of a word; a longer one counts as successive words.
LONG = 48
#: A word has a vector of its own if so many documents of the sample hold it.
COMMON = 4
#: Windows of a document that take part in a training step, drawn anew each time.
MOST = 12
SIZE = WORD_SIZE + GRAM_SIZE
#: Bounds of the training sample: labelled documents of each class, and bytes of one of them (longer ones are not drawn).
PER_CLASS, LONGEST = 1500, 1 << 16


def _grams(word: bytes) -> list[int]:
    """Buckets of a lower-cased word's character 3-grams."""
    edged = b"<" + word + b">"
    return [zlib.crc32(edged[k:k + 3]) % GRAMS for k in range(len(edged) - 2)]


def _pieces(words: list[bytes]) -> list[bytes]:
    """The words, those of over ``LONG`` bytes as successive pieces of at most so many, which overlap by two bytes,
    so that no 3-gram is lost: text without spaces takes part in windows piece by piece."""
    if max(map(len, words), default=0) <= LONG:
        return words
    return [w[k:k + LONG] for w in words for k in range(0, max(1, len(w) - 2), LONG - 2)]


def _own(known: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Rows of the words' own vectors; row 0, all zero, is that of the others."""
    h = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    at = np.searchsorted(known, h)
    return np.where(known[np.minimum(at, len(known) - 1)] == h, at + 1, 0) if len(known) else np.zeros(len(h), np.int64)


def vectors(model: dict, words: list[bytes]) -> np.ndarray:
    """Input vectors of words: the word's own vector beside the mean of its character 3-grams'."""
    grams = [*map(_grams, words)]
    counts = np.array([*map(len, grams)])
    flat = np.array([g for gs in grams for g in gs])
    mean = np.add.reduceat(model["grams"][flat], np.cumsum(counts) - counts, axis=0) / counts[:, None]
    return np.concatenate([model["words"][_own(model["known"], words)], mean], 1).astype(np.float32)


def _windows(n: int) -> np.ndarray:
    """Starts of the windows over ``n`` words; the last one reaches the end."""
    return np.arange(0, max(1, n - WINDOW + STEP), STEP) if n > WINDOW else np.zeros(1, np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _direction(p: dict, side: str, gates: np.ndarray, live: np.ndarray, back: bool) -> tuple[np.ndarray, list]:
    """States (time, window, STATE) of one direction; ``gates`` are the input parts (time, window, 3 * STATE)."""
    steps, n, _ = gates.shape
    u = p["u" + side]
    h = np.zeros((n, STATE), np.float32)
    out, kept = np.empty((steps, n, STATE), np.float32), [None] * steps
    for t in range(steps - 1, -1, -1) if back else range(steps):
        x = gates[t]
        zr = _sigmoid(x[:, :2 * STATE] + h @ u[:, :2 * STATE])
        z, r = zr[:, :STATE], zr[:, STATE:]
        c = np.tanh(x[:, 2 * STATE:] + (r * h) @ u[:, 2 * STATE:])
        new = np.where(live[t][:, None], h + z * (c - h), h)
        kept[t] = (h, z, r, c)
        out[t] = h = new
    return out, kept


def forward(p: dict, gates: list[np.ndarray], live: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Probability of each window: both directions, attention over its words, one output."""
    one, kept_one = _direction(p, "f", gates[0], live, False)
    two, kept_two = _direction(p, "b", gates[1], live, True)
    h = np.concatenate([one, two], 2)
    a = np.tanh(h @ p["wa"])
    score = np.where(live, a @ p["va"], -1e9)
    weight = np.exp(score - score.max(0))
    weight /= weight.sum(0)
    pooled = (weight[:, :, None] * h).sum(0)
    return _sigmoid(pooled @ p["wo"] + p["bo"]), (h, a, weight, pooled, kept_one, kept_two)


def _direction_gradient(p: dict, side: str, dh_out: np.ndarray, kept: list, live: np.ndarray, back: bool, grad: dict) -> np.ndarray:
    steps, n, _ = dh_out.shape
    u, du = p["u" + side], np.zeros_like(p["u" + side])
    dgates = np.zeros((steps, n, 3 * STATE), np.float32)
    carry = np.zeros((n, STATE), np.float32)
    for t in range(steps) if back else range(steps - 1, -1, -1):
        h, z, r, c = kept[t]
        dh = dh_out[t] + carry
        m = live[t][:, None]
        dn = np.where(m, dh, 0)
        dz, dc = dn * (c - h) * z * (1 - z), dn * z * (1 - c * c)
        drh = dc @ u[:, 2 * STATE:].T
        dr = drh * h * r * (1 - r)
        dgates[t] = np.concatenate([dz, dr, dc], 1)
        du[:, :2 * STATE] += h.T @ dgates[t][:, :2 * STATE]
        du[:, 2 * STATE:] += (r * h).T @ dc
        carry = np.where(m, dn * (1 - z) + drh * r + dgates[t][:, :2 * STATE] @ u[:, :2 * STATE].T, dh)
    grad["u" + side] = du
    return dgates


def new_model(known: np.ndarray, seed: int = 7) -> dict:
    rng = np.random.default_rng(seed)
    draw = lambda *s, scale=0.2: (rng.standard_normal(s) * scale).astype(np.float32)
    p = {"words": np.zeros((1 + len(known), WORD_SIZE), np.float32), "grams": draw(GRAMS, GRAM_SIZE, scale=0.3)}
    for side in "fb":
        p |= {"w" + side: draw(SIZE, 3 * STATE), "u" + side: draw(STATE, 3 * STATE), "c" + side: np.zeros(3 * STATE, np.float32)}
    return p | {"wa": draw(2 * STATE, STATE), "va": draw(STATE), "wo": draw(2 * STATE), "bo": np.float32(-3)}


def train(texts: list[bytes], labels: list[int], rounds: int = 6, rate: float = 0.02, decay: float = 0.02, seed: int = 7) -> dict:
    """Fit the network to documents of which some window is toxic or none is (Adam)."""
    rng = np.random.default_rng(seed)
    words: dict[bytes, int] = {}
    docs = [np.array([words.setdefault(w, len(words)) for ws in word_pieces(t.lower()) for w in _pieces(ws)], np.int64) for t in texts]
    y = np.array(labels, np.float32)
    usable = [k for k, d in enumerate(docs) if len(d)]
    held = np.bincount(np.concatenate([np.zeros(0, np.int64), *map(np.unique, docs)]), minlength=len(words))
    known = np.unique([zlib.crc32(w) for w, n in zip(words, held) if n >= COMMON]).astype(np.int64)
    p = new_model(known, seed)
    if not words or len(set(y[usable])) < 2:
        return p | {"known": known}
    grams, own = [*map(_grams, words)], _own(known, [*words])
    sizes = np.array([*map(len, grams)])
    flat, begin = np.array([g for gs in grams for g in gs]), np.cumsum(sizes) - sizes
    cut = [(k, docs[k][s:s + WINDOW]) for k in usable for s in _windows(len(docs[k]))]
    whose = np.array([k for k, _ in cut])
    ids = np.full((WINDOW, len(cut)), -1)
    for j, (_, w) in enumerate(cut):
        ids[:len(w), j] = w
    moment, speed, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    groups = {k: np.flatnonzero(whose == k) for k in usable} if len(cut) < 2000 else dict(zip(usable, np.split(np.arange(len(cut)), np.flatnonzero(np.diff(whose)) + 1)))

    def inputs(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        part = ids[:, columns]
        live = part >= 0
        need, at = np.unique(np.maximum(part, 0), return_inverse=True)
        rows = np.repeat(np.arange(len(need)), sizes[need])
        member = flat[np.arange(len(rows)) - np.repeat(np.cumsum(sizes[need]) - sizes[need], sizes[need]) + begin[need][rows]]
        mean = np.zeros((len(need), GRAM_SIZE), np.float32)
        np.add.at(mean, rows, p["grams"][member])
        x = np.concatenate([p["words"][own[need]], mean / sizes[need][:, None]], 1)
        return x, live, [need, at.reshape(part.shape), rows, member]

    batch = min(96, max(16, len(usable) // 20))
    for _ in range(rounds):
        order = rng.permutation(usable)
        for first in range(0, len(order), batch):
            picked = order[first:first + batch]
            columns = np.concatenate([g if len(g) <= MOST else np.sort(rng.choice(g, MOST, replace=False)) for g in (groups[k] for k in picked)])
            x, live, (need, at, rows, member) = inputs(columns)
            gates = [(x @ p["w" + s] + p["c" + s])[at] for s in "fb"]
            prob, (h, a, weight, pooled, kept_one, kept_two) = forward(p, gates, live)
            # noisy-or: a document is toxic if any of its windows is; each window answers for its part
            edges = np.flatnonzero(np.append(True, np.diff(whose[columns]) != 0))
            none = np.exp(np.add.reduceat(np.log1p(-np.minimum(prob, 0.9999)), edges))
            some = np.repeat(1 - none, np.diff([*edges, len(columns)]))
            d = (prob * (1 - y[whose[columns]] / np.maximum(some, 1e-4)) / len(picked)).astype(np.float32)
            grad = {"wo": pooled.T @ d, "bo": d.sum()}
            dpool = d[:, None] * p["wo"]
            dweight = (h * dpool).sum(2)
            dscore = weight * (dweight - (weight * dweight).sum(0))
            da = dscore[:, :, None] * p["va"] * (1 - a * a)
            grad |= {"va": np.einsum("tn,tnk->k", dscore, a), "wa": np.einsum("tnj,tnk->jk", h, da)}
            dh = weight[:, :, None] * dpool + da @ p["wa"].T
            dx = np.zeros_like(x)
            for s, part, kept, back in (("f", dh[:, :, :STATE], kept_one, False), ("b", dh[:, :, STATE:], kept_two, True)):
                dg = np.zeros((len(x), 3 * STATE), np.float32)
                np.add.at(dg, at, _direction_gradient(p, s, part, kept, live, back, grad))
                grad |= {"w" + s: x.T @ dg, "c" + s: dg.sum(0)}
                dx += dg @ p["w" + s].T
            grad["words"], grad["grams"] = np.zeros_like(p["words"]), np.zeros_like(p["grams"])
            np.add.at(grad["words"], own[need], dx[:, :WORD_SIZE])
            grad["words"][0] = 0
            np.add.at(grad["grams"], member, (dx[:, WORD_SIZE:] / sizes[need][:, None])[rows])
            step += 1
            pace = rate * max(0.05, 1 - step / (rounds * math.ceil(len(order) / batch)))
            for k, g in grad.items():
                moment[k] = 0.9 * moment[k] + 0.1 * g
                speed[k] = 0.999 * speed[k] + 0.001 * g * g
                p[k] = (p[k] * (1 - pace * decay) - pace * (moment[k] / (1 - 0.9 ** step)) / (np.sqrt(speed[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return p | {"known": known}


class Scorer:
    """Scores whole texts; remembers the input parts of words."""

    def __init__(self, model: dict):
        self.p = model
        self.w = np.concatenate([model["wf"], model["wb"]], 1)
        self.c = np.concatenate([model["cf"], model["cb"]])
        self.at: dict[bytes, int] = {}
        self.parts = np.zeros((0, 6 * STATE), np.float32)

    def _ids(self, words: list[bytes]) -> np.ndarray:
        new = [*set(words).difference(self.at)]
        if len(self.at) + len(new) > 1 << 18:
            self.at, self.parts = {}, self.parts[:0]
            new = [*set(words)]
        if new:
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
            self.parts = np.concatenate([self.parts, vectors(self.p, new) @ self.w + self.c])
        return np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))

    def _run(self, words: list[bytes], begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Scores of the windows [begin, end) over ``words``."""
        ids = self._ids(words)
        out = np.empty(len(begins))
        for k in range(0, len(begins), 4096):
            a, b = begins[k:k + 4096], ends[k:k + 4096]
            at = a[None, :] + np.arange(WINDOW)[:, None]
            live = at < b
            parts = self.parts[ids[np.minimum(at, len(ids) - 1)]]
            out[k:k + 4096] = forward(self.p, [parts[:, :, :3 * STATE], parts[:, :, 3 * STATE:]], live)[0]
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """The highest score of a window of each text; that of an empty text is the bias alone."""
        best = np.full(len(texts), float(_sigmoid(self.p["bo"])))
        words: list[bytes] = []
        begins, ends, whose = [], [], []

        def flush() -> None:
            if begins:
                b = np.concatenate(begins)
                prob = self._run(words, b, np.concatenate(ends))
                np.maximum.at(seen, np.concatenate(whose), prob)
                words.clear(), begins.clear(), ends.clear(), whose.clear()

        seen = np.full(len(texts), -1.0)
        for k, text in enumerate(texts):
            carry: list[bytes] = []
            for piece in word_pieces(text.lower()):
                piece = carry + _pieces(piece)  # the last words of a piece begin the next one
                at = _windows(len(piece))
                begins.append(at + len(words))
                ends.append(np.minimum(at + WINDOW, len(piece)) + len(words))
                whose.append(np.full(len(at), k))
                words.extend(piece)
                carry = piece[-WINDOW:]
                if len(words) > 1 << 17:
                    flush()
        flush()
        return np.where(seen >= 0, seen, best)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> DataFrame:
    """A bounded sample of labelled documents: ``per_class`` of each class, by a hash of the id.

    Rows whose crc32 of the id as text leaves 2 when divided by 4 are held out and never taken."""
    known = labels.where("toxic IS NOT NULL").groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").alias("toxic"))
    known = known.where(F.crc32(F.col("id").cast("string")) % 4 != 2)
    parts = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(per_class) for c in (0, 1)]
    picked = parts[0].union(parts[1])
    short = docs.where(F.octet_length(text_col) <= LONGEST).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    one = short.join(F.broadcast(picked), "id")  # at most 2 * per_class rows
    return one.groupBy("id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, per_class: int = PER_CLASS) -> DataFrame:
    """``(id, held_out, score, predicted)`` per row: how likely the whole text is toxic, 0 to 1.

    The network is trained on `training_rows`, a sample of bounded size, and sees words and their
    characters alone. A text scores as its highest window; windows of ``WINDOW`` words start every
    ``STEP`` words over the whole text; a word of over ``LONG`` bytes counts as successive words. Texts without words (or NULL) get the score of the bias. Repeated
    rows give repeated results; NULL ids are not held out; other columns play no part; an empty table gives
    an empty one, and without labels of both classes the untrained network scores."""
    rows = sorted((r["id"], r["text"], r["toxic"]) for r in training_rows(docs, labels, id_col, text_col, per_class).collect())
    shared = docs.sparkSession.sparkContext.broadcast(train([t.encode() for _, t, _ in rows], [c for _, _, c in rows]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                batch = whole.slice(k, 1000)
                found = scorer.score([t or b"" for t in batch.column(1).to_pylist()])
                yield pa.record_batch([batch.column(0), pa.array(found, pa.float64())], names=["id", "score"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    out = arrow_map(slim, of, f"id {slim.schema['id'].dataType.simpleString()}, score double")
    held = F.coalesce(F.crc32(F.col("id").cast("string")) % 4 == 2, F.lit(False))
    return out.select("id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
