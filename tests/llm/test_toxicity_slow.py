"""The network word by word, in plain Python, against the batched scorer; and its accuracy on the given labels."""

import math
import random
import zlib

import numpy as np

from growthframe.llm import toxicity as T
from growthframe.llm.queries import QUERIES
from tests.conftest import SF_MID


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def word_vector(p, word):
    edged = b"<" + word + b">"
    grams = [p["grams"][zlib.crc32(edged[k:k + 3]) % T.GRAMS] for k in range(len(edged) - 2)]
    own = {int(h): k + 1 for k, h in enumerate(p["known"])}.get(zlib.crc32(word), 0)
    return np.concatenate([p["words"][own], np.mean(grams, 0)]).astype(float)


def one_way(p, side, inputs):
    h, out = np.zeros(T.STATE), []
    for x in inputs:
        g = x @ p["w" + side] + p["c" + side]
        u, s = p["u" + side], T.STATE
        z = np.array([sigmoid(g[k] + h @ u[:, k]) for k in range(s)])
        r = np.array([sigmoid(g[s + k] + h @ u[:, s + k]) for k in range(s)])
        c = np.tanh(g[2 * s:] + (r * h) @ u[:, 2 * s:])
        h = h + z * (c - h)
        out.append(h)
    return out


def slow_window(p, words):
    x = [word_vector(p, w) for w in words]
    h = [np.concatenate(pair) for pair in zip(one_way(p, "f", x), one_way(p, "b", x[::-1])[::-1])]
    scores = [float(np.tanh(v @ p["wa"]) @ p["va"]) for v in h]
    weights = np.exp(np.array(scores) - max(scores))
    return sigmoid(float((weights[:, None] * np.array(h)).sum(0) / weights.sum() @ p["wo"] + p["bo"]))


def slow_score(p, text):
    words = text.lower().split()
    if not words:
        return sigmoid(float(p["bo"]))
    starts = [0] if len(words) <= T.WINDOW else range(0, len(words) - T.WINDOW + T.STEP, T.STEP)
    return max(slow_window(p, words[s:s + T.WINDOW]) for s in starts)


def test_scores_equal_the_network_word_by_word():
    rng = random.Random(6)
    vocabulary = [bytes(rng.choices(b"abcdefgh", k=rng.randint(1, 9))) for _ in range(80)]
    known = np.unique([zlib.crc32(w) for w in vocabulary[:40]])
    p = T.new_model(known, seed=3)
    p["words"][1:] = np.random.default_rng(1).normal(0, 0.5, p["words"][1:].shape)
    p["bo"] = np.float32(-0.4)
    p |= {"known": known}
    texts = [b" ".join(rng.choices(vocabulary, k=n)) for n in (1, 2, 5, 31, 32, 33, 48, 49, 100, 129)] + [b"", b" \n", b"Same SAME same"]
    assert np.allclose(T.Scorer(p).score(texts), [slow_score(p, t) for t in texts], atol=2e-5)


def test_toxic_spans_are_found_at_every_offset():
    """Windows begin every STEP words: a span of 17 to 32 words may lie in no window whole, and must not be lost for it."""
    rng = random.Random(8)
    calm, harsh = [f"calm{k}".encode() for k in range(300)], [f"vile{k}".encode() for k in range(12)]
    texts, labels = [], []
    for k in range(420):
        words = rng.choices(calm, k=rng.randint(40, 160))
        if k % 3 == 0:
            at = rng.randrange(len(words))
            words[at:at] = rng.choices(harsh, k=rng.randint(4, 30))
        texts.append(b" ".join(words))
        labels.append(int(k % 3 == 0))
    scorer = T.Scorer(T.train(texts, labels))
    probe = []
    for n in (17, 24, 32):
        for offset in range(T.STEP):
            words = rng.choices(calm, k=200)
            words[64 + offset:64 + offset] = rng.choices(harsh, k=n)
            probe.append(b" ".join(words))
    assert (scorer.score(probe) >= 0.3).all()


def test_held_out_rows_of_the_given_labels(spark):
    got = {r["doc_id"]: r for r in QUERIES["op9_toxicity"](spark, SF_MID).collect()}
    rows = [(got[r["doc_id"]], r["toxic"]) for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect() if r["doc_id"] in got]
    held = [(r["score"], r["predicted"], y) for r, y in rows if r["held_out"]]
    good, bad = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    assert len(good) >= 5 and len(bad) >= 20
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc >= 0.8
    flagged = [y for _, p, y in held if p]
    assert np.mean(flagged) >= 0.7 and sum(flagged) >= 0.4 * len(good)
