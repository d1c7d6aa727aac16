import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest

from growthframe.llm import quality as Q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if windows[tuple(words[k:k + 8])] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered)


def corpus():
    rng = random.Random(3)
    clean = [(k, " ".join(rng.choice(("the", "river", "runs", "down", "to", "a", "sea", "of", "stones", "and", "light")) for _ in range(rng.randint(25, 300))), rng.choice(("en", "fr", None))) for k in range(120)]
    noise = [(500 + k, " ".join("".join(rng.choice("qzxjkvwp09#%") for _ in range(7)) for _ in range(200)), "en") for k in range(5)]
    loop = [(600, "stones and light " * 40, "en"), (601, "a\n\na\nb\n" * 3, "en")]
    return clean, noise, loop


def test_statistics_and_verdicts(docs_of, odd):
    clean, noise, loop = corpus()
    rows = clean + noise + loop + odd
    got = Q.quality(docs_of(rows)).collect()
    expect = Counter((r[0], *brute(r[1])) for r in rows)
    assert Counter((r["doc_id"], *(r[c] for c in Q.STATISTICS)) for r in got) == expect
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert not kept & {r[0] for r in noise + loop}
    long_enough = {r[0] for r in clean if brute(r[1])[4] * 100 <= 30 * brute(r[1])[0]} - {r[0] for r in odd}
    assert len(long_enough - kept) <= 0.02 * len(long_enough)


def test_filter_agrees_with_the_verdicts(docs_of):
    clean, noise, loop = corpus()
    docs = docs_of(clean + noise + loop)
    left = Q.keep_good(docs)
    assert left.schema == docs.schema
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in Q.quality(docs).collect() if r["kept"]}


def test_empty_table(docs_of):
    assert Q.quality(docs_of([])).count() == 0
    assert Q.keep_good(docs_of([])).count() == 0


def plain(text):
    out = "".join("#" if unicodedata.category(c)[0] == "S" or c in "#*%&" else "0" if unicodedata.category(c)[0] == "N" else " " if c.isspace() and c != "\n" else c
                  if ord(c) else chr(Q.NUL) for c in (text or ""))
    return "".join(c if ord(o) < 0x10000 else o for c, o in zip(out, text or ""))


def slow_model(texts):
    """Interpolated modified Kneser-Ney straight from its definition: log probability of every n-gram of the highest order."""
    pad = chr(Q.PAD)
    counts = {Q.ORDER: Counter()}
    for t in texts:
        line = pad * (Q.ORDER - 1) + plain(t)
        counts[Q.ORDER].update(line[k:k + Q.ORDER] for k in range(len(t or "")))
    for k in range(Q.ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    p = {"": 1 / (len(counts[1]) + 1)}
    for k in range(1, Q.ORDER + 1):
        c = counts[k]
        n = [max(1, sum(v == j for v in c.values())) for j in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        d = {1: 1.0, 2: min(max(2 - 3 * y * n[2] / n[1], 0), 1.9), 3: min(max(3 - 4 * y * n[3] / n[2], 0), 2.85)}
        total, off = Counter(), Counter()
        for g, v in c.items():
            total[g[:-1]] += v
            off[g[:-1]] += d[min(v, 3)]
        below, p = p, {}
        for g, v in c.items():
            p[g] = (v - d[min(v, 3)] + off[g[:-1]] * below[g[1:] if k > 1 else ""]) / total[g[:-1]]
    return p


def slow_nll(p, text):
    line = chr(Q.PAD) * (Q.ORDER - 1) + plain(text)
    return -sum(np.log(p[line[k:k + Q.ORDER]]) for k in range(len(text))) / len(text)


@pytest.mark.parametrize("small", [False, True])
def test_model_and_scores_equal_their_definition(docs_of, odd, monkeypatch, small):
    if small:  # nearly all n-grams are looked up by the join, texts are cut into parts
        for name, value in (("FREQUENT", 3), ("_CHARS", 500), ("_HELD", 50)):
            monkeypatch.setattr(Q, name, value)
    clean, noise, _ = corpus()
    rows = clean[:30] + noise[:2] + [r for r in odd if r[0] not in (7, 8)] + [(900, "日本語のテキスト " * 9 + "\0\0x\0"), (901, "ÀÉÎ 👍🏽 мир")]
    cut = [t for _, t, *_ in rows if t]
    if small:  # parts of a long text begin anew
        cut = [t[k:k + 500] for t in cut for k in range(0, len(t), 500)]
    p = slow_model(cut)
    docs = docs_of(rows)
    model = Q.train(docs)
    assert sorted(round(r["logp"], 9) for r in model.collect()) == sorted(round(float(np.log(v)), 9) for v in p.values())
    for r in Q.scored(docs.select("doc_id", "text"), model).collect():
        text = r["row"]["text"]
        if not text:
            assert r["quality"]["nll"] is None
        elif not small:
            assert r["quality"]["nll"] == pytest.approx(slow_nll(p, text), rel=1e-9)
        else:
            parts = [text[k:k + 500] for k in range(0, len(text), 500)]
            assert r["quality"]["nll"] == pytest.approx(sum(slow_nll(p, x) * len(x) for x in parts) / len(text), rel=1e-9)


def test_the_model_grows_and_leaves_no_character_out(docs_of):
    rows = [(k, " ".join(chr(0x4E00 + (k * 37 + j * j) % 5000) for j in range(40))) for k in range(200)]
    few, many = (Q.train(docs_of(r)).count() for r in (rows[:20], rows))
    assert many > 5 * few
    assert Q.count_grams(docs_of(rows)).agg({"n": "sum"}).first()[0] == sum(len(t) for _, t in rows)
