"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

from growthframe.llm import spelling as S
from growthframe.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def brute(rows, thin=97):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % thin == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [o for k in (-1, 0, 1) for o in by_length.get(len(w) + k, ()) if one_edit(w, o)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_words_equal_brute_force(docs_of, odd):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdeéÀß") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    def typo(w):
        k, c = rng.randrange(len(w)), rng.choice("abcdeé×")
        return rng.choice((w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:], w.upper(), w + w[-1] * rng.randrange(3)))
    rows = [(k, " ".join(rng.choice(base) if rng.random() < 0.6 else typo(rng.choice(base)) for _ in range(150)) + ", 12x-Straße's ÉCOLE!") for k in range(60)]
    rows += [(k, "aaaaa " * 3 + "aaaaaa " * 9 + "a" * 300 + " aaab " * 9) for k in range(3)] + [r[:2] for r in odd] + rows[:2]
    assert got(S.spelling_variants(docs_of(rows))) == brute(rows)
    assert got(S.spelling_variants(docs_of(rows), thin=3)) == brute(rows, 3)


def test_hot_signatures_are_dealt_into_blocks(docs_of, monkeypatch):
    for name, value in (("BLOCK", 4), ("HELD", 7), ("LONG", 100)):
        monkeypatch.setattr(S, name, value)
    rng = random.Random(8)
    rows = [(k, " ".join("storm" + rng.choice("abcdefghij") + rng.choice("abcdefghij") for _ in range(60))) for k in range(30)]
    assert got(S.spelling_variants(docs_of(rows))) == brute(rows)


def test_every_near_pair_shares_a_signature():
    rng = random.Random(5)
    for _ in range(4000):
        w = "".join(rng.choice("abcßé") for _ in range(rng.randint(5, 12)))
        k = rng.randrange(len(w))
        for v in (w[:k] + w[k + 1:], w[:k] + rng.choice("abxyÿ") + w[k:], w[:k] + rng.choice("abxyÿ") + w[k + 1:]):
            assert set(S.signatures(w)) & set(S.signatures(v))
    assert set(S.signatures("q" * 70000)) & set(S.signatures("q" * 70001))


def test_registered_query_on_the_given_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert got(QUERIES["op11_spelling_variants"](spark, SF_SMALL)) == brute(rows)


def test_nothing(docs_of):
    assert S.spelling_variants(docs_of([])).count() == S.spelling_variants(docs_of([(1, None), (2, "a bb 123")])).count() == 0
