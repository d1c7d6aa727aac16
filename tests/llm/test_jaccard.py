"""The set join against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from growthframe.llm import jaccard_join as J
from growthframe.llm.queries import QUERIES
from tests.conftest import SF_MID, SF_SMALL


def shingles(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1)))


def brute(rows, percent=90, width=3):
    sets = [shingles(t, width) for _, t in rows]
    by_token = {}
    for k, s in enumerate(sets):
        for x in s:
            by_token.setdefault(x, []).append(k)
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, s in enumerate(sets):
        for o in {o for x in s for o in by_token[x] if o < k}:
            common = len(s & sets[o])
            if 100 * common >= percent * (len(s) + len(sets[o]) - common):
                root[find(k)] = find(o)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def got(df):
    return sorted(map(tuple, df.select("id", "n_shingles", "component").collect()), key=repr)


def planted(seed, n=150):
    rng = random.Random(seed)
    line = lambda k: [f"w{rng.randrange(400)}" for _ in range(k)]
    common = line(40)
    base = [line(rng.randint(3, 220)) for _ in range(25)]
    rows = []
    for k in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(1 + len(words) // 12)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9)}"
        words = words + common[:rng.choice((0, 0, 5, 40))]
        rows.append((k, " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows + [(1000 + k, " ".join([*common, f"y{k}"])) for k in range(20)]


@pytest.mark.parametrize("percent", [90, 60])
def test_components_equal_brute_force(docs_of, odd, percent):
    rows = planted(percent) + [r[:2] for r in odd]
    assert got(J.jaccard_components(docs_of(rows), percent=percent)) == brute(rows, percent)


def test_blocks_and_chunks_change_nothing(docs_of, monkeypatch):
    rows = planted(7)
    for name, value in (("BLOCK", 6), ("HOME", 4), ("LEADERS", 2), ("CELLS", 2), ("CHUNK", 500), ("JOINED", 3000), ("FREQUENT", 50), ("LISTED", 3), ("FIRST", 1), ("LAST", 1)):
        monkeypatch.setattr(J, name, value)
    assert got(J.jaccard_components(docs_of(rows))) == brute(rows)


@pytest.mark.parametrize("folder", [SF_SMALL, SF_MID])
def test_registered_query_on_the_given_table(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    out = QUERIES["op12_jaccard_join"](spark, folder)
    assert out.columns[:3] == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, out.select("doc_id", "n_shingles", "component_id").collect()), key=repr) == brute(rows)


def test_nothing(docs_of):
    assert J.jaccard_components(docs_of([])).count() == 0
    assert got(J.jaccard_components(docs_of([(3, None), (2, " "), (None, "")]))) == brute([(3, None), (2, " "), (None, "")])


def test_order_is_total_and_fragments_are_cuts_of_it():
    rng = np.random.default_rng(5)
    ids = np.sort(rng.integers(0, 1 << 64, 500, np.uint64))
    order = J.Order(ids[::7].copy(), rng.integers(2, 9, len(ids[::7])))
    out, _ = order.sort(ids, np.zeros(500, np.int64))
    assert sorted(out.tolist()) == ids.tolist()
    assert (np.diff(order.fragment(out)) >= 0).all() and set(order.fragment(out)) == set(range(J.FRAGMENTS))


def test_unrelated_texts_of_few_words_are_not_spread(docs_of, monkeypatch):
    """Texts that share single shingles with many others, but no more, are written once each, not once for each shingle."""
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(60, 90)))) for k in range(200)]
    written, saved = [], J.saved
    monkeypatch.setattr(J, "saved", lambda df, name: (written.append(saved(df, name)), written[-1])[1])
    assert got(J.jaccard_components(docs_of(rows))) == brute(rows)
    assert sum(w.count() for w in written) < 3 * len(rows)


@pytest.mark.parametrize("percent", [90, 60])
def test_linked_sets_share_a_mark_and_sketches_differ_no_more_than_sets(percent):
    rng = np.random.default_rng(percent)
    for n in [*range(1, 60), 90, 333, 2500, 5000]:
        base = np.unique(rng.integers(0, 1 << 64, 2 * n + 2, np.uint64))
        a, (out, new) = base[:n], np.sort(rng.integers(0, n // 2 + 1, 2))
        b = np.sort(np.concatenate([a[:n - out], base[n:n + new - out]]))  # fewer, equally many or more
        if not len(b):
            continue
        sets = [np.sort(a), b]
        ids, doc, size = np.concatenate(sets), np.repeat([0, 1], [len(a), len(b)]), np.array([len(a), len(b)])
        marks, many = J._marks(ids, doc, size, percent)
        common = len(np.intersect1d(*sets))
        if common < len(a) + len(b) - common and 100 * common >= percent * (len(a) + len(b) - common):
            assert np.intersect1d(marks[:many[0]], marks[many[0]:]).size
        data, length = J._sketches(ids, doc, size)
        raw = data.tobytes()
        assert 0 <= J._differing([raw[:length[0]], raw[length[0]:]])[0, 1] <= len(a) + len(b) - 2 * common


def test_shared_marks_are_found_across_batches():
    rows = [(1, 5), (2, 1), (2, 1), (2, 3), (3, 4), (3, 4), (4, 1), (4, 2), (4, 6), (5, 9), (6, 1), (6, 2)]
    for size in range(1, 13):
        batches = [J.pa.record_batch([J.pa.array([r[k] for r in rows[at:at + size]], J.pa.int64()) for k in (0, 1)], names=["token", "sig"]) for at in range(0, len(rows), size)]
        found = [tuple(r.values()) for b in J._shared(iter(batches)) for r in b.to_pylist()]
        assert found == [(2, 1), (2, 3), (4, 1), (4, 2), (4, 6), (6, 1), (6, 2)]
    assert list(J._shared(iter([]))) == []


def test_sieve_lets_all_wanted_texts_through(spark, monkeypatch):
    monkeypatch.setattr(J, "SIEVE", 128)
    keys = [-1, 0, 63, 64, -(1 << 63), 12345678901]
    table = J._sieve(spark.createDataFrame([(k,) for k in keys], "key long"))
    assert len(table) == 2
    texts = J.pa.record_batch([J.pa.array([*keys, 7]), J.pa.array([str(k).encode() for k in [*keys, 7]])], names=["key", "text"])
    out = next(J._packed(type("Sent", (), {"value": table}))(iter([texts])))
    assert out.column(0).to_pylist() == keys
    assert not J._sieve(spark.createDataFrame([], "key long")).any()
