import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from growthframe.llm.line_dedup import dedup_lines
from growthframe.llm.substring_dedup import remove_repeats
from growthframe.llm.suffixes import buckets, joined_bytes, samples


def brute_bytes(rows, length=400):
    texts = [(t or "").encode() for _, t, *_ in rows]
    count: dict = {}
    for t in texts:
        for s in range(len(t) - length + 1):
            h = t[s:s + length]
            count[h] = count.get(h, 0) + 1
    out = []
    for (i, *_), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - length + 1):
            if count[t[s:s + length]] > 1:
                gone[s:s + length] = True
        runs = int((np.diff(np.append(False, gone).astype(int)) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_removed_bytes_equal_brute_force(docs_of):
    rng = random.Random(2)
    line = lambda n: " ".join(rng.choice(("alpha", "beta", "gämma", "delta", "eps")) + str(rng.randrange(99)) for _ in range(n))
    shared = [line(k) for k in (60, 61, 70, 90, 200)]
    rows = [(k, line(rng.randint(1, 90)) + rng.choice(shared)[rng.randrange(9):] + line(rng.randint(0, 40))) for k in range(40)]
    rows += [(k + 100, line(50) + rows[k][1][3:380 + k] + "!" + line(20)) for k in range(20)]
    rows += [(300, "ab" * 900), (301, "c" * 399), (302, "c" * 400), (303, "c" * 401), (304, line(30) * 4), (305, shared[4] + shared[4]), (1, None), (None, ""), (None, shared[3]), (7, rows[0][1]), (7, rows[0][1])]
    got = remove_repeats(docs_of(rows)).select("id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_bytes(rows)


def test_texts_longer_than_a_part(docs_of, monkeypatch):
    from growthframe.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "CHUNK", 700)
    rng = random.Random(4)
    words = [f"{rng.randrange(10**6)}" for _ in range(1500)]
    rows = [(1, " ".join(words)), (2, " ".join(words[300:700] + ["x"] + words[701:900])), (3, " ".join(words[100:164]))]
    got = remove_repeats(docs_of(rows)).select("id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_bytes(rows)


def test_odd_rows_and_empty_table(docs_of, odd):
    got = {(r["id"], r["n_bytes"]): r["n_removed"] for r in remove_repeats(docs_of(odd)).collect()}
    assert got[7, len(odd[10][1])] == got[8, len(odd[10][1])] == len(odd[10][1]) and got[10, 5000] == 5000 and got[None, 0] == 0
    assert remove_repeats(docs_of([])).count() == 0


def test_every_string_chooses_a_place_by_its_bytes():
    rng = random.Random(1)
    part = bytes(rng.choice(b"abc ") for _ in range(900))
    data, bounds = joined_bytes([b"xyz" + part, part + b"q" * 500])
    grams, = buckets(data, 64)
    first, last, place = samples(grams, bounds, 400)
    choice = {s: p - s for a, b, p in zip(first, last, place) for s in range(a, b + 1)}
    assert len(choice) == 903 - 399 + 1400 - 399
    assert all(choice[3 + k] == choice[903 + k] for k in range(501))


def brute_lines(rows, min_lines=4, min_words=50):
    seen, out = {}, {}
    order = sorted({(r[0] is None, r[0], r[1]) for r in rows if r[1] is not None}, key=lambda r: (r[0], r[1] or 0))
    docs = {}
    for none, i, text in order:
        lines = text.split("\n")
        docs[i, text] = lines, [k for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = []
    for (i, text), (lines, solid) in docs.items():
        for a in range(len(solid)):
            for b in range(a, min(a + min_lines, len(solid))):
                run = tuple(lines[k] for k in solid[a:b + 1])
                if len(run) >= min_lines or sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in run) >= min_words:
                    windows.append((run, (i, text), solid[a], solid[b]))
    gone = {d: set() for d in docs}
    for run, d, a, b in windows:
        if run in seen:
            gone[d].update(range(a, b + 1))
        seen[run] = True
    for d, (lines, _) in docs.items():
        runs = sum(1 for k in gone[d] if k - 1 not in gone[d])
        out[d] = "\n".join(x for k, x in enumerate(lines) if k not in gone[d]), len(lines), len(gone[d]), runs
    return sorted(((r[0], *out.get((r[0], r[1]), (None, 0, 0, 0))) for r in rows), key=repr)


def test_lines_equal_brute_force(docs_of, odd):
    rng = random.Random(9)
    pool = [f"line {k} " + "word " * rng.randrange(30) for k in range(40)] + ["", " ", "word " * 60]
    rows = [(k, "\n".join(rng.choices(pool, k=rng.randint(1, 25)))) for k in range(80)]
    block = rows[3][1]
    rows += [(200 + k, f"own {k}\n{block}\nown end {k}") for k in range(15)] + [(500, "same\n" * 30), (None, block)]
    rows += [r for r in odd if r[0] is not None]
    docs = docs_of(rows)
    done = dedup_lines(docs)
    got = done.select("doc_id", "text", "n_lines", "n_removed", "n_runs").collect()
    assert sorted(map(tuple, got), key=repr) == brute_lines(rows)
    assert set(done.columns) == set(docs.columns) | {"n_lines", "n_removed", "n_runs"}


def test_no_lines_and_no_rows(docs_of):
    assert dedup_lines(docs_of([])).count() == 0
    (row,) = dedup_lines(docs_of([(1, None)])).collect()
    assert (row["text"], row["n_lines"], row["n_removed"]) == (None, 0, 0)


def test_short_texts_and_short_remainders(docs_of):
    rng = random.Random(5)
    for n in range(0, 401):
        data, bounds = joined_bytes([bytes(rng.randrange(256) for _ in range(n))])
        grams, = buckets(data, 64)
        first, last, place = samples(grams, bounds, 400)
        assert len(first) == (n >= 400)
    for rows in ([(1, "x" * 100)], [(1, "abc")], [(1, "a" * 2), (2, "b" * 11)], [(k, "y" * (9 + k % 7)) for k in range(5)] + [(9, "y" * 401)] * 2):
        got = remove_repeats(docs_of(rows)).select("id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
        assert sorted(map(tuple, got), key=repr) == brute_bytes(rows)


def test_short_last_part_of_a_batch(docs_of, monkeypatch):
    from growthframe.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "CHUNK", 500)
    rng = random.Random(6)
    rows = [(k, "".join(rng.choice("abcde ") for _ in range(rng.choice((1, 3, 7, 30, 33, 63, 127, 500, 505, 700))))) for k in range(60)]
    rows += [(100 + k, rows[k][1] + rows[k + 1][1]) for k in range(30)]
    got = remove_repeats(docs_of(rows)).select("id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_bytes(rows)


def test_passages_of_over_50_words_go_from_400_bytes_on(docs_of):
    rng = random.Random(8)
    prose = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(n))
    passages = [prose(51 + k) for k in range(40)] + [prose(90)[:n] for n in (398, 399, 400, 401)]
    assert all(len(p.split()) > 50 for p in passages) and sum(len(p) < 400 for p in passages) > 9
    # other separators in the other text, so that the passage alone is repeated
    rows = [(2 * k + j, prose(90) + "\n\r"[j] + p + "\t\v"[j] + prose(60)) for k, p in enumerate(passages) for j in range(2)]
    rows += [(1000 + k, prose(rng.randint(1, 250))) for k in range(60)]
    got = remove_repeats(docs_of(rows)).select("id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    removed = {r["id"]: r["n_removed"] for r in got}
    assert [removed[k] for k in range(2 * len(passages))] == [len(p) if len(p) >= 400 else 0 for p in passages for _ in range(2)]
    assert all(removed[1000 + k] == 0 for k in range(60))
    assert sorted(map(tuple, got), key=repr) == brute_bytes(rows)
