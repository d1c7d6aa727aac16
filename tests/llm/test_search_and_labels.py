import random
import re
import zlib

import numpy as np

import corpus_pipeline
from growthframe.llm import pii, toxicity
from growthframe.llm.common import saved, table
from growthframe.llm.decontaminate import drop_leaks, find_leaks, lcs, term_weights
from tests.conftest import SF_MID, SF_SMALL

# Decontamination ----------------------------------------------------------------------------------


def tokens(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for k, y in enumerate(b, 1):
            before, row[k] = row[k], before + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


def test_alignment_equals_dynamic_programming():
    rng = random.Random(2)
    for _ in range(200):
        a, b = rng.choices(range(9), k=rng.randint(1, 90)), rng.choices(range(9), k=rng.randint(0, 120))
        marks = {w: sum(1 << k for k, x in enumerate(a) if x == w) for w in set(a)}
        assert lcs(marks, len(a), b) == slow_lcs(a, b)


def test_leaks_exact_and_reworded(spark, docs_of, odd):
    docs, items = table(spark, SF_MID, "documents").select("doc_id", "text"), table(spark, SF_MID, "benchmark")
    bench = [(r["item_id"], r["text"]) for r in items.collect()]
    rng = random.Random(4)
    vocabulary = tokens(docs.first()["text"])
    planted = {}
    for k, (i, text) in enumerate(bench[:25]):
        words = text.split()
        for at in range(3, len(words) - 3, 6):  # one word in six is another one
            words[at] = rng.choice(vocabulary)
        planted[100_000 + k] = i, " ".join(rng.choices(vocabulary, k=rng.randrange(80)) + words + rng.choices(vocabulary, k=rng.randrange(80)))
    more = docs_of([(d, t) for d, (_, t) in planted.items()] + [r for r in odd if r[0] is None or r[0] > 6]).select("doc_id", "text")
    got = {(r["id"], r["item_id"]) for r in find_leaks(docs.union(more), items).collect()}
    exact = {(r["doc_id"], i) for r in docs.collect() for i, t in bench if t in r["text"]}
    assert exact <= got
    assert len({(d, i) for d, (i, _) in planted.items()} & got) >= 0.9 * len(planted)
    texts = {r["doc_id"]: tokens(r["text"]) for r in docs.union(more).collect() if r["doc_id"] is not None}
    words = {i: tokens(t) for i, t in bench}
    assert all(slow_lcs(words[i], texts[d]) >= 0.6 * len(words[i]) for d, i in got)  # nothing clean is found


def test_verbatim_items_of_any_length_are_found_anywhere(spark, docs_of):
    rng = random.Random(8)
    hosts = [r["text"].split() for r in table(spark, SF_MID, "documents").orderBy("doc_id").collect() if len(r["text"].split()) > 150]
    whole = [r["text"].split() for r in table(spark, SF_MID, "benchmark").orderBy("item_id").collect()]
    items = [(k, " ".join(whole[k % len(whole)][2:][:n])) for k, n in enumerate((1, 2, 3, 5, 7, 60) * 20)]
    rows = []
    for k, text in items:
        host = hosts[k % len(hosts)]
        at = rng.randrange(len(host))
        rows.append((k, " ".join(host[:at] + [text] + host[at:])))
    found = {(r["id"], r["item_id"]) for r in find_leaks(docs_of(rows).select("doc_id", "text"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert [k for k, _ in items if (k, k) not in found] == []


def test_shared_runs_stay_inside_texts(spark, docs_of):
    docs = docs_of([(k, t) for k, t in enumerate(["alpha beta", "gamma delta", "beta gamma", "alpha beta gamma delta", "x alpha beta gamma"])], 1).select("doc_id", "text")
    items = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "gamma")], "item_id long, text string")
    assert sorted((r["id"], r["item_id"], r["n_common"]) for r in find_leaks(docs, items).collect()) == [(1, 2, 1), (2, 2, 1), (3, 1, 4), (3, 2, 1), (4, 2, 1)]


def test_reworded_items_in_one_or_only_very_long_documents(spark, docs_of):
    rng = random.Random(9)
    words = [w for r in table(spark, SF_MID, "documents").orderBy("doc_id").collect() for w in r["text"].split()]
    items = [(r["item_id"], r["text"].split()) for r in table(spark, SF_MID, "benchmark").orderBy("item_id").collect() if len(r["text"].split()) >= 20][:20]
    known = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    for n in (1, 8):  # documents of 20,000 words; every third word of an item is another one, so that no run of three is left
        rows = []
        for d in range(n):
            host = words[20_000 * d:20_000 * (d + 1)]
            for k, (_, item) in enumerate(items):
                new = [rng.choice(words) if at % 3 == 2 else w for at, w in enumerate(item)]
                at = 900 * (k + 1) + rng.randrange(100)
                host = host[:at] + new + host[at:]
            rows.append((d, " ".join(host)))
        docs = docs_of(rows).select("doc_id", "text")
        weights, documents = term_weights(docs.selectExpr("cast(text AS binary) AS text"))
        assert documents == n and (weights > 0).all()
        found = {(r["id"], r["item_id"]) for r in find_leaks(docs, known).collect()}
        assert len(found & {(d, i) for d in range(n) for i, _ in items}) >= 0.8 * n * len(items)


def test_leaky_rows_go_and_empty_tables(spark, docs_of):
    text = "which river flows through the old town of stone bridges and copper roofs before it meets the sea near the lighthouse"
    docs = docs_of([(1, f"prelude words {text} and more"), (2, "a clean text about other things entirely with enough words to make a passage"), (None, text), (None, "clean"), (3, None), (4, "")])
    items = spark.createDataFrame([(7, text), (8, None), (9, "")], "item_id long, text string")
    left = drop_leaks(docs, items)
    assert left.schema == docs.schema
    assert sorted((r["doc_id"], r["text"]) for r in left.collect() if r["doc_id"] in (1, 2, 3, 4))[0][0] == 2 and left.count() == 4
    assert drop_leaks(docs, items.limit(0)).count() == 6
    assert find_leaks(docs_of([]), items).count() == 0


# Personal data --------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")), "card": lambda: 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}
            if good[kind]():
                out[kind].append(m.span())
    return out


def test_base_spans_equal_the_regular_expressions():
    rng = random.Random(1)
    parts = ["a", "b", "@", ".", "1", "25", "256", "+", "(", ")", "-", " ", "4539578763621486", "x.y", "0", "00", "é", "\n"]
    for _ in range(30_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))
        assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    text = "a" * 300_000 + " @ " + "1" * 300_000 + "." * 1000 + "+" + "1" * 300_000
    assert pii.base_spans(text) == {"email": [], "ip": [], "card": [], "phone": []}


def test_labelers_find_what_patterns_drop(docs_of, odd):
    rng = random.Random(6)
    rows = [(1000 + k, f"call my phone +1 (017) 555-77{k % 90 + 10} 9807915762804490 now") for k in range(60)]
    rows += [(2000 + k, f"token = \"{rng.getrandbits(160):040x}\" stays") for k in range(60)] + [(3000 + k, f"page {k} of {k + 7}, version 1.{k}") for k in range(60)]
    docs = docs_of(rows + odd)
    got = {r["id"]: r for r in pii.find_pii(docs).collect() if r["id"] and r["id"] >= 1000}
    assert all(got[1000 + k]["base"] == [] and any(s["kind"] == "phone" for s in got[1000 + k]["added"]) for k in range(60))
    assert all([s["kind"] for s in got[2000 + k]["added"]] == ["secret"] for k in range(60))
    assert all(got[3000 + k]["added"] == [] for k in range(60))
    masked = pii.mask_pii(docs)
    assert masked.schema == docs.schema and masked.where("doc_id = 2000").first()["text"] == 'token = "[secret]" stays'
    assert masked.where("doc_id = 1").first()["text"] is None
    assert pii.find_pii(docs_of([])).count() == 0


def test_long_secrets_are_found_and_masked_whole(docs_of):
    rng = random.Random(14)
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-"
    secrets = {k: "".join(rng.choices(signs, k=n)) for k, n in enumerate((40, 128, 129, 342, 683, 2000) * 10)}
    rows = [(k, f"token: {s} stays") for k, s in secrets.items()]
    rows.append((900, f"token: eyJ{secrets[0]}1.eyJ{secrets[4]}2.{secrets[3]} stays"))  # three parts, as signed tokens have
    got = {r["id"]: r for r in pii.find_pii(docs_of(rows)).collect()}
    assert all([(s["kind"], s["first"], s["past"]) for s in got[k]["added"]] == [("secret", 7, 7 + len(s_))] for k, s_ in secrets.items())
    masked = {r["doc_id"]: r["text"] for r in pii.mask_pii(docs_of(rows)).collect()}
    assert {masked[k] for k in secrets} == {"token: [secret] stays"} and masked[900] == "token: [secret].[secret].[secret] stays"


def test_reliabilities_favour_the_good_labelers():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.3
    votes = np.stack([np.where(rng.random(4000) < q, truth, ~truth) for q in (0.95, 0.9, 0.85, 0.55, 0.6)], 1).astype(int)
    positive, table_, share = pii.reliabilities(votes, np.ones(4000))
    assert ((positive > 0.5) == truth).mean() > 0.95 and abs(share - 0.3) < 0.05
    assert table_[0, 1, 1] > 0.9 > table_[3, 1, 1]


# Toxicity -------------------------------------------------------------------------------------------


def test_gradients_equal_differences(monkeypatch):
    seen = {}
    words = ["good", "day", "bad", "thing", "you", "awful"]
    texts = [" ".join(random.Random(k).choices(words, k=40)).encode() for k in range(6)]
    labels = [int(b"awful" in t[:60]) for t in texts]
    p = toxicity.train(texts, labels, rounds=1, rate=1e-3)
    scorer = toxicity.Scorer(p)
    gates = np.random.default_rng(1).standard_normal((5, 3, 3 * toxicity.STATE)).astype(np.float32)
    live = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 1, 0], [1, 0, 0]], bool)
    for side, back in (("f", False), ("b", True)):
        out, kept = toxicity._direction(p, side, gates, live, back)
        probe = np.random.default_rng(2).standard_normal(out.shape).astype(np.float32)
        grad = {}
        found = toxicity._direction_gradient(p, side, probe, kept, live, back, grad)
        for at in ((0, 0, 1), (1, 1, 9), (2, 0, 17), (4, 0, 3)):
            step = np.zeros_like(gates)
            step[at] = 1e-2
            up, down = (toxicity._direction(p, side, gates + s, live, back)[0] for s in (step, -step))
            assert abs(((up - down) * probe).sum() / 2e-2 - found[at]) < 2e-2
    seen["scores"] = scorer.score([b"", b"   ", b"word"])
    assert seen["scores"][0] == seen["scores"][1] and 0 <= seen["scores"][2] <= 1


def test_held_out_accuracy_and_odd_rows(spark, docs_of, odd):
    rng = random.Random(3)
    calm, harsh = [f"calm{k}" for k in range(300)], ["idiot", "moron", "scum", "worthless"]
    rows, labels = [], []
    for k in range(900):
        words = rng.choices(calm, k=rng.randint(20, 160))
        if k % 3 == 0:
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(harsh)
        rows.append((100 + k, " ".join(words)))
        labels.append((100 + k, int(k % 3 == 0)))
    known = spark.createDataFrame([*labels, (None, 1), (5000, None)], "doc_id long, toxic int")
    got = {r["id"]: r for r in toxicity.score(docs_of(rows), known).collect()}
    held = [(got[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert np.mean([r["predicted"] == y for r, y in held]) >= 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    out = toxicity.score(docs_of(odd), known).collect()
    assert len(out) == len(odd) and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score(docs_of([]), known).count() == 0


def test_texts_without_spaces_are_scored_to_their_end():
    rng = random.Random(12)
    calm, harsh = "天地人山川水木花鳥春夏秋冬朝夕日月星雲雨", "醜惡死罵"
    for join in ("", "_", "\u00a0"):
        texts, labels = [], []
        for k in range(360):
            text = rng.choices(calm, k=rng.randint(60, 400))
            if k % 3 == 0:  # the harsh part is the end, far from the first bytes
                text[-16:] = rng.choices(harsh, k=16)
            texts.append(join.join(text).encode())
            labels.append(int(k % 3 == 0))
        found = toxicity.Scorer(toxicity.train(texts[:270], labels[:270])).score(texts[270:])
        assert np.mean((found >= 0.3) == labels[270:]) >= 0.95


def test_long_words_are_cut_without_losing_a_byte():
    short = [b"word", b"x" * toxicity.LONG]
    assert toxicity._pieces(short) == short
    for n in (49, 50, 94, 95, 500, 300_001):
        word = bytes(random.Random(n).choices(range(33, 127), k=n))
        pieces = toxicity._pieces([b"a", word, b"b"])[1:-1]
        assert pieces[0] + b"".join(p[2:] for p in pieces[1:]) == word and 2 < min(map(len, pieces)) and max(map(len, pieces)) <= toxicity.LONG


def test_every_word_lies_in_a_window():
    for n in (1, 31, 32, 33, 47, 48, 49, 500):
        starts = toxicity._windows(n)
        assert {k for s in starts for k in range(s, min(s + toxicity.WINDOW, n))} == set(range(n))


# Pipeline -------------------------------------------------------------------------------------------


def test_each_stage_works_on_what_the_one_before_kept(spark):
    docs = table(spark, SF_SMALL, "documents")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = saved(stage(spark, docs, SF_SMALL), "test")
        assert out.schema == first.schema, name
        assert 0 < out.count() <= docs.count()
        assert out.select("doc_id").subtract(docs.select("doc_id")).isEmpty()
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert last.count() == docs.count() and last.where("NOT round_trip").isEmpty()
    whole = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in whole.collect()) == sorted((r["doc_id"], r["n_tokens"]) for r in last.collect())


def test_stages_take_an_empty_table(spark):
    docs = table(spark, SF_SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = saved(stage(spark, docs, SF_SMALL), "test")
        assert docs.count() == 0
