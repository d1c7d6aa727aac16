import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from growthframe.llm.piece_codec import Codec, decode, encode
from growthframe.llm.pieces import SPACE, Vocabulary, model_path
from growthframe.llm.sharding import assign_shards
from growthframe.llm.token_counts import PrefixCounter, token_counts, truncate
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    parts = ["a", "b", "e", "th", "in", " ", " ", "  ", SPACE, "\n", "é", "ß", "1", ".", ",", "!!", "The", "%", "ng", "日", "\t", "👍", "ion", "<s>", "\x00"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    return ["", " ", "   ", "a  b ", SPACE, "</s>", "<0x41>", "a" * 700, "x" + " " * 45 + "y", " " * 33 + "é", " " * 15, *made]


def test_counts_at_every_prefix(library, texts):
    counter = PrefixCounter()
    for t in texts[:600]:
        assert counter.at_prefixes(t) == [len(library.encode(t[:k])) for k in range(len(t) + 1)]
    assert [counter.count(t) for t in texts] == [len(x) for x in library.encode(texts)]


def test_budget_from_the_counts(library, texts):
    counter = PrefixCounter()
    for t in texts[:400]:
        for budget in (0, 1, 5):
            best = max(k for k in range(len(t) + 1) if len(library.encode(t[:k])) <= budget)
            assert counter.fits(t, budget) == best


def test_ids_and_decoding(library, texts):
    codec = Codec()
    ids = codec.encode(texts)
    assert [x.tolist() for x in ids] == library.encode(texts)
    assert [codec.decode(x) for x in ids] == [library.decode(x.tolist()).encode() for x in ids]


def test_pairs_by_their_borders_equal_merging():
    v, rng = Vocabulary(), random.Random(1)
    short = [i for i, p in v.text.items() if len(p) <= 4 and p.isascii()]
    for _ in range(20_000):
        a, b = rng.choice(short), rng.choice(short)
        assert v.stay_apart(a, b) == (v._merge([v.ids[c] for c in v.text[a] + v.text[b]]) == [a, b])


def test_corpus_counts_and_ids(spark, library, docs_of, odd):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").where("doc_id < 400").select("doc_id", "text").union(docs_of(odd).select("doc_id", "text"))
    expect = sorted(((r["doc_id"], len((r["text"] or "").encode()), library.encode(r["text"] or "")) for r in docs.collect()), key=repr)
    counted = token_counts(docs).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in counted), key=repr) == sorted(((i, n, len(x), len(x) > 4096) for i, n, x in expect), key=repr)
    done = encode(docs)
    assert sorted(((r["doc_id"], r["ids"]) for r in done.collect()), key=repr) == sorted(((i, x) for i, _, x in expect), key=repr)
    assert done.where("NOT round_trip").count() == 1  # the row with a literal space mark
    back = decode(done.where("round_trip")).select("text").collect()
    assert sorted(r["text"] for r in back) == sorted(r["text"] or "" for r in docs.collect() if SPACE not in (r["text"] or ""))


def test_odd_columns_and_empty_tables(docs_of, odd):
    docs = docs_of(odd)
    cut = truncate(docs, 3)
    assert cut.schema == docs.schema and {r["text"] for r in cut.where("doc_id = 4").collect()} == {"one"}
    assert cut.where("doc_id = 1").first()["text"] is None
    assert set(encode(docs).columns) == set(docs.columns) - {"text"} | {"n_tokens", "round_trip"}
    empty = docs_of([])
    assert token_counts(empty).count() == truncate(empty, 3).count() == encode(empty).count() == decode(encode(empty)).count() == 0


def test_forgetting_changes_nothing(library, texts, monkeypatch):
    from growthframe.llm import piece_codec, token_counts as counts

    monkeypatch.setattr(piece_codec, "REMEMBERED", 50)
    monkeypatch.setattr(piece_codec, "INDEXED", 100)
    monkeypatch.setattr(counts, "REMEMBERED", 50)
    codec, counter = Codec(), PrefixCounter()
    for k in range(0, 300, 20):
        part = texts[k:k + 20]
        assert [x.tolist() for x in codec.encode(part)] == library.encode(part)
        assert [counter.count(t) for t in part] == [len(x) for x in library.encode(part)]


def test_shards_fit_and_only_large_buckets_split(docs_of, odd):
    rng = random.Random(8)
    rows = [(k, "z" * rng.randint(0, 900)) for k in range(600)] + [(77, "hot" * 100)] * 300 + [r for r in odd if r[0] not in (7, 8)]
    limit = 4000
    out = assign_shards(docs_of(rows, 7), limit).collect()
    assert len(out) == len(rows)
    held: dict = {}
    for r in out:
        held.setdefault(r["shard"], []).append(r["n_bytes"])
        assert r["n_bytes"] == len((r["text"] or "").encode())
    sizes = {s: sum(x) for s, x in held.items()}
    assert all(n <= limit or len(held[s]) == 1 for s, n in sizes.items())
    assert {r["shard"]: r["shard_bytes"] for r in out} == sizes
    names = [s for s in sizes if "." not in s]
    assert not any(a != b and b.startswith(a) for a in names for b in names)  # prefix-free
    for s in names:  # a bucket's parent was too large
        assert not s or sum(n for t, n in sizes.items() if t.startswith(s[:-1])) > limit
    parts = {s for s in sizes if "." in s}
    assert len({r["shard"] for r in out if r["doc_id"] == 77 and r["n_bytes"] == 300} & parts) == -(-300 // (limit // 300))
    assert [(r["doc_id"], r["n_bytes"]) for r in out if r["shard"] in parts and r["doc_id"] != 77] == [(10, 5000)]  # over the limit by itself


def test_shards_of_nothing(docs_of):
    assert assign_shards(docs_of([]), 100).count() == 0
    (row,) = assign_shards(docs_of([(1, "abc")]), 100).collect()
    assert (row["shard"], row["depth"], row["shard_bytes"]) == ("", 0, 3)
    assert np.isclose(row["n_bytes"], 3)


@pytest.mark.parametrize(("parts", "aqe"), [(1, "true"), (7, "true"), (11, "false")])
def test_no_row_is_lost_whatever_the_partitions(spark, docs_of, parts, aqe):
    from growthframe.llm.queries import op6_sql

    rng = random.Random(3)
    rows = [(k, "z" * rng.randint(0, 900)) for k in range(300)] + [(77, "hot" * 100)] * 90 + [(78, "long" * 1500), (79, "x" * 4001), (79, "x" * 4001), (None, "y" * 5000), (None, None)]
    duck = duckdb.connect()
    duck.register("documents", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows])}))
    expect = duck.execute(op6_sql(4000)).fetchall()
    assert len(expect) == len(rows)
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        got = assign_shards(docs_of(rows, parts), 4000).select("doc_id", "n_bytes", "shard", "depth", "shard_bytes").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(map(tuple, got), key=repr) == sorted(expect, key=repr)
