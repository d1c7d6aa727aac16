"""The registered queries against their SQL, and against brute force where SQL can't say it."""

import hashlib
import re

import pytest

from growthframe.llm import queries as Q
from tests.conftest import SF_SMALL
from tools.check_oracle import rows_key


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_equals_its_sql(spark, duck, name):
    out = Q.QUERIES[name](spark, SF_SMALL)
    cur = duck.execute(Q.ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(out.columns) == sorted(columns)
    assert rows_key([tuple(r) for r in out.collect()], out.columns, strict=True) == rows_key(cur.fetchall(), columns, strict=True)


COLUMNS = {
    "op1_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"], "op2_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op3_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op4_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"], "op8_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op9_toxicity": ["doc_id", "held_out", "score", "predicted"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_for_each_document(spark, name):
    out = Q.QUERIES[name](spark, SF_SMALL)
    assert set(COLUMNS[name]) <= set(out.columns)
    ids = [r["doc_id"] for r in out.collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())


def test_personal_data_digest(spark):
    from tests.llm.test_search_and_labels import plain_spans

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in Q.QUERIES["op8_pii"](spark, SF_SMALL).collect():
        spans = plain_spans(texts[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for k in ("email", "ip", "card", "phone") for a, b in spans[k])
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in spans] == [len(x) for x in spans.values()]
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))


def test_fingerprints_are_hex(spark):
    out = Q.QUERIES["op1_simhash_near_dedup"](spark, SF_SMALL).collect()
    assert all(re.fullmatch("[0-9a-f]{16}", r["fingerprint"]) and r["component_id"] <= r["doc_id"] for r in out)
