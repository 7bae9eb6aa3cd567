"""Documents of claims grow in number with the claims, not in size."""

import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from veriloom import catalog
from veriloom.sources import claims, frames, json_documents

catalog.load()
SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["claims_json_array", "claims_json_object"])
def test_documents_of_the_queries_are_small(spark, monkeypatch, name):
    read, paths = claims.read_claims_json, []
    monkeypatch.setattr(claims, "read_claims_json", lambda s, path, **k: paths.append(path) or read(s, path, **k))
    got = catalog.QUERIES[name](spark, SF)
    files = [p.read_text() for p in Path(paths[0]).glob("part-*")]
    held = [len(json.loads(x)["claims"]) for x in files] if name.endswith("object") else [len(json.loads(x)) for f in files for x in f.splitlines()]
    assert max(held) <= 1000 and sum(held) == got.count() == frames.claims(spark, SF).count() and got.select("claim_id").distinct().count() == sum(held)


def test_a_hot_key_and_a_null_key(spark):
    rows = [(str(i), None if i % 10 == 0 else "" if i % 10 == 1 else "hot") for i in range(5000)]
    docs = claims.documents(spark.createDataFrame(rows, "claim_id string, npi string"), F.col("npi"), most=100).collect()
    assert max(len(d.claims) for d in docs) <= 100
    assert Counter((c.claim_id, c.npi) for d in docs for c in d.claims) == Counter(rows)
    assert all(len({c.npi for c in d.claims}) == 1 for d in docs)


def written(folder):
    return sum(p.stat().st_size for p in Path(folder).rglob("part-*"))


def test_reading_documents_stores_no_text(spark, tmp_path, monkeypatch):
    """Only sums of byte ranges are stored; before, all pieces were, twice."""
    stored, keep = [], json_documents.materialise
    monkeypatch.setattr(json_documents, "materialise", lambda df, name: stored.append((name, df.columns, keep(df, name))) or stored[-1][2])
    rows = [(f"c{i}", "x" * 50) for i in range(2500)]
    path = claims.write_documents(spark.createDataFrame(rows, "claim_id string, status string").repartition(2), str(tmp_path / "d"), 1000)
    held = [json.loads(p.read_text())["claims"] for p in Path(path).glob("part-*")]
    assert max(map(len, held)) <= 1000 and len(held) == 4
    assert sorted((c["claim_id"], c["status"]) for d in held for c in d) == sorted(rows)
    assert sorted((r.claim_id, r.status) for r in claims.read_claims_documents(spark, path).collect()) == sorted(rows)
    assert sum(df.count() for _, _, df in stored) <= 20 and not [n for n, columns, df in stored if "value" in columns and df.count()]


def test_json_of_many_claims_is_compressed(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(f"c{i}", "npi" * 9) for i in range(2000)], "claim_id string, provider_npi string")
    held = claims.documents(df, F.col("provider_npi")).select(F.to_json(F.struct("claims"), {"pretty": "true"}).alias("value"))
    plain = claims.write_texts(held, str(tmp_path / "plain"), 2000, 1)
    monkeypatch.setattr(claims, "MOST_PLAIN", 1000)
    packed = claims.write_texts(held, str(tmp_path / "packed"), 2000, 1)
    lines = claims.write_claims(df, str(tmp_path / "lines"), "json")
    assert 4 * written(packed) < written(plain) and 4 * written(lines) < written(plain)
    for path, multiline in ((plain, True), (packed, True), (lines, False)):
        assert sorted(r.claim_id for r in claims.read_claims_json(spark, path, multiline=multiline).collect()) == sorted(f"c{i}" for i in range(2000))


def test_claims_are_shuffled_once(spark):
    """Lines and orders are dealt by order once: no other exchange, where it had been one by line and one by order."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = frames.claims(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2
