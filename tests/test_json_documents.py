"""Documents read in byte ranges against json.loads on the whole."""

import json
import random

import pytest

from veriloom.sources import json_documents


def text_of(rng):
    return "".join(rng.choice(['{', '}', '"', '\\', '[', ']', ',', ':', ' ', '\n', 'a', 'é', '{"claims": [{', '\\"', '}}']) for _ in range(rng.randint(0, 25)))


def record(rng, i):
    return {"claim_id": i, "note": text_of(rng), "tags": [text_of(rng) for _ in range(rng.randint(0, 3))],
            **({"inner": {"a": text_of(rng), "b": {"c": [{"d": 1}, {}]}}} if rng.random() < 0.4 else {})}


def documents():
    rng = random.Random(5)
    rows = [record(rng, i) for i in range(40)]
    return {
        "array": (json.dumps(rows), rows), "array_lines": (json.dumps(rows, indent=2), rows), "raw": ("\n" + json.dumps(rows[:15], ensure_ascii=False) + "\n", rows[:15]),
        "object": (json.dumps({"claims": rows}), rows), "object_lines": (json.dumps({"claims": rows}, indent=1), rows),
        "wrapped": (json.dumps({"meta": {"a{": ["}"]}, "note": text_of(rng), "errors": [{"e": 1}], "claims": rows[:25], "more": [{"m": 2}], "end": "}"}), rows[:25]),
        "late": (json.dumps({"note": 'x } "claims": [ y {', "claims": rows[:9], "end": "]}"}), rows[:9]),
        "single": (json.dumps(rows[0]), rows[:1]), "no_rows": ("[]", []), "no_claims": ('{"claims": []}', []), "empty": ("", []),
        "cut": (json.dumps(rows[:20])[:-30], rows[:19])}


@pytest.mark.parametrize("size", [600, 1 << 20])
def test_every_record_of_every_document(spark, tmp_path, size):
    held = documents()
    for name, (text, _) in held.items():
        (tmp_path / f"{name}.json").write_text(text)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        got = json_documents.records(spark, str(tmp_path)).collect()
        if size == 600:
            assert spark.read.option("lineSep", "}").text(str(tmp_path / "array.json")).rdd.getNumPartitions() >= 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    found = {name: [] for name in held}
    for r in got:
        found[r.file.rsplit("/", 1)[1][:-5]].append(json.loads(r.record))
    key = lambda x: json.dumps(x, sort_keys=True)
    for name, (_, rows) in held.items():
        assert sorted(found[name], key=key) == sorted(rows, key=key), name
