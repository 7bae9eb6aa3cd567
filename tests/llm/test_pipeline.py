"""The pipeline against a brute-force version, stage by stage and as a whole, on a small corpus that holds one of everything."""

import random
from collections import Counter

import odd
import pytest
from pyspark.sql import functions as F
from test_jaccard import brute_kept
from test_simhash_mixing import brute_targets, words
from test_text_rules import brute_spans
from test_tokens_packing import check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from veriloom.llm import classifier, queries, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(11)
    fine = lambda n: " ".join("".join(rng.choices("aeioulmnrst", k=rng.randint(2, 8))) for _ in range(n)).capitalize() + "."
    rows, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        rows.append((i, " ".join(["BUY!! NOW!!"] * rng.randint(20, 60)) + f" {i}" if bad else fine(rng.randint(30, 200)), f"s{i % 3}"))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, int(not bad)))
    rows += [(300 + i, rows[1][1], "s1") for i in range(9)] + [(320 + i, rows[2][1] + (" x" if i else ""), None) for i in range(3)]
    rows += [(340 + i, f"{fine(40)} write to me{i}@mail.example.org or call +1 (555) 010-99{i}9 {fine(40)}", "s2") for i in range(9)]
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    df.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("bigint").alias("n_chars")).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_equal_brute_force(spark, folder):
    names, stages = zip(*corpus_pipeline.STAGES)
    assert names == ("quality", "near_duplicates", "personal_data", "mix", "pack")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet")

    good = stages[0](spark, docs, folder)
    model = classifier.train(docs, labels)
    want = {d for d, t in rows.items() if model.score(classifier.features(t)) >= 0.3}
    assert good.columns == COLUMNS and sorted(r.doc_id for r in good.collect()) == sorted(want)
    assert {d for d in rows if d < 240 and d % 4} | set(range(300, 349)) & rows.keys() == want  # all clean documents, no junk

    single = stages[1](spark, good, folder)
    assert single.columns == COLUMNS and sorted(r.doc_id for r in single.collect()) == brute_kept([(d, rows[d]) for d in want])
    assert not {r.doc_id for r in single.collect()} & set(range(300, 309))

    clean = stages[2](spark, single, folder)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert clean.columns == COLUMNS and all(r.n_chars == len(r.text) for r in clean.collect())
    for r in single.collect():
        spans = brute_spans(r.text)
        assert not brute_spans(texts[r.doc_id]) and (bool(spans) or texts[r.doc_id] == r.text)

    mixed = stages[3](spark, clean, folder)
    taken = Counter((r.doc_id, r.source, r.text) for r in mixed.collect())
    sizes, got = Counter(), Counter()
    for r in clean.collect():
        sizes[r.source] += words(r.text)
    for (_, source, text), n in taken.items():
        assert n <= 2
        got[source] += n * words(text)
    for source, target in brute_targets(sizes).items():
        assert abs(got[source] - target) <= 100
    assert mixed.columns == COLUMNS

    library = Tokenizer.from_file(queries.tokenizer_path())
    check_packing(stages[4](spark, mixed, folder).collect(), [(d, t) for (d, _, t), n in taken.items() for _ in range(n)], library, 2048)


def test_run_is_the_stages_one_after_another(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    again = corpus_pipeline.run(spark, folder)
    digest = lambda df: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert digest(got) == digest(again) and got.count() > 100


def test_odd_rows_and_no_rows(spark, folder):
    docs = odd.documents(spark)
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs.withColumn("n_chars", F.length("text").cast("bigint")), folder)
        assert out.columns == docs.columns and out.count() <= 2 * docs.count()
        assert stage(spark, odd.empty(spark), folder).count() == 0
    assert corpus_pipeline.STAGES[4][1](spark, docs, folder).select("doc_id").distinct().count() == 8


def test_one_document_of_a_group_stays(spark):
    rows = [(i, "same text again and again and so on", "a") for i in range(50)] + [(i, None, "a") for i in range(60, 70)]
    kept = simhash.deduplicate(odd.documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == [0, 60]
