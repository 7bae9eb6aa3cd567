"""The pipeline's near-duplicate stage against all pairs by brute force."""

import random
import re
from collections import defaultdict

import odd
from test_simhash_mixing import classes

import corpus_pipeline
from veriloom.llm import jaccard, queries


def brute_sets(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1)) or frozenset([tuple(words)] if words else [])


def brute_kept(rows, least=0.8):
    """Ids of the rows that stay. Pairs are looked for where a shingle is shared."""
    sets, held = [brute_sets(t) for _, t in rows], defaultdict(list)
    for i, s in enumerate(sets):
        for g in s or [()]:
            held[g].append(i)
    pairs = {(i, j) for own in held.values() for i in own for j in own if i < j}
    alike = lambda a, b: len(a & b) >= least * len(a | b)
    own = classes([(i, j) for i, j in pairs if alike(sets[i], sets[j])], range(len(rows)))
    least_id = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least_id[own[i]].append(doc)
    return sorted(min(x) for x in least_id.values())


def edited(rng, words, most):
    copy = list(words)
    for _ in range(rng.randint(0, most)):
        copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
    return " ".join(copy)


def test_edited_copies_go(spark):
    rng = random.Random(3)
    rows = []
    for n in (1, 2, 5, 12, 40, 300):
        words = [f"w{rng.randrange(900)}" for _ in range(400)]
        rows += [(len(rows) + k, edited(rng, words, 8)) for k in range(n)]
    rng.shuffle(rows)
    df = odd.documents(spark, [(d, t, "s") for d, t in rows])
    want = brute_kept(rows)
    assert len(want) <= 12
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()) == want


def test_chains_and_unlike_rows_of_a_bucket(spark):
    """Copies of copies, each alike to the next only, and texts that share most but not enough."""
    rng = random.Random(5)
    words, rows = [f"w{i}" for i in range(300)], []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words[rng.randrange(300)] = f"n{i}"
        words[rng.randrange(300)] = f"m{i}"
    base = [f"b{i}" for i in range(300)]
    rows += [(100 + i, " ".join(base[:200] + [f"own{i}-{k}" for k in range(100)])) for i in range(60)]
    df = odd.documents(spark, [(d, t, "s") for d, t in rows])
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect())
    assert got == brute_kept(rows) and set(range(100, 160)) <= set(got)


def test_mixed_buckets_are_finished(spark, monkeypatch):
    """Small classes among many unlike texts of one template: with no peers looked at, the rarest shingles alone must find them."""
    monkeypatch.setattr(jaccard, "PEERS", 0)
    monkeypatch.setattr(jaccard, "CHUNK", 7)
    rng = random.Random(8)
    base, rows = [f"b{i}" for i in range(300)], []
    for i in range(50):
        words = base[:250] + [f"own{i}-{k}" for k in range(70)]
        for _ in range(3 if i % 5 == 0 else 1):
            rows.append((len(rows), edited(rng, words, 3)))
    for n in (14, 15, 16, 20):  # pairs at exactly the least similarity, and just below
        words = [f"e{n}-{k}" for k in range(n + 4)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[:4 + int(n * 0.8 + 1e-9)]))]
    df = odd.documents(spark, [(d, t, "s") for d, t in rows])
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()) == brute_kept(rows)


def test_rows_to_compare_stay_in_proportion_to_a_group(spark, monkeypatch):
    """Each step makes at most one pair of a row of a bucket or of a shingle, however many near copies a group holds."""
    rng, store, stored = random.Random(11), jaccard.materialise, []

    def counted(df, name):
        stored.append((name, store(df, name)))
        return stored[-1][1]

    monkeypatch.setattr(jaccard, "materialise", counted)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, edited(rng, base, 8)) for i in range(250)]
    df = odd.documents(spark, [(d, t, "s") for d, t in rows])
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()) == brute_kept(rows)
    most = {name: max(f.count() for n, f in stored if n == name) for name, _ in stored}
    assert 0 < most["across"] <= most["met"] and most["unsettled"] <= most["met"]


def test_rarest_shingles_of_alike_sets_meet(spark):
    rng = random.Random(2)
    sets = [frozenset(rng.sample(range(40), rng.randint(1, 12))) for _ in range(300)]
    rows = [(i, len(s), i, list(s)) for i, s in enumerate(dict.fromkeys(sets))]
    held = defaultdict(set)
    for r in jaccard.rarest(spark.createDataFrame(rows, "set_id bigint, n int, root bigint, grams array<bigint>"), 0.8).collect():
        held[r.set_id].add(r.gram)
    own = [frozenset(r[3]) for r in rows]
    alike = [(i, j) for i in range(len(own)) for j in range(i) if len(own[i] & own[j]) >= 0.8 * len(own[i] | own[j])]
    assert all(held[i] & held[j] for i, j in alike) and all(len(held[i]) <= len(s) for i, s in enumerate(own))


def test_on_the_table_and_odd_rows(spark, sf):
    docs = queries.table(spark, sf, "documents")
    assert sorted(r.doc_id for r in jaccard.deduplicate(docs).collect()) == brute_kept([(r.doc_id, r.text) for r in docs.collect()])
    assert jaccard.near_duplicates(odd.documents(spark)).count() == odd.documents(spark).count()
    assert jaccard.deduplicate(odd.empty(spark)).count() == 0


def test_shingles_of_long_texts(monkeypatch):
    text = odd.LONG[:20_000].encode()
    whole = jaccard.shingles(text)
    monkeypatch.setattr(jaccard, "WINDOW_BYTES", 50)
    assert (jaccard.shingles(text) == whole).all() and len(jaccard.shingles(b"")) == 0
    assert len(jaccard.shingles(b"A b")) == 1 and (jaccard.shingles(b"A b") == jaccard.shingles(b"a  B\n")).all()


def test_one_row_of_each_component_stays(spark):
    """Rows without an id are deduplicated too, and rows that share an id but not a text are judged by their own components."""
    same, other, third = "alpha beta gamma delta epsilon zeta " * 4, "one two three four five six seven", "un deux trois quatre cinq six"
    rows = [(2, same), (5, same), (5, other), (5, other), (None, same), (None, third), (None, third), (None, None), (9, " "), (None, "")]
    got = jaccard.deduplicate(odd.documents(spark, [(d, t, "s") for d, t in rows])).collect()
    assert sorted([(r.doc_id or 0, r.text) for r in got]) == [(0, third), (2, same), (5, other), (9, " ")]
