import math
import random
import re
from collections import Counter, defaultdict

import odd
import pytest
import xxhash
from pyspark.sql import functions as F

from veriloom.llm import common, mixing, queries, simhash


def brute_fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_components(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    own = classes(pairs, range(len(rows)))
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[own[i]].append(doc)
    return Counter((doc, prints[i], min(least[own[i]], default=None)) for i, (doc, _) in enumerate(rows))


def found(df):
    return Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(df).collect())


def test_simhash_equals_brute_force(spark, monkeypatch):
    assert found(odd.documents(spark)) == brute_components([(d, t) for d, t, _ in odd.TEXTS])
    assert simhash.near_duplicates(odd.empty(spark)).count() == 0
    monkeypatch.setattr(simhash, "WINDOW_BYTES", 100)
    for text in (odd.LONG[:30_000], "A b", "", "one  two\nthree FOUR É x" * 30):
        assert simhash.fingerprint(text.encode()) & (1 << 64) - 1 == brute_fingerprint(text)


def test_near_copies_and_chains(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(12):
        text = rng.choices(words, k=400)
        for _ in range(rng.choice([1, 2, 40])):
            copy = list(text)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(df) == brute_components(rows)
    kept = simhash.deduplicate(df).collect()
    want = {c for _, _, c in brute_components(rows)}
    assert sorted(r.doc_id for r in kept) == sorted(want) and len(want) < len(rows)


def test_links_of_any_even_radius(spark):
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    prints = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for s in seeds for _ in range(8)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    for radius in (0, 2, 4):
        pairs = [(r.a, r.b) for r in simhash.links(df, radius).collect()]
        near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= radius]
        assert classes(pairs, signed) == classes(near, signed)
    with pytest.raises(ValueError):
        simhash.links(df, 3)


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, i) for i in range(6000, 6300)] + [(7, 7)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    want = classes(pairs, {x for p in pairs for x in p})
    assert got == {n: r for n, r in want.items() if n != r}


def test_deduplicate_keeps_columns_and_rows_without_id(spark):
    df = odd.documents(spark)
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    # 1, 2 and 3 have no words; the repeated 5 stays once
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 4, 5, 6, 7, None, None])


def test_rank_within_spreads_a_key(spark):
    rows = [(i, None if i % 5 == 0 else "hot" if i % 2 else f"k{i % 7}") for i in range(500)]
    df = common.stored_rows(spark.createDataFrame(rows, "id int, k string"), "rank")
    ranks = defaultdict(list)
    for r in common.rank_within(df, ["k"]).collect():
        ranks[r.k].append(r["rank"])
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in Counter(k for _, k in rows).items()}


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in out]
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = most * sizes[s]
        left = share * sum(sizes.values()) - sum(out.values())


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check_mix(rows, docs):
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += words(text)
    targets = brute_targets(sizes)
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((d, s, words(t)) for d, t, s in docs)
    taken, longest = Counter(), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    for s, t in targets.items():
        assert abs(taken[s] - t) <= longest[s] / 2 + 1


def test_mix_of_the_table(spark, sf):
    docs = [(r.doc_id, r.text, r.source) for r in queries.table(spark, sf, "documents").collect()]
    rows = mixing.mix(queries.table(spark, sf, "documents")).collect()
    check_mix(rows, docs)
    again = mixing.mix(queries.table(spark, sf, "documents").repartition(7)).collect()
    assert Counter((r.doc_id, r.copies) for r in rows) == Counter((r.doc_id, r.copies) for r in again)


def test_mix_of_odd_rows(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(["w"] * rng.choice([1, 3, 7, 40, 900])), rng.choice(["a", "b", "c", "é", None])) for i in range(400)]
    docs += [(1000 + i, None, "empty") for i in range(5)] + [(None, "w w", "b"), (3, "w " * 9, "a"), (3, "w " * 9, "a")]
    rows = mixing.mix(odd.documents(spark, docs)).collect()
    check_mix(rows, docs)
    assert all(r.taken == 0 for r in rows if r.source == "empty")
    assert mixing.mix(odd.empty(spark)).count() == 0


def test_rounding_comes_near():
    rng = random.Random(8)
    for _ in range(100):
        sizes = sorted({rng.randint(1, 3000) for _ in range(300)}, reverse=True)
        counts = [rng.choice([1, 1, 2, 50]) for _ in sizes]
        rate = rng.choice([0.01, 0.3, 0.9, 1.0, 1.5, 2.0])
        base, more = mixing.round_copies(sizes, counts, [rate] * len(sizes), 2)
        assert all(0 <= m <= n and b + (m > 0) <= 2 for b, m, n in zip(base, more, counts))
        assert abs(sum(s * (n * b + m - n * rate) for s, n, b, m in zip(sizes, counts, base, more))) <= sizes[-1] + 20


def test_dual_equals_bisection(spark):
    rng = random.Random(4)
    cells, wanted = [], []
    for s in range(12):
        sizes = [rng.choice([0, 1, 5, 40, 300, 9000]) if s % 3 else rng.randint(1, 2000) for _ in range(40)] + [7]
        own = Counter(sizes)
        mean = sum(sizes) / len(sizes)
        cells += [(str(s), float(n), size / mean) for size, n in own.items()]
        wanted.append((str(s), len(sizes) * [0.001, 0.3, 0.9, 1.0, 1.2, 1.9, 1.999][s % 7]))
    got = {r.source: r.b for r in mixing.solve(spark.createDataFrame(cells, "source string, n double, c double"), spark.createDataFrame(wanted, "source string, words_wanted double")).collect()}
    for s, w in wanted:
        given = lambda b: sum(n * c * (2.0 if b * c > 1 else min(2.0, math.exp(b * c))) for k, n, c in cells if k == s)
        lo, hi = -1e7, 1e7
        for _ in range(300):
            lo, hi = ((lo + hi) / 2, hi) if given((lo + hi) / 2) < w else (lo, (lo + hi) / 2)
        assert given(got[s]) == pytest.approx(w, rel=1e-9) and got[s] == pytest.approx(lo, rel=1e-9, abs=1e-9)


def test_rates_are_tilted(spark):
    rows = mixing.mix(spark.createDataFrame([(i, "w " * (1 + i % 50), "a" if i % 3 else "b") for i in range(600)], "doc_id bigint, text string, source string")).collect()
    for source in "ab":
        rates = [r.rate for r in sorted((r for r in rows if r.source == source), key=lambda r: r["size"])]
        ratio = next(r.target / r.source_size for r in rows if r.source == source)
        assert ratio == 2 and set(rates) == {2.0} or rates == sorted(rates, reverse=ratio < 1) and rates[0] != rates[-1]


def test_take_repeats_rows(spark):
    df = odd.documents(spark).where(F.col("doc_id").isNotNull())
    mixed = mixing.mix(df)
    want = Counter()
    for r in mixed.collect():
        want[r.doc_id] += r.copies
    taken = mixing.take(df, mixed)
    assert taken.columns == df.columns
    assert Counter(r.doc_id for r in taken.collect()) == +want


def test_solving_takes_no_jobs_a_round(spark):
    """Tilts that need many Newton steps: the plan and its result take a bounded number of jobs."""
    docs = [(i, "w " * (1 + i % 40 if i % 3 else 400), f"s{i % 7}") for i in range(700)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    spark.sparkContext.setJobGroup("mix-jobs", "mix")
    try:
        rows = mixing.mix(df).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(rows) == 700 and len(spark.sparkContext.statusTracker().getJobIdsForGroup("mix-jobs")) <= 30
