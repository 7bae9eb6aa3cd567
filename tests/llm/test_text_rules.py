import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from veriloom.llm import classifier, pii, quality_rules, queries

WORD = r"[^\x20\x09-\x0D]+"


# quality rules


def brute_base(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    twice = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), twice, len(covered)


def brute_rules(docs, limit, least=0.5):
    def lines(text):
        return [(quality_rules.line_hash(x.encode()), len(re.findall(WORD, x))) for x in (text or "").split("\n") if re.search(WORD, x)]

    held = defaultdict(set)
    for _, text, host in docs:
        for h, _ in lines(text):
            held[host, h].add(text)
    out = Counter()
    for doc, text, host in docs:
        base = brute_base(text)
        gone = sum(n for h, n in lines(text) if len(held[host, h]) > limit)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        out[doc, *base, gone, failed, not failed and base[0] - gone >= least * base[0]] += 1
    return out


def test_rules_equal_brute_force(spark):
    rng = random.Random(2)
    line = lambda n: " ".join(rng.choice("abcdefghij") + str(rng.randrange(90)) for _ in range(n))
    common = [line(12) for _ in range(4)]
    docs = []
    for i in range(150):
        own = [line(rng.randint(3, 12)) for _ in range(rng.randint(2, 9))]
        docs.append((i, "\n".join(rng.sample(own + (common * (i % 3) if i % 2 else [common[0].upper() + "  "]), k=min(7, len(own)))), rng.choice(["x", "y", None])))
    docs += [(1000, "\n".join(line(12) for _ in range(6)), "x")]
    docs += [(1001 + i, docs[-1][1], "x") for i in range(60)]
    docs += [(2000 + i, "\n".join([*common, line(12)]), "y") for i in range(20)]
    docs += [(d, t, s) for d, t, s in odd.TEXTS if d != 4]
    got = Counter(tuple(r) for r in quality_rules.apply_rules(odd.documents(spark, docs), limit=10).collect())
    want = brute_rules(docs, 10)
    assert got == want
    rejected = {k[0] for k in want if not k[7] and not k[8]}
    assert {k[0] for k in want if k[6]} & set(range(150)) and set(range(2000, 2020)) <= rejected and not set(range(1000, 1061)) & rejected
    assert quality_rules.apply_rules(odd.empty(spark)).count() == 0


def test_rules_on_a_long_text(spark):
    row = quality_rules.apply_rules(odd.documents(spark, [odd.TEXTS[3]])).first()
    assert (row.n_words, row.n_repeat_words) == (brute_base(odd.LONG)[0], brute_base(odd.LONG)[4]) and row.base_failed


# personal data

KINDS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute_spans(text):
    return [(k, m.start(), m.end()) for k, p in KINDS for m in re.finditer(p, text or "") if valid(k, m[0])]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(9)
    parts = ["a@b.c", "@", ".", "a", "_d@e.fg", "1", "22", "255", "300", "+", " ", "-", "(", ")", "4111111111111111", "é😀", "1.2.3.4", "00255", "\n", "%", "x" * 30, "10.0.0.1"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(1500)] + [t for _, t, _ in odd.TEXTS]
    texts += ["1.1." * 3000, "a." * 4000 + "@b" + ".c" * 4000, "x" * 200_000, "+1 " * 3000 + "5 5", "7" * 50_000, ("a@b.cd " * 1300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(8)
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in df.select("doc_id", pii.base_spans(F.coalesce("text", F.lit(""))).alias("base")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute_spans(text), repr(text)[:300]


def planted():
    """A name beside an address in eight texts and never elsewhere; a common word beside it as often; a rare word that isn't near."""
    rng = random.Random(1)
    filler = lambda n: " ".join(f"word{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(n))
    docs = [(i, filler(60) + " common stays here") for i in range(200)]
    docs += [(200 + i, f"{filler(20)} Zorblatt common j.doe@example.org {filler(30)}") for i in range(8)]
    docs += [(300 + i, f"{filler(20)} quixotic {filler(30)}") for i in range(8)]
    return docs + [(400, f"{filler(9)} ZORBLATT's desk"), (401, docs[200][1]), (402, None), (403, "")]


def brute_terms(docs, support=3, around=60):
    token = r"(?<![^\W_])[^\W\d_][^\W_]{2,}"
    n = len(docs)
    entities, pairs, texts, with_term = Counter(), Counter(), defaultdict(set), Counter()
    for _, text in docs:
        text = text or ""
        found, near = set(), set()
        for kind, a, b in brute_spans(text):
            e = (kind, text[a:b].lower())
            found.add(e)
            left = text[max(0, a - around):a]
            left = re.sub(r"^[^\W_]+", "", left) if a > around else left
            right = text[b:b + around]
            right = re.sub(r"[^\W_]+$", "", right) if len(text) > b + around else right
            near |= {(e, t) for t in re.findall(token, (left + " " + right).lower())}
        entities.update(found)
        pairs.update(near)
        for x in near:
            texts[x].add(text)
        with_term.update(set(re.findall(token, text.lower())))
    return {(e, t): math.log(n * c / (entities[e] * with_term[t])) / math.log(n / entities[e]) for (e, t), c in pairs.items() if len(texts[e, t]) >= support}


def test_terms_that_disclose(spark):
    docs = planted()
    df = odd.documents(spark, [(d, t, "s") for d, t in docs])
    rows = {r.doc_id: r for r in pii.find(df).collect()}
    scores = brute_terms(docs)
    told = {t for (_, t), d in scores.items() if d >= pii.GENERALISE}
    assert "zorblatt" in told and not told & {"common", "stays", "quixotic"}
    for doc, text in docs:
        want = [(m.start(), m.end()) for m in re.finditer(r"(?<![^\W_])(?:" + "|".join(sorted(told)) + r")(?![^\W_])", text or "", re.I)]
        assert [(s.start, s.end) for s in rows[doc].more] == want
        assert [(s.kind, s.start, s.end) for s in rows[doc].base] == brute_spans(text)
    assert {s.value for s in rows[400].more} == {"ZORBLATT"}


def test_sanitised_texts(spark):
    docs = planted()
    df = odd.documents(spark, [(d, t, "s") for d, t in docs])
    clean = pii.sanitise(df)
    assert clean.columns == df.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[402] is None and texts[403] == "" and texts[0] == docs[0][1]
    assert len(texts) == len(docs) and not any("@" in t or "zorblatt" in t.lower() for t in texts.values() if t)
    assert "[EMAIL]" in texts[200] and texts[200] == texts[401]
    assert pii.find(odd.empty(spark)).count() == 0 and pii.sanitise(odd.empty(spark)).count() == 0


def test_replaced_joins_overlaps(spark):
    spans = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit("").alias("value"), F.lit(a).alias("start"), F.lit(b).alias("end")) for k, a, b in (("ip", 6, 9), ("email", 2, 4), ("card", 3, 5), ("removed", 9, 10))])
    assert spark.range(1).select(pii.replaced(F.lit("01é345678X0"), spans)).first()[0] == "01[EMAIL]5[IP]0"


def test_query_on_the_table(spark, sf):
    rows = {r.doc_id: r for r in queries.QUERIES["op4_pii_disclosure"](spark, sf).collect()}
    docs = queries.table(spark, sf, "documents").collect()
    assert len(rows) == len(docs)
    for d in docs:
        want = brute_spans(d.text)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        row = rows[d.doc_id]
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and row.spans.startswith(text)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == n for k, _, _ in want) for n, _ in KINDS]


# quality classifier


def test_dual_coordinate_descent_reaches_the_optimum():
    """Primal and dual objectives of the hinge-loss problem meet."""
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.choice(60, 8)).astype(np.int32) for _ in range(120)]
    labels = np.array([1 if (r < 20).sum() + rng.normal() * 0.7 > 2.4 else -1 for r in rows])
    values = [np.ones(len(r)) / len(r) ** 0.5 for r in rows]
    cost = np.full(len(rows), 0.5)
    w, bias = classifier.descend(rows, values, labels, cost, rounds=3000)
    slack = [max(0, 1 - y * (w[r] @ v + bias)) for r, v, y in zip(rows, values, labels)]
    primal = 0.5 * (w @ w + bias * bias) + (cost * slack).sum()
    for shift in rng.normal(size=(40, 61)) * 0.05:  # nothing near is better
        w2, b2 = w.copy(), bias + shift[60]
        w2[:60] += shift[:60]
        other = [max(0, 1 - y * (w2[r] @ v + b2)) for r, v, y in zip(rows, values, labels)]
        assert 0.5 * (w2 @ w2 + b2 * b2) + (cost * other).sum() >= primal - 1e-3


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.1"
    got = classifier.classify(queries.table(spark, folder, "documents"), queries.table(spark, folder, "labels"))
    both = got.join(queries.table(spark, folder, "labels"), "doc_id").where("held_out").select("score", "predicted", "quality").toPandas()
    assert len(both) > 500 and (both.predicted == both.quality).mean() > 0.97
    assert both[both.quality == 1].predicted.mean() > 0.97 and both[both.quality == 0].predicted.mean() < 0.1


def test_odd_rows_are_scored(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    docs = odd.documents(spark, [*odd.TEXTS, *[(i, ("fine words follow here. " if i % 2 else "BAD!! BAD!! ") * 9, "s") for i in range(10, 40)]])
    rows = classifier.classify(docs, labels).collect()
    assert len(rows) == len(odd.TEXTS) + 30 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all((r.score > 0.5) == (r.doc_id % 2) for r in rows if r.doc_id and r.doc_id >= 10)
    assert all(r.held_out is not None for r in rows)
    assert classifier.classify(odd.empty(spark), labels).count() == 0
    assert classifier.classify(docs, labels.limit(0)).count() == len(rows)
    again = classifier.classify(docs.repartition(5), labels.repartition(3)).collect()
    assert {(r.doc_id, r.score) for r in again} == {(r.doc_id, r.score) for r in rows}


def test_labels_of_the_held_out_fold_are_not_used(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id bigint, quality int")
    docs = spark.createDataFrame([(i, f"text number {i} " + ("good" if i % 2 else "bad")) for i in range(200)], "doc_id bigint, text string")
    flipped = labels.withColumn("quality", F.when(classifier.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (odd.plain(classifier.classify(docs, x)) for x in (labels, flipped))
    assert a == b


@pytest.mark.parametrize("text", [None, "", "  ", "a", "a a a"])
def test_features_of_short_texts(text):
    assert (np.diff(classifier.features(text)) > 0).all()


def test_a_repeated_id_does_not_crowd_out_the_sample(spark):
    """One labelled id holds 20 000 rows of many texts: a row per id and label reaches the driver."""
    docs = [(i, f"good fine text {i}" if i % 2 else f"bad poor words {i}") for i in range(60)] + [(1, f"text {i}") for i in range(20_000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    model = classifier.train(frame, labels, sample=50)
    assert model.score(classifier.features("good fine text")) > model.score(classifier.features("bad poor words"))
