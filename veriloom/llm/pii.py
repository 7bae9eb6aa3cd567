"""Information-theoretic sanitisation of personal data, with DataFrame functions only.

Protected entities are what patterns find: e-mail and IP addresses, card and phone numbers. Other terms can reveal them. How
strongly is estimated from the corpus: a term that stands near an entity in most of its occurrences tells almost as much as the
entity itself. With probabilities over documents, the disclosure of entity c by term t is PMI(c; t) / IC(c), that is
log(p(c, t) / (p(c) p(t))) / -log p(c), at most 1 if t never occurs without c. Terms beyond a threshold are generalised, beyond
a higher one removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.llm.urls import maybe
from veriloom.session import materialise

# Fixed kinds and patterns of the contract, in its order. Java takes them with possessive repeats and a look behind, which find the same
# matches without going over a long run of characters again and again.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

TERM = r"(?<![\p{L}\p{N}])\p{L}[\p{L}\p{N}]{2,}"
AROUND = 60
SUPPORT = 3
GENERALISE, REMOVE = 0.8, 0.95
STEP = 512
SPANS = "array<struct<kind:string,value:string,start:int,end:int>>"


def matches(text: Column, pattern: Column) -> Column:
    """Array of struct (value, start): leftmost matches and where they start, in code points.

    The text between matches gives the places. Lengths are added up in runs of STEP, then the runs: with all in one list a text of
    very many matches would take quadratic time.
    """
    values = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(values, F.slice(gaps, F.lit(1), F.size(values)), lambda v, g: F.struct(v.alias("value"), F.length(g).alias("gap")))
    empty = F.array().cast("array<struct<value:string,start:int>>")

    def add(acc: Column, x: Column) -> Column:
        at = acc["end"] + x["gap"]
        return F.struct((at + F.length(x["value"])).alias("end"), F.concat(acc["found"], F.array(F.struct(x["value"].alias("value"), at.alias("start")))).alias("found"))

    def run(first: Column) -> Column:
        return F.aggregate(F.slice(steps, first, F.lit(STEP)), F.struct(F.lit(0).alias("end"), empty.alias("found")), add)

    runs = F.transform(F.sequence(F.lit(1), F.size(values), F.lit(STEP)), run)
    starts = F.aggregate(runs, F.array(F.lit(0)), lambda acc, r: F.concat(acc, F.array(F.element_at(acc, -1) + r["end"])))
    placed = F.transform(F.arrays_zip(runs.alias("run"), F.slice(starts, F.lit(1), F.size(runs)).alias("at")),
                         lambda z: F.transform(z["run"]["found"], lambda x: F.struct(x["value"].alias("value"), (x["start"] + z["at"]).alias("start"))))
    return F.when(F.size(values) > 0, F.flatten(placed)).otherwise(empty)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right is doubled, digits of the results are summed."""
    def term(i: Column) -> Column:
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), lambda acc, i: acc + term(i)) % 10 == 0


def base_spans(text: Column) -> Column:
    """Array of struct (kind, value, start, end) by kind as listed, then by start. ``text`` is not null."""
    def part(p: Column) -> Column:  # leading zeros aside, at most 255
        plain = F.regexp_replace(p, "^0+", "")
        return (F.length(plain) <= 3) & (F.coalesce(F.try_to_number(plain, F.lit("999")), F.lit(0)) <= 255)

    long_enough = lambda v, least, most: F.length(digits(v)).between(least, most)
    rules = {
        "email": (EMAIL, F.contains(text, F.lit("@")), lambda v: F.lit(True)),
        "ip": (IP, text.rlike(r"[0-9]\.[0-9]"), lambda v: F.forall(F.split(v, r"\."), part)),
        "card": (CARD, text.rlike("[0-9]{2}|[0-9][ -][0-9]"), lambda v: F.when(long_enough(v, 16, 19), luhn(digits(v))).otherwise(F.lit(False))),
        "phone": (PHONE, F.contains(text, F.lit("+")), lambda v: long_enough(v, 8, 15)),
    }

    def spans(kind: str) -> Column:
        pattern, worth, valid = rules[kind]
        found = F.filter(matches(text, F.lit(pattern)), lambda m: valid(m["value"]))
        full = F.transform(found, lambda m: F.struct(F.lit(kind).alias("kind"), m["value"].alias("value"), m["start"].alias("start"), (m["start"] + F.length(m["value"])).alias("end")))
        return F.when(worth, full).otherwise(F.array().cast(SPANS))

    return F.concat(*[spans(k) for k in KINDS])


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _key(text: Column) -> Column:
    """Which text it is: two hashes, for a text is looked up by it."""
    return F.concat(F.hex(F.xxhash64(text)), F.substring(F.sha1(text), 1, 8))


def _passing(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` that may have one of the stored ``keys``: a filter of bounded size before an exact join."""
    return maybe(df, key, keys).where("_maybe").drop("_maybe")


def disclosure(texts: DataFrame, found: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(term, entity, disclosure) for terms within AROUND characters of an entity in ``support`` different texts or more.

    ``texts``: text; ``found``: stored (key, spans, near) of texts with spans. An entity, or a word, counts once a document. Pairs
    arise per occurrence from a window of bounded width and combine before the shuffle; words of the corpus are counted only if they
    may be a candidate.
    """
    total = texts.count()
    seen = found.select("key", "n", F.explode("near").alias("_s")).select("key", "n", F.xxhash64("_s.kind", F.lower("_s.value")).alias("entity"), "_s.terms")
    entities = seen.select("key", "n", "entity").distinct().groupBy("entity").agg(F.sum("n").alias("with_entity"))
    pairs = (seen.select("key", "n", "entity", F.explode(F.array_distinct("terms")).alias("term")).distinct()
             .groupBy("entity", "term").agg(F.sum("n").alias("together"), F.count("*").alias("texts")).where(F.col("texts") >= support))
    pairs = materialise(pairs, "pairs")
    candidates = materialise(pairs.select("term").distinct(), "candidates")
    each = texts.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    counted = _passing(each, "term", candidates).groupBy("term").agg(F.count("*").alias("with_term"))
    joined = pairs.join(counted, "term").join(entities, "entity")
    n = F.lit(float(total))
    pmi = F.log(n * F.col("together") / (F.col("with_entity") * F.col("with_term")))
    information = F.log(n / F.col("with_entity"))
    return joined.where(F.col("with_entity") < total).select("term", "entity", F.try_divide(pmi, information).alias("disclosure"))


def find(df: DataFrame, text: str = "text", doc: str = "doc_id", support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """doc_id, key, base and more of every row: arrays of struct (kind, value, start, end), in code points.

    base: the entities, by kind, then start; kinds may overlap. more: terms that disclose an entity, kind ``general`` or ``removed``, by
    start, in every text of the corpus, but for those inside a base span. Null texts are empty and have none; repeated rows are
    answered each; no rows give none. Runs jobs when called; stores spans and terms, no texts.
    """
    texts = df.select(F.col(doc).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    around = lambda s: F.concat(  # noqa: E731  words cut by the window's edge are left out
        F.regexp_replace(F.substring(F.col("text"), F.greatest(s["start"] - AROUND, F.lit(0)) + 1, F.least(s["start"], F.lit(AROUND))),
                         F.when(s["start"] > AROUND, r"^[\p{L}\p{N}]+").otherwise("^$"), F.lit("")),
        F.lit(" "),
        F.regexp_replace(F.substring(F.col("text"), s["end"] + 1, F.lit(AROUND)),
                         F.when(F.length("text") > s["end"] + AROUND, r"[\p{L}\p{N}]+$").otherwise("^$"), F.lit("")))
    rows = texts.withColumn("base", base_spans(F.col("text")))
    near = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["value"].alias("value"), words(around(s)).alias("terms")))
    stored = materialise(rows.select("doc_id", _key(F.col("text")).alias("key"), "base", near.alias("near")), "spans")
    found = materialise(stored.where(F.size("base") > 0).groupBy("key").agg(F.first("near").alias("near"), F.count("*").alias("n")), "found")
    told = disclosure(texts, found, support).groupBy("term").agg(F.max("disclosure").alias("d")).where(F.col("d") >= generalise)
    terms = materialise(told.select("term", F.when(F.col("d") >= remove, "removed").otherwise("general").alias("kind")), "terms")
    in_text = texts.select(_key(F.col("text")).alias("key"), F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    hits = _passing(in_text, "term", terms).join(terms.hint("shuffle_merge"), "term")
    listed = materialise(hits.distinct().groupBy("key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("term", "kind")))).alias("terms")), "told")
    keyed = texts.withColumn("key", _key(F.col("text")))
    few = _passing(keyed, "key", listed.select("key")).join(listed.hint("shuffle_merge"), "key").dropDuplicates(["key"])
    either = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(F.map_keys("terms"), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    placed = few.withColumn("base", base_spans(F.col("text"))).withColumn("_m", matches(F.col("text"), either))
    outside = F.filter("_m", lambda m: ~F.exists("base", lambda b: (b["start"] < m["start"] + F.length(m["value"])) & (m["start"] < b["end"])))
    kind = lambda m: F.coalesce(F.try_element_at("terms", F.lower(m["value"])), F.lit("general"))
    spans = F.transform(outside, lambda m: F.struct(kind(m).alias("kind"), m["value"].alias("value"), m["start"].alias("start"), (m["start"] + F.length(m["value"])).alias("end")))
    more = materialise(placed.select("key", spans.alias("more")), "more")
    none = F.array().cast(SPANS)
    return (stored.select("doc_id", "key", "base").join(more.hint("shuffle_merge"), "key", "left")
            .withColumn("more", F.coalesce("more", none)))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def replaced(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets, removed terms by nothing. Overlapping spans become one."""
    order = F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        grown = F.struct(last["kind"].alias("kind"), last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        own = F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        return (F.when(F.size(acc) == 0, F.array(own)).when(s["start"] < last["end"], F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(grown)))
                .otherwise(F.concat(acc, F.array(own))))

    joined = F.aggregate(order, F.array().cast("array<struct<kind:string,start:int,end:int>>"), merge)
    ends = F.concat(F.array(F.lit(0)), F.transform(joined, lambda s: s["end"]))
    mark = lambda s: F.when(s["kind"] == "removed", "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    parts = F.transform(joined, lambda s, i: F.concat(F.substring(text, F.get(ends, i) + 1, s["start"] - F.get(ends, i)), mark(s)))
    rest = F.substring(text, F.element_at(ends, -1) + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(parts, ""), rest))


def sanitise(df: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """``df`` with its texts sanitised: entities are found in place, disclosing terms joined to the few texts that hold any. Null texts
    stay null, other columns as they are."""
    more = materialise(find(df, text, doc).where(F.size("more") > 0).groupBy("key").agg(F.first("more").alias("_more")), "more")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    tested = maybe(rows.withColumn("key", _key(F.col("_text"))), "key", more)
    own, none = base_spans(F.col("_text")), F.array().cast(SPANS)
    some = tested.where("_maybe").join(more.hint("shuffle_merge"), "key", "left").withColumn("_spans", F.concat(own, F.coalesce("_more", none)))
    others = tested.where("NOT _maybe").withColumn("_more", none).withColumn("_spans", own)
    both = some.unionByName(others)
    clean = F.when(F.col(f"_doc.`{text}`").isNotNull(), replaced(F.col("_text"), F.col("_spans")))
    return both.select(F.col("_doc").withField(f"`{text}`", clean).alias("_doc")).select("_doc.*")
