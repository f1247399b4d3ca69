"""Personal data and the terms that give it away, by column functions only.

Base spans (email, ip, card, phone) come from patterns. Every base value and its kind are protected
entities. A term discloses an entity when they stand in the same texts more often than apart: its
pointwise mutual information with the entity, as a share of the entity's own information content
-log2 p(e), reaches a threshold. Such terms are generalised wherever they stand, beyond a second
threshold removed.

What copying alone brings together is no evidence. A term discloses a kind only if it stands by
several different values of it, so copies of one text or passage count once. A value that more
terms would disclose than name a person has been copied with its text, and none of them is taken.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.catalog.registry import table
from tallyguard.llm.rows import fresh
from tallyguard.session import stored

KIND_SUPPORT, VALUE_SUPPORT = 5, 2
"""Distinct texts that a term and an entity share, for a kind also different values of it (of 63 hash classes)."""
MOST_NAMES = 12
"""Terms that one value may have; more of them are a text or passage that was copied with it."""
CHANCE = 1e-3
"""Most probable a chance meeting may be, by Chernoff's bound on a Poisson count."""
BLOCK = 64
MOST_BROADCAST = 100_000
GENERALISE_AT, REMOVE_AT = 0.7, 0.9

# The patterns, written so that a match never needs a second try: a run is entered at its start only
# and never given back, which keeps long runs linear. What they match is the same.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}"
CARD = r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone"]
ACTIONS = ["generalise", "remove"]
TERM = r"\p{L}{2,}+"
SPAN = "struct<kind:string,start:int,end:int,value:string>"


def located(text: Column, pattern: str, kind: str, offset: Column | int = 0) -> Column:
    """All matches as array of (kind, start, end, value), in code points, from what stands between them."""
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct((F.lit(0) + offset).cast("int").alias("at"), F.array().cast(f"array<{SPAN}>").alias("found"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["between"])
        end = begin + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["match"].alias("value"))
        return F.struct(end.alias("at"), F.when(x["match"].isNotNull(), F.array_append(state["found"], span))
                        .otherwise(state["found"]).alias("found"))

    both = F.zip_with(between, matches, lambda b, m: F.struct(b.alias("between"), m.alias("match")))
    return F.aggregate(both, start, step, lambda s: s["found"])


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    digits = F.transform(F.split(F.reverse(F.regexp_replace(value, "[ -]", "")), "(?!$)"), lambda d: d.try_cast("int"))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).otherwise(
        F.when(d > 4, 2 * d - 9).otherwise(2 * d)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def small_parts(value: Column) -> Column:
    """Whether every number of a dotted one is at most 255."""
    return F.forall(F.split(value, r"\."), lambda p: F.coalesce(
        (F.regexp_replace(p, "^0+(?=[0-9])", "")).try_cast("int") <= 255, F.lit(False)))


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end, value) of the valid base matches, by kind, then start."""
    none = F.array().cast(f"array<{SPAN}>")
    digits = "[^0-9]"
    email = F.when(F.contains(text, F.lit("@")), located(text, EMAIL, "email")).otherwise(none)
    ip = F.when(text.rlike(IP), F.filter(located(text, IP, "ip"), lambda s: small_parts(s["value"]))).otherwise(none)
    card = F.when(text.rlike(CARD), F.filter(located(text, CARD, "card"), lambda s: luhn(s["value"]))).otherwise(none)
    phone = F.when(F.contains(text, F.lit("+")), F.filter(located(text, PHONE, "phone"), lambda s: F.length(
        F.regexp_replace(s["value"], digits, "")).between(8, 15))).otherwise(none)
    return F.concat(email, ip, card, phone)


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` with a digit for every sign of a span: terms end there, places stay."""
    def step(state: Column, s: Column) -> Column:
        begin = F.greatest(s["start"], state["at"])
        out = F.concat(state["out"], F.substring(text, state["at"] + 1, begin - state["at"]), F.repeat(F.lit("0"), s["end"] - begin))
        return F.when(s["end"] <= state["at"], state).otherwise(F.struct(s["end"].alias("at"), out.alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    places = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return F.when(F.size(spans) > 0, F.aggregate(places, start, step, lambda s: F.concat(
        s["out"], F.substring(text, s["at"] + 1, F.length(text))))).otherwise(text)


def forms_pattern(forms: Column) -> Column:
    """A pattern for runs of letters that are one of ``forms``, themselves runs of letters."""
    return F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(forms, "|"), F.lit(r")(?!\p{L})"))


def term_places(text: Column, forms: Column) -> Column:
    """All places of terms written as in ``forms``, as array of (term, start, end).

    Only what ``forms`` lists is searched, so the work follows the hits; they are gathered in blocks,
    so that texts with many do not copy long arrays.
    """
    kind = "array<struct<term:string,start:int,end:int>>"
    pattern = forms_pattern(forms)
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("block"), F.array().cast(f"array<{kind}>").alias("done"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["between"])
        end = begin + F.coalesce(F.length(x["match"]), F.lit(0))
        full = F.size(state["block"]) >= BLOCK
        term = F.struct(F.lower(x["match"]).alias("term"), begin.alias("start"), end.alias("end"))
        block = F.when(full, F.array(term)).otherwise(F.array_append(state["block"], term))
        return F.struct(end.alias("at"), F.when(x["match"].isNull(), state["block"]).otherwise(block).alias("block"),
                        F.when(full & x["match"].isNotNull(), F.array_append(state["done"], state["block"]))
                        .otherwise(state["done"]).alias("done"))

    both = F.zip_with(between, matches, lambda b, m: F.struct(b.alias("between"), m.alias("match")))
    found = F.aggregate(both, start, step, lambda s: F.flatten(F.array_append(s["done"], s["block"])))
    return F.when(F.size(forms) > 0, found).otherwise(F.array().cast(kind))


def terms_of(text: Column) -> Column:
    """Every term as written."""
    return F.regexp_extract_all(text, F.lit(TERM), F.lit(0))


def distinct_terms(text: Column, spans: Column) -> Column:
    """The different terms outside the spans."""
    return F.array_distinct(F.transform(terms_of(without_spans(text, spans)), F.lower))


def with_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, text, base) of every row; a null text is empty."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text", base_spans(F.col("text")).alias("base"))


def value_classes(spans: Column, kind: str) -> Column:
    """The hash classes of the values of a kind, as bits."""
    def bit(s: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(s["value"]), F.lit(63)).cast("int"))

    return F.aggregate(F.filter(spans, lambda s: s["kind"] == kind), F.lit(0).cast("long"), lambda a, s: a.bitwiseOR(bit(s)))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """Stored (entities, terms) of every different text: kinds with their value classes and base values, terms outside."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).distinct().withColumn("base", base_spans(F.col("text")))
    base = F.col("base")
    kinds = F.filter(F.array(*(F.struct(F.lit(k).alias("entity"), value_classes(base, k).alias("classes")) for k in KINDS)),
                     lambda e: e["classes"] != 0)
    values = F.array_distinct(F.transform(base, lambda s: F.struct(
        F.concat_ws(":", s["kind"], s["value"]).alias("entity"), F.lit(0).cast("long").alias("classes"))))
    return stored(texts.select(F.concat(kinds, values).alias("entities"),
                               distinct_terms(F.col("text"), base).alias("terms")), "texts")


def disclosing_terms(texts: DataFrame, kind_support: int = KIND_SUPPORT, value_support: int = VALUE_SUPPORT,
                     generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT, most_names: int = MOST_NAMES,
                     chance: float = CHANCE) -> tuple[DataFrame, DataFrame]:
    """((term, action) of the terms whose disclosure of an entity reaches a threshold, stored; (term) of frequent others).

    All counts are of different texts, so that copies of a text add nothing. Terms that meet the entity
    no more often than ``chance`` allows are left out, and so are those of a value with over ``most_names``.
    """
    n = texts.count()
    n_term = stored(texts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_term")), "counts")
    is_kind = F.col("entity").isin(KINDS)
    support = F.when(is_kind, kind_support).otherwise(value_support)
    held = texts.where(F.size("entities") > 0).select(F.inline("entities"), "terms")
    entities = stored(held.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= support), "entities")
    values = held.where(~is_kind).join(entities.select("entity"), "entity", "left_semi")
    together = (held.where(is_kind).union(values).select("entity", "classes", F.explode("terms").alias("term"))
                .groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.bit_or("classes").alias("classes"))
                .where((F.col("n_both") >= support) & (~is_kind | (F.bit_count("classes") >= kind_support))))
    shared = F.log2(F.col("n_both") * F.lit(n) / (F.col("n_term") * F.col("n_entity")))
    content = F.log2(F.lit(n) / F.col("n_entity"))
    disclosure = F.when(content > 0, shared / content)
    expected = F.col("n_term") * F.col("n_entity") / F.lit(n)
    by_chance = F.col("n_both") - expected + F.col("n_both") * F.log(expected / F.col("n_both"))
    scored = stored(together.join(entities, "entity").join(n_term, "term").withColumn("disclosure", disclosure)
                    .where((F.col("disclosure") >= generalise_at) & (expected < F.col("n_both")) & (by_chance <= math.log(chance)))
                    .select("entity", "term", "disclosure"), "scored")
    copied = (scored.where(~is_kind).groupBy("entity").agg(F.count("*").alias("names"))
              .where(F.col("names") > most_names).select("entity"))
    risky = scored.join(copied, "entity", "left_anti").groupBy("term").agg(F.max("disclosure").alias("disclosure"))
    risky = stored(risky.select("term", F.when(F.col("disclosure") >= remove_at, ACTIONS[1]).otherwise(
        ACTIONS[0]).alias("action")), "terms")
    return risky, n_term.where(F.col("n_term") * 1000 >= n).join(risky, "term", "left_anti").select("term")


def all_spans(docs: DataFrame, **thresholds) -> DataFrame:
    """(doc_id, row_key, base, added) of every row: base spans and those of disclosing terms, actions as kinds."""
    found = with_spans(docs)
    risky, frequent = disclosing_terms(distinct_texts(docs), **thresholds)
    names = found.select("doc_id", "row_key", F.explode(distinct_terms(F.col("text"), F.col("base"))).alias("term"))
    if risky.count() <= MOST_BROADCAST:                                # the terms of a row need no shuffle
        risky = F.broadcast(risky)
    else:
        frequent = stored(frequent, "frequent")
        if frequent.count() <= MOST_BROADCAST:                         # most terms need none
            names = names.join(F.broadcast(frequent), "term", "left_anti")
    hits = (names.join(risky, "term").groupBy("row_key", "doc_id").agg(
        F.collect_set(F.struct("term", "action")).alias("flagged")))
    hits = hits.select(F.col("row_key").alias("_key"), F.col("doc_id").alias("_id"), F.map_from_entries("flagged").alias("flagged"))
    joined = found.join(hits, (F.col("row_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    outside = without_spans(F.col("text"), F.col("base"))
    forms = F.array_distinct(F.filter(terms_of(outside), lambda x: F.map_contains_key(F.col("flagged"), F.lower(x))))
    added = F.array_sort(F.transform(term_places(outside, forms), lambda t: F.struct(
        F.element_at("flagged", t["term"]).alias("kind"), t["start"].alias("start"), t["end"].alias("end"))))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return joined.select("doc_id", "row_key", "base", F.when(F.col("flagged").isNotNull(), added).otherwise(none).alias("added"))


def sanitised(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with base spans and generalised terms replaced by their kind in brackets, other terms removed.

    Of overlapping spans the one that starts first counts. n_chars is left as it was. A text without
    spans, null or empty, stays as it is; repeated rows get the same text each; all columns stay,
    whatever their names; an empty table gives no rows.
    """
    spans = all_spans(docs, **options)
    marks = F.concat(F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(
        F.lit("["), s["kind"], F.lit("]")).alias("put"))), F.transform("added", lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.when(
                s["kind"] == ACTIONS[1], "").otherwise("[context]").alias("put"))))
    keyed = spans.where((F.size("base") > 0) | (F.size("added") > 0)).select(
        F.col("row_key").alias("_key"), F.array_sort(marks).alias("_marks")).dropDuplicates(["_key"])
    row, key, mark = fresh(docs, "row_key", "key", "marks")
    keyed = keyed.toDF(key, mark)
    rows = docs.withColumn(row, F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    joined = rows.join(keyed, F.col(row) == F.col(key), "left")
    text = F.col("text")

    def step(state: Column, m: Column) -> Column:
        put = F.concat(state["out"], F.substring(text, state["at"] + 1, m["start"] - state["at"]), m["put"])
        return F.when(m["start"] < state["at"], state).otherwise(F.struct(m["end"].alias("at"), put.alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate(mark, start, step, lambda s: F.concat(
        s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return joined.select(*(F.when(F.col(mark).isNotNull(), whole).otherwise(text).alias(c) if c == "text"
                           else F.col(c) for c in docs.columns))


def personal_data(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row of ``docs``.

    Null and empty texts have no spans; repeated rows get the same spans each; a null doc_id stays
    null; other columns are not looked at; an empty table gives no rows.
    """
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    base = listed(F.col("base"))
    return all_spans(docs, **options).select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), F.concat_ws(
        ",", F.when(F.size("base") > 0, base), F.when(F.size("added") > 0, listed(F.col("added")))).alias("spans"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in the whole table."""
    return personal_data(table(spark, sf_dir, "documents"))
