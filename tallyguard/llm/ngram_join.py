"""N-gram Jaccard join: documents linked when their word shingle sets are similar, and their groups."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.catalog.registry import table
from tallyguard.llm.components import components
from tallyguard.llm.rows import fresh
from tallyguard.llm.setjoin import (
    PART, ROW, candidate_sets, possible, rarity_levels, scan_parts, shared_prefixes, shingle_parts, similar_pairs,
    sketched)
from tallyguard.session import stored

WIDTH = 5
SIMILARITY = 0.75
PREFIX_LANES, ROUNDS = 2, 3
FIRST_KEYS, STARS = 12, 1
PAIR = ("least(l.sig, r.sig) AS a", "greatest(l.sig, r.sig) AS b")


def _star(rows: DataFrame, t: float, salt: int, filters: str = "TRUE") -> DataFrame:
    """(a, b): possible pairs of every row with two rows of its key, picked by a partial aggregation."""
    part = F.struct(*[c for c in rows.columns if c != "key"])
    leaders = rows.groupBy("key").agg(F.min_by(part, F.xxhash64("sig", F.lit(salt))).alias("x"),
                                      F.max_by(part, F.xxhash64("sig", F.lit(salt))).alias("y"))
    leaders = leaders.where("x.sig <> y.sig").select("key", F.inline(F.array("x", "y"))).alias("l")
    return (leaders.join(rows.alias("r"), F.col("l.key") == F.col("r.key")).where("l.sig <> r.sig").where(filters)
            .where(possible("l", "r", t)).selectExpr(*PAIR).distinct())


def link_groups(shared: DataFrame, sets: DataFrame, t: float) -> DataFrame:
    """(node, root) of the parts that similar pairs link, without comparing what is already linked.

    First every part's rarest shared elements (FIRST_KEYS of them) compare it with two parts that
    have the element among theirs; the links give components. STARS more rounds do so for all keys
    whose components differ, between components only. Then all pairs of a key whose components still
    differ are compared. So a large group of near copies costs a multiple of its size, and no link
    between components is missed.
    """
    shared = stored(sketched(shared, sets), "sketched")
    row = F.struct("key", *[c for c in shared.columns if c not in ("key", "sig")])
    rare = (shared.groupBy("sig").agg(F.slice(F.array_sort(F.collect_list(row)), 1, FIRST_KEYS).alias("rows"))
            .select(F.inline("rows"), "sig"))
    tried = stored(_star(rare, t, 0), "pairs")
    links = stored(similar_pairs(tried, sets, t), "similar")
    groups = stored(components(links), "components")
    for turn in range(1, STARS + 2):
        rows = shared.join(groups.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
            "root", F.coalesce("root", "sig"))
        split = rows.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
        rows = stored(rows.join(split, "key", "left_semi"), "split")
        if turn <= STARS:
            pairs = _star(rows, t, turn, "l.root <> r.root")
        else:
            pairs = (rows.alias("l").join(rows.alias("r"), F.expr("l.key = r.key AND l.root < r.root"))
                     .where(possible("l", "r", t)).selectExpr(*PAIR).distinct())
        pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = tried.union(pairs)
        links = links.union(stored(similar_pairs(pairs, sets, t), "similar"))
        groups = stored(components(links), "components")
    return groups


def near_duplicates(docs: DataFrame, width: int = WIDTH, t: float = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Two texts are linked when the Jaccard similarity of their sets of ``width``-word shingles is at
    least ``t`` (A-Z count as a-z; fewer words: one shingle of them all). component_id is the
    smallest doc_id that links reach. Null and empty texts have no shingles and no links; rows with
    equal texts are linked; rows with equal doc_id are one document each and share its id; a null
    doc_id stays null. Other columns are not looked at; an empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = partial(shingle_parts, width=width)
    texts = docs.select("doc_id", "text")
    scanned = scan_parts(texts, cut, distinct=True)
    levels = spark.sparkContext.broadcast(rarity_levels(scanned))
    shared = shared_prefixes(texts, cut, levels, t, scanned, PREFIX_LANES, ROUNDS)
    groups = link_groups(shared, candidate_sets(texts, cut, levels, shared), t)
    parts = scanned.where(F.col("kind") == PART).select(F.col("id").alias("doc_id"), "sig", "n")
    rooted = parts.join(groups.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
        "root", F.coalesce("root", "sig"))
    several = rooted.groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("c")).where("c > 1")
    full = (rooted.join(several.select("root", "least"), "root", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")))
    empty = scanned.where(F.col("kind") == ROW).where("sig = 0").select(F.col("id").alias("doc_id"))
    return full.union(empty.select("doc_id", F.lit(0).cast("long"), "doc_id"))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of every group of near duplicates one row stays, that with the smallest doc_id.

    Where doc_ids are null or repeated, rows are told apart by a stored number: exactly one row of a
    group stays, one with an id before one without, of equal ids any. Rows without a word are in no
    group and stay; all columns stay, whatever their names; an empty table gives no rows.
    """
    if docs.groupBy("doc_id").agg(F.count("*").alias("c")).where("doc_id IS NULL OR c > 1").isEmpty():
        gone = near_duplicates(docs).where(F.col("doc_id") != F.col("component_id")).select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    number, = fresh(docs, "number")
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    groups = near_duplicates(rows.select(F.col(number).alias("doc_id"), "text"))
    names = rows.select(F.col(number).alias("row"), F.col("doc_id").alias("name"))
    first = F.struct(F.col("name").isNull().alias("x"), F.col("name").alias("y"), F.col("row").alias("z"))
    kept = (groups.join(names, groups["doc_id"] == names["row"]).groupBy("component_id")
            .agg(F.min(first).alias("first")).select(F.col("first.z").alias(number)))
    return rows.join(kept, number, "left_semi").select(docs.columns)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of similar documents over the whole table."""
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, o) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.o)
SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.o) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY d.doc_id"""
