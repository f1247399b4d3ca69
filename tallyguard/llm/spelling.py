"""Spelling variant grouping: words one edit apart, found by a frontier over a relational trie.

A trie node is the hash of a beginning of a word. The zero-edit states of a word are its own path; a
state that has spent its edit must follow the rest of its word exactly, along rows of an edge table.
An edge reads as many characters as the greatest power of two that is left, so a word of any length
ends after a few levels. The beginnings and, in a second trie, the ends of words are searched: one of
two words an edit apart shares half of its characters on one side, so no state begins above the
middle of its word, where the trie is wide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyguard.catalog.registry import table
from tallyguard.llm.repair import sql_crc
from tallyguard.session import stored

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, TIMES, SLIP = 6, 5, 5, 199


def counted_words(docs: DataFrame, slip: int | None = SLIP, least_length: int = LEAST_LENGTH,
                  least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of all texts that are long and frequent enough.

    Words are runs of letters (A-Z and U+00C0 to U+00FF), A-Z as a-z. Where ``slip`` divides the
    crc32 of ``doc_id:run``, the run loses the code point at that number modulo its length; with
    ``slip`` None words stay as they are.
    """
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(RUN), F.lit(0))
    runs = docs.select("doc_id", F.explode(found).alias("run"))
    runs = runs.where(F.length("run") >= least_length).select("doc_id", F.translate("run", UPPER, LOWER).alias("word"))
    if slip is not None:
        name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "word")
        runs = runs.withColumn("h", F.crc32(name.cast("binary")))
        runs = runs.withColumn("word", F.when(F.col("h") % slip == 0, F.expr(
            "concat(substring(word, 1, cast(h % length(word) as int)), substring(word, cast(h % length(word) as int) + 2))"))
            .otherwise(F.col("word")))
    return (runs.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least_count))


# --- the trie --------------------------------------------------------------------------------

def stride(left: str) -> str:
    """SQL: characters an edge reads where ``left`` are left, the greatest power of two up to it, or 0."""
    return f"IF({left} = 0, 0, shiftleft(1, length(bin({left})) - 1))"


def both_ways(words: DataFrame) -> DataFrame:
    """(id, side, s) of every word and of its reverse, which is in the other trie."""
    return words.select(F.xxhash64("word").alias("id"), F.inline(F.array(
        F.struct(F.lit(0).alias("side"), F.col("word").alias("s")),
        F.struct(F.lit(1).alias("side"), F.reverse("word").alias("s")))))


def _node(depth: str) -> str:
    return f"xxhash64(side, substring(s, 1, {depth}))"


def edges(words: DataFrame, longest: int | None = None, near_middle: bool = False) -> DataFrame:
    """(id, key, target, side, rest) of the trie's edges, in one row for each word that runs through them.

    ``key`` stands for the node an edge leaves, the characters left there and those the edge reads,
    ``target`` for the node it enters, ``rest`` for the characters left then. Only nodes with at most
    ``longest`` characters left, or from the middle of the word on.
    """
    begin = "int((length(s) + 1) div 2)" if near_middle else f"greatest(0, length(s) - {int(longest)})"
    end = "length(s)" if near_middle else "length(s) - 1"
    rows = (both_ways(words).selectExpr("*", f"explode(sequence({begin}, {end})) AS depth")
            .selectExpr("*", "length(s) - depth AS left").selectExpr("*", f"{stride('left')} AS far"))
    return rows.selectExpr("id", f"xxhash64({_node('depth')}, left, substring(s, depth + 1, far)) AS key",
                           f"{_node('depth + far')} AS target", "side", "left - far AS rest")


def first_steps(words: DataFrame) -> DataFrame:
    """(id, key, target, side, rest, sign) of words that leave out one character, from their middle on.

    Read as a state it is a word that has spent its edit at that character and reads on; read as an
    edge it is the way of a word through the trie over any character ``sign`` and the next edge.
    """
    rows = (both_ways(words).selectExpr("*", "explode(sequence(int(length(s) div 2), length(s) - 1)) AS depth")
            .selectExpr("*", "length(s) - depth - 1 AS left").selectExpr("*", f"{stride('left')} AS far"))
    return rows.selectExpr("id", f"xxhash64({_node('depth')}, left, substring(s, depth + 2, far)) AS key",
                           f"{_node('depth + 1 + far')} AS target", "side", "left - far AS rest",
                           "ascii(substring(s, depth + 1, 1)) AS sign")


def terminal_states(words: DataFrame) -> DataFrame:
    """(id, side, node) of one-edit states at the end of their word.

    The first level reads the edit and the next edge in one join: a word that leaves out a character
    goes on along an edge (it deletes the character) or over another character and along an edge (it
    replaces it). An inserted character is one that the other word deletes. Every further level joins
    the states with the edge table, and each halves what is left at least.
    """
    steps = first_steps(words).unionByName(edges(words, near_middle=True).withColumn("sign", F.lit(None).cast("int")))
    shared = F.count("*").over(Window.partitionBy("key"))
    steps = stored(steps.withColumn("c", shared).where("c > 1").drop("c"), "steps")
    left, right = steps.where("sign IS NOT NULL").alias("l"), steps.alias("r")
    states = left.join(right, F.expr(
        "l.key = r.key AND l.id <> r.id AND (r.sign IS NULL OR l.sign <> r.sign AND l.id < r.id)")).selectExpr(
        "l.id", "l.side", "l.rest", "r.target AS node").distinct()
    done = None
    names = both_ways(words).select("id", "side", "s")
    while True:
        states = stored(states, "states")
        ended = states.where("rest = 0").select("id", "side", "node")
        done = ended if done is None else done.union(ended)
        open_ = states.where("rest > 0")
        longest = open_.agg(F.max("rest")).first()[0]
        if longest is None:
            return done
        wanted = open_.join(names, ["id", "side"]).selectExpr(
            "id", "side", f"xxhash64(node, rest, substring(s, length(s) - rest + 1, {stride('rest')})) AS key")
        ways = edges(words, longest).select("key", "target", "rest").distinct()
        states = wanted.join(ways, "key").selectExpr("id", "side", "rest", "target AS node").distinct()


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of every word and each word that one inserted, deleted or replaced code point makes of it."""
    found = terminal_states(words)
    own = words.select(F.xxhash64("word").alias("id"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    other = both_ways(words.select("word")).select("side", F.expr(_node("length(s)")).alias("node"), F.when(
        F.col("side") == 0, F.col("s")).otherwise(F.reverse("s")).alias("b")).join(
        words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    pairs = (found.join(own, "id").join(other, ["side", "node"])
             .where(F.levenshtein("a", "b", 1) == 1)          # two hashes may be equal
             .selectExpr("a AS word", "a_n AS n", "b AS near", "b_n AS near_n"))
    return pairs.unionByName(pairs.selectExpr("near AS word", "near_n AS n", "word AS near", "n AS near_n")).distinct()


def followed(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): where following forms from a word ends.

    Every round doubles how far each word looks; forms are more frequent than their words, so there is no ring.
    """
    ways = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("then"))
        ways = stored(ways.join(further, "root", "left").select("word", F.coalesce("then", "root").alias("root"),
                                                                F.col("then").isNotNull().alias("moved")), "forms")
        if ways.where("moved").isEmpty():
            return ways.select("word", "root")
        ways = ways.drop("moved")


def spelling_variants(docs: DataFrame, slip: int | None = None, times: int = TIMES, least_length: int = LEAST_LENGTH,
                      least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``.

    ``n_near`` words are one inserted, deleted or replaced code point away; ``form`` is the most
    frequent of them (ties: the smallest in code-point order), if it is ``times`` as frequent as the
    word, else null; ``root`` is where the forms lead from the word. ``slip``, ``least_length`` and
    ``least_count`` are those of ``counted_words``. Null and empty texts have no words; a null doc_id
    is named by nothing; repeated rows count each; a run of any length is a word; other columns are
    not looked at; an empty table gives no rows.
    """
    words = stored(counted_words(docs, slip, least_length, least_count), "words")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(
        (-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    is_form = -F.col("best.less") >= times * F.col("n")
    found = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "near")
    roots = followed(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                                                    "form_n")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants among the words of the whole table, with slips of the pen put in."""
    return spelling_variants(table(spark, sf_dir, "documents"), slip=SLIP)


ORACLE = rf"""
WITH RECURSIVE o AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
        '{UPPER}', '{LOWER}') AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS c FROM o WHERE length(run) >= 6 GROUP BY doc_id, run),
h AS (SELECT *, {sql_crc("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM d),
s AS (SELECT CASE WHEN h % 199 = 0 THEN run[1:(h % length(run))::INT] || run[(h % length(run))::INT + 2:] ELSE run END AS word,
        c FROM h),
w AS (SELECT word, sum(c)::BIGINT AS n FROM s WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
x AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest
      FROM (SELECT word, n, unnest(range(0, length(word) + 1)) AS i FROM w) WHERE i > 0
      UNION ALL SELECT word, n, 0, word FROM w),
y AS (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM x a JOIN x b ON a.rest = b.rest AND a.word <> b.word
      WHERE a.i = b.i OR length(a.word) <> length(b.word)),
z AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM y GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form,
        CASE WHEN form_n >= 5 * n THEN form_n END AS form_n FROM w LEFT JOIN z USING (word)),
r(word, root, more) AS (SELECT word, word, TRUE FROM f UNION ALL
  SELECT r.word, f.form, f.form IS NOT NULL FROM r JOIN f ON f.word = r.root WHERE r.more AND f.form IS NOT NULL),
t AS (SELECT r.word, r.root FROM r JOIN f ON f.word = r.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM f JOIN t USING (word)"""
