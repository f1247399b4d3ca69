"""Conversation structure repair: lightest derivation of a well-formed dialogue by Knuth's agenda.

An item (rows read, state) says that the rows so far have been edited into a beginning of a
well-formed dialogue that left the grammar in that state. A deduction reads one row (keep, rerole,
delete) or inserts one; it adds its cost and appends its letter to the audit, so a conclusion is
never lighter than its premise and the order of premises is kept: of two derivations of an item at
equal cost neither audit begins the other, as rows read and cost follow from the letters. Items are popped by (cost,
audit), each is final when popped, and the search of a conversation ends with its goal item.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyguard.catalog.registry import table

BLOCK = 256
"""Rows of one search; a longer conversation hands the finished items at a block's end to the next."""

USER, ASSISTANT = "user", "assistant"
WHITE = " \t\n\v\f\r"
STOPS = "[.!?]"

START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
# The grammar (s?(ua)+)? as next states by role initial, and the costs of the edits.
GRAMMAR = [{"s": AFTER_SYSTEM, "u": AFTER_USER}, {"u": AFTER_USER}, {"a": AFTER_ASSISTANT}, {"u": AFTER_USER}]
WHOLE = (START, AFTER_ASSISTANT)
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3


# --- faults ----------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as the check damages them, and the dropped ones (``dropped``), which only name their conversation.

    crc32 of ``conv_id:turn`` modulo 20 (a null is one space) drops a row (0), empties its text (1),
    takes its full stops and the like (2), repeats it (3) or makes it the user's (4).
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"),
                                F.coalesce("text", blank).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    kind = F.col("kind")
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, USER).otherwise(F.col("role")).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.regexp_replace("text", STOPS, "")).otherwise(F.col("text")).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, dropped) with ``fault``: blank, duplicate, truncated or null.

    The rows of a conversation are in one partition, in order of turn (nulls first), role and text.
    One shuffle serves the search for earlier equal rows and the order.
    """
    def without_end(text: Column) -> Column:
        return F.rtrim(text, F.lit(WHITE))

    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    earlier = F.row_number().over(Window.partitionBy("conv_id", "role", "text", "dropped").orderBy(
        F.col("turn").asc_nulls_first())) > 1
    trimmed = without_end(F.col("text"))
    fault = (F.when(F.col("dropped"), None).when(trimmed == "", "blank").when(earlier, "duplicate")
             .when(~F.right(trimmed, F.lit(1)).rlike(STOPS), "truncated"))
    return (rows.repartition("conv_id").withColumn("fault", fault)
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("dropped").desc(), *order))


# --- lightest derivations ---------------------------------------------------------------------

def lightest(rows: list[tuple[str, str | None]], axioms: dict[int, tuple[int, str]], goals: tuple[int, ...],
             every: bool) -> dict[int, tuple[int, str, int]]:
    """Lightest items at the end of ``rows`` ((role initial, fault) each) in one of the states ``goals``.

    ``axioms`` are the states at the beginning with their (cost, audit). Returned are, for the first
    goal popped, or for ``every`` goal, (cost, audit, beginning state).
    """
    agenda = [(cost, audit, 0, state, state) for state, (cost, audit) in axioms.items()]
    agenda.sort()
    final: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str, int]] = {}
    end = len(rows)
    while agenda:
        cost, audit, read, state, origin = heappop(agenda)
        if (read, state) in final:
            continue
        final.add((read, state))
        if read == end and state in goals:
            found[state] = cost, audit, origin
            if not every or len(found) == len(goals):
                break
        step = GRAMMAR[state]
        into = step.get("u") or step["a"]                      # the state after a user's or an assistant's turn
        heappush(agenda, (cost + INSERT, audit + "I", read, into, origin))
        if read < end:
            initial, fault = rows[read]
            heappush(agenda, (cost + DELETE, audit + "D", read + 1, state, origin))
            if fault not in ("blank", "duplicate"):
                more = CUT if fault == "truncated" else 0
                if initial in step:
                    heappush(agenda, (cost + KEEP + more, audit + "K", read + 1, step[initial], origin))
                heappush(agenda, (cost + REROLE + more, audit + "R", read + 1, into, origin))
    return found


def ranks(audits: dict[int, str]) -> dict[int, str]:
    """A short stand-in for every audit that sorts as it does, whatever letters follow.

    Without their last inserts no audit begins another, as all have read the same rows: their order
    stands for them.
    """
    bare = {state: audit.rstrip("I") for state, audit in audits.items()}
    order = {audit: str(i) for i, audit in enumerate(sorted(set(bare.values())))}
    return {state: order[bare[state]] + audit[len(bare[state]):] for state, audit in audits.items()}


def repaired(rows: list[tuple[str, str]], letters: str, state: int) -> Iterator[tuple[str, str]]:
    """(role, text) of the rows that the edits ``letters`` make of ``rows``, from ``state`` on."""
    source = iter(rows)
    for letter in letters:
        if letter == "D":
            next(source)
            continue
        role, text = ("", "") if letter == "I" else next(source)
        if letter in "IR":
            role = USER if "u" in GRAMMAR[state] else ASSISTANT
        state = GRAMMAR[state][role[0]]
        yield role, text


class _Conversation:
    """Counts, items and hashes of one conversation while its rows go by in order, a block at a time."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.initial = None
        self.axioms = {START: (0, "")}
        self.audits: dict[int, tuple | None] = {START: None}   # (audit of the blocks before, own letters)
        self.digests = {START: (hashlib.sha256(), False)}
        self.block: list[tuple[str, str, str | None]] = []

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if len(self.block) == BLOCK:
            self._search(False)
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        self.block.append((role, text, fault))

    def _search(self, last: bool) -> None:
        """Items at the end of the block, with a hash of what each makes of the rows so far."""
        found = lightest([(role[:1], fault) for role, _, fault in self.block], self.axioms,
                         WHOLE if last else tuple(range(len(GRAMMAR))), not last)
        texts = [(role, text) for role, text, _ in self.block]
        digests, audits = {}, {}
        for state, (_, audit, origin) in found.items():
            letters = audit[len(self.axioms[origin][1]):]
            digest, begun = self.digests[origin]
            digest = digest.copy()
            for role, text in repaired(texts, letters, origin):
                digest.update(f"{chr(10) * begun}{role}:{text}".encode())
                begun = True
            digests[state], audits[state] = (digest, begun), (self.audits[origin], letters)
        short = ranks({state: audit for state, (_, audit, _) in found.items()})
        self.axioms = {state: (cost, short[state]) for state, (cost, _, _) in found.items()}
        self.digests, self.audits, self.block = digests, audits, []

    def result(self) -> tuple:
        self._search(True)
        (state, (cost, _)), = self.axioms.items()
        letters, link = [], self.audits[state]
        while link:
            link, own = link
            letters.append(own)
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(reversed(letters)),
                self.digests[state][0].hexdigest())


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_TYPES = [pa.int64()] * 6 + [pa.string()] * 2


def _repairs(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    keys, results = [], []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*results)) if results else [[]] * len(COLUMNS)
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), *(pa.array(c, t) for c, t in zip(columns, _TYPES))],
                                          ["conv_id", *COLUMNS])

    size = 0
    for conv, own in groupby(rows(), key=lambda row: row[0]):
        conversation = _Conversation()
        for _, turn, role, text, dropped, fault in own:
            if not dropped:
                conversation.add(turn, role, text, fault)
        keys.append(conv)
        results.append(conversation.result())
        size += 64 + len(results[-1][-2])
        if size > 1 << 20:
            yield batch()
            keys, results, size = [], [], 0
    yield batch()


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    ``rows`` has conv_id, turn, role, text and ``dropped`` (true for rows that only name their
    conversation). Rows go by turn, nulls first, then role and text. gaps are turn numbers that are
    missing, illegal neighbouring roles whose initials are not su, ua or au. The repair keeps (K),
    reroles (R), deletes (D) and inserts (I) so that the role initials are nothing or ``s``, if any,
    and pairs ``ua``; it is the cheapest, then the one with the smallest audit. repaired_sha256 is
    over its ``role:text`` lines.

    A conversation is streamed in blocks of rows, so one of any length needs the memory of a block
    and its audit; equal rows are one row and its duplicates. An empty role has no initial and can
    not be kept; null conv_ids are one conversation; a conversation of dropped rows alone has zeros,
    an empty audit and the hash of nothing; other columns are not looked at; an empty table gives no
    rows. Null roles and texts are taken as one space.
    """
    own = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                      F.coalesce("text", F.lit(" ")).alias("text"), "dropped")
    placed = with_faults(own).select("conv_id", "turn", "role", "text", "dropped", "fault")
    kind = rows.schema["conv_id"].dataType
    schema = ", ".join([f"conv_id {kind.simpleString()}", *(f"{c} long" for c in COLUMNS[:6]),
                        "audit string", "repaired_sha256 string"])
    return placed.mapInArrow(partial(_repairs, kind=to_arrow_type(kind)), schema)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every conversation of the whole damaged table."""
    return repair(damaged(table(spark, sf_dir, "conversations")))


# --- the same in SQL ---------------------------------------------------------------------------

def sql_crc(text: str) -> str:
    """crc32 of an expression of ASCII text and letters U+00C0-U+00FF, from a table made by its rule."""
    steps = []
    for i in range(256):
        for _ in range(8):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        steps.append(i)
    codes = (f"list_transform(string_split({text}, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] "
             "ELSE [195::BIGINT, ord(c)::BIGINT - 64] END)")
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, flatten({codes})), lambda a, x: "
            f"xor(a >> 8, ({steps})[xor(a & 255, x) + 1]::BIGINT)), 4294967295::BIGINT)")


def _sql_edit(state: str, letter: str, cost: str, line: str | None = None) -> str:
    """A state's value (cost, audit, text) after one edit; null stays null."""
    text = f"{state}.t" if line is None else f"CASE WHEN {state}.t IS NULL THEN {line} ELSE {state}.t || chr(10) || {line} END"
    return (f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}} END")


def _sql_kept(into: str, role: str, initial: str, *states: str) -> str:
    keeps = [f"CASE WHEN alive AND initial = '{initial}' THEN {_sql_edit(x, 'K', 'cut', 'line')} END" for x in states]
    roles = [f"CASE WHEN alive THEN {_sql_edit(x, 'R', '3 + cut', f'{chr(39)}{role}:{chr(39)} || text')} END"
             for x in states] if role else []
    return f"list_min([{', '.join([_sql_edit(into, 'D', '4'), *keeps, *roles])}])"


def _sql_filled(rows: str, columns: str) -> str:
    """``rows`` with the inserts that make a state's value less."""
    users = ", ".join(["s2", *(_sql_edit(x, "I", "3", "'user:'") for x in ("s0", "s1", "s3"))])
    value = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
    return (f"(SELECT {columns}, s0::{value} AS s0, s1::{value} AS s1, s2::{value} AS s2, "
            f"list_min([s3, {_sql_edit('s2', 'I', '3', chr(39) + 'assistant:' + chr(39))}])::{value} AS s3 "
            f"FROM (SELECT {columns}, s0, s1, list_min([{users}]) AS s2, s3 FROM {rows}))")


_NONE = "NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
_BEGIN = (f"(SELECT g, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': NULL::VARCHAR}} AS s0, {_NONE} AS s1, "
          f"{_NONE} AS s2, {_NONE} AS s3 FROM ids)")
_READ = f"""(SELECT r.g, f.i, {_sql_edit('s0', 'D', '4')} AS s0, {_sql_kept('s1', '', 's', 's0')} AS s1,
    {_sql_kept('s2', 'user', 'u', 's0', 's1', 's3')} AS s2, {_sql_kept('s3', 'assistant', 'a', 's2')} AS s3
  FROM r JOIN f ON f.g = r.g AND f.i = r.i + 1)"""

ORACLE = f"""
WITH RECURSIVE ids AS (SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
c AS (SELECT g, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {sql_crc("coalesce(x.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k
      FROM conversations x JOIN ids ON ids.conv_id IS NOT DISTINCT FROM x.conv_id),
d AS (SELECT g, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
        CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM c, (SELECT unnest([1, 2]) AS copy) WHERE k <> 0 AND (copy = 1 OR k = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS i,
        rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM d),
q AS (SELECT *, left(role, 1) AS initial, role || ':' || text AS line, CASE WHEN body = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) || left(role, 1) AS pair FROM o),
f AS (SELECT *, fault IS NULL OR fault = 'truncated' AS alive, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS cut FROM q),
n AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS size,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM f GROUP BY g),
r AS (SELECT * FROM {_sql_filled(_BEGIN, 'g, i')} UNION ALL SELECT * FROM {_sql_filled(_READ, 'g, i')}),
e AS (SELECT r.g, list_min([s0, s3]) AS best FROM r LEFT JOIN n ON n.g = r.g WHERE r.i = coalesce(size, 0))
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit, sha256(coalesce(best.t, '')) AS repaired_sha256
FROM ids JOIN e ON e.g = ids.g LEFT JOIN n ON n.g = ids.g"""
