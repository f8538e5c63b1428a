"""Conversation structure repair by weighted CYK interval parsing.

A conversation is well formed if its turns' roles read ``(s?(ua)+)?`` by their
initials: an optional system turn, then pairs of user and assistant. Each row may
be kept (K, free), given another role (R, 2) or deleted (D, 3), and empty turns may
be inserted anywhere (I, 2); a row that ends without a full stop costs 1 more if
it stays, and blank or repeated rows must go.

The grammar is in Chomsky normal form. Its nonterminals are ``[p, q]`` for places
p and q of the role pattern: "what stands here leads from p to q". The rules are
``[p, q] -> [p, r] [r, q]``, and the terminals are the edits of a row. The cell of
a span holds for each nonterminal the least ``(cost, audit)``, the audit being the
edits' initials in order; every cell is closed under insertion, that is, it also
holds what insertions before and after its rows lead to. Spans are combined
bottom-up by length. As any derivation of ``[p, q]`` over a span can be split
between any two of its rows, one split of a span gives its cell, and a span's
halves may be parsed apart: conversations of any length are cut into segments that
different tasks parse, whose cells are then combined.

Least audits may be combined part by part: of two audits of one span, nonterminal
and cost none begins with the other (what follows would be insertions, which cost),
so they differ at some place, and what comes before or after doesn't matter.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from textflow.llm.catalog import query
from textflow.llm.common import col, written
from textflow.plans.catalog import table

# The costs of the edits, and the places of the role pattern.
KEEP, REROLE, DELETE, INSERT, RAGGED = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
FINAL = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}   # of rows that get another role and of inserted ones
# A row's class, one sign: its role's initial (x: any other), sound, ragged or to be deleted.
SOUND, LOST = "suax", "1234"

SEGMENT_ROWS = 4096     # rows that are parsed in one piece, at most (a power of two)
MEMO_ROWS = 16          # spans up to this many rows are remembered within a task
_BLANK = r"^[\x20\x09-\x0D]*\z"
_RAGGED = r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z"

Cell = dict[tuple[int, int], tuple[int, str]]


# -- the chart ---------------------------------------------------------------

def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans: ``[p, q] -> [p, r] [r, q]``."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for (r2, q), (more, rest) in right.items():
            if r == r2:
                total = cost + more
                best = out.get((p, q))
                if best is None or total < best[0] or (total == best[0] and audit + rest < best[1]):
                    out[p, q] = (total, audit + rest)
    return out


def _insertions() -> Cell:
    """The cell of the empty span: chains of insertions, the shortest of each kind."""
    chain: Cell = {(p, p): (0, "") for p in range(4)}
    one: Cell = {(p, q): (INSERT, "I") for role in ROLES for p, q in NEXT[role].items()}
    for _ in range(4):
        chain = _least(chain, combined(chain, one))
    return chain


def _least(a: Cell, b: Cell) -> Cell:
    return {k: min(c[k] for c in (a, b) if k in c) for k in {*a, *b}}


EMPTY = _insertions()


@lru_cache(maxsize=None)
def leaf(kind: str) -> Cell:
    """The cell of a row of class ``kind``, closed under insertion."""
    edits: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if kind not in LOST:
        extra = RAGGED if kind.isupper() else 0
        for role in ROLES:
            edits = _least(edits, {(p, q): (REROLE + extra, "R") for p, q in NEXT[role].items()})
        edits = _least(edits, {(p, q): (KEEP + extra, "K") for p, q in NEXT.get(kind.lower(), {}).items()})
    return combined(combined(EMPTY, edits), EMPTY)


def parsed(kinds: str) -> Cell:
    """The cell of a span of rows, from those of shorter spans."""
    if len(kinds) <= MEMO_ROWS:
        return _short(kinds)
    half = 1 << (len(kinds) - 1).bit_length() - 1
    return combined(parsed(kinds[:half]), parsed(kinds[half:]))


@lru_cache(maxsize=1 << 16)
def _short(kinds: str) -> Cell:
    if len(kinds) < 2:
        return leaf(kinds) if kinds else EMPTY
    half = 1 << (len(kinds) - 1).bit_length() - 1
    return combined(_short(kinds[:half]), _short(kinds[half:]))


def chosen(cells: list[Cell]) -> tuple[int, str, list[tuple[int, str]]]:
    """Cost and audit of neighbouring spans that make up a conversation, and for each
    of them the place of the pattern that it starts at and its part of the audit."""
    levels = [cells or [EMPTY]]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([combined(*row[k:k + 2]) if k + 1 < len(row) else row[k] for k in range(0, len(row), 2)])
    top = levels[-1][0]
    best, end = min((top[START, q], q) for q in FINAL if (START, q) in top)
    wanted = [(START, end)]
    for below, above in zip(levels[-2::-1], levels[:0:-1]):   # from the top: through which place each pair went
        split = []
        for k, (p, q) in enumerate(wanted):
            if 2 * k + 1 == len(below):
                split.append((p, q))
                continue
            left, right = below[2 * k], below[2 * k + 1]
            cost, audit = above[k][p, q]
            r = next(r for r in range(4) if (p, r) in left and (r, q) in right
                     and left[p, r][0] + right[r, q][0] == cost and left[p, r][1] + right[r, q][1] == audit)
            split += [(p, r), (r, q)]
        wanted = split
    return best[0], best[1], [(p, cell[p, q][1]) for cell, (p, q) in zip(levels[0], wanted)]


def edits(kinds: str, start: int, audit: str) -> list[tuple[int, str, int]]:
    """``(row, role, place)`` of the turns that an audit of a span leaves or makes, from
    the pattern's place ``start``: the row's number (-1: inserted), the role's initial,
    and whether it is a new one (1) or the row's own (0)."""
    out, row, at = [], 0, start
    for edit in audit:
        if edit == "K":
            role = kinds[row].lower()
        else:
            role = "a" if at == USER else "u"
        if edit != "D":
            at = NEXT[role][at]
            out.append((-1 if edit == "I" else row, role, int(edit != "K")))
        row += edit != "I"
    return out


# -- the operator ------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` of conversations with faults put in by the crc32
    of ``conv_id:turn``, modulo 20: 0 drops the row, 1 empties its text, 2 takes its
    ``.``, ``!`` and ``?`` out, 3 repeats it, 4 makes it the user's. Nulls count as one
    space (a null turn stays null); other columns are left out."""
    space = F.lit(" ")
    conv, turn = col(conversations, "conv_id"), col(conversations, "turn")
    key = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    rows = conversations.select(
        conv.alias("conv_id"), turn.alias("turn"), F.coalesce(col(conversations, "role").cast("string"), space).alias("role"),
        F.coalesce(col(conversations, "text").cast("string"), space).alias("text"), (F.crc32(key) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("fault") == 3, 2).otherwise(1)
    return rows.where("fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")


def ordered(turns: DataFrame) -> DataFrame:
    """The rows with ``at``, a number that ascends in the order of conversations and of
    the turns within (consecutive within a task), and the row's signs: a conversation
    may lie in many tasks.

    Turns follow each other by ``turn`` (null first), ties by role, the first 64
    characters, then a hash of the text; ``id`` identifies equal role and text."""
    space = F.lit(" ")
    role, text = (F.coalesce(col(turns, c).cast("string"), space) for c in ("role", "text"))
    rows = turns.select(col(turns, "conv_id").alias("conv_id"), col(turns, "turn").cast("long").alias("turn"),
                        role.alias("role"), text.alias("text"))
    same = F.unhex(F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    # the number only parts equal rows, so that many of them need not go to one task
    keyed = written(rows.select("*", same.alias("id"), F.monotonically_increasing_id().alias("copy")), "turns")
    by = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"),
          F.substring("text", 1, 64), F.col("id"), F.col("copy")]
    initial = F.substring("role", 1, 1)
    sorted_rows = keyed.repartitionByRange(*by).sortWithinPartitions(*by)
    return written(sorted_rows.select(
        "conv_id", "turn", "role", "text", "id", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        F.col("text").rlike(_BLANK).alias("blank"), F.col("text").rlike(_RAGGED).alias("ragged"),
        F.monotonically_increasing_id().alias("at")), "ordered-turns")


_INT, _LONG, _TEXT = T.IntegerType(), T.LongType(), T.StringType()
_ENTRIES = T.ArrayType(T.StructType().add("p", _INT).add("q", _INT).add("cost", _LONG).add("audit", _TEXT))
_CHOICE = T.StructType().add("cost", _LONG).add("audit", _TEXT).add(
    "parts", T.ArrayType(T.StructType().add("start", _INT).add("audit", _TEXT)))
_EDITS = T.ArrayType(T.StructType().add("row", _INT).add("role", _TEXT).add("new", _INT))


@pandas_udf(_ENTRIES)
def _cells(kinds: pd.Series) -> pd.Series:
    return pd.Series([[{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in parsed(k).items()] for k in kinds])


@pandas_udf(_CHOICE)
def _choices(cells: pd.Series) -> pd.DataFrame:
    rows = []
    for listed in cells:
        cost, audit, parts = chosen([{(e["p"], e["q"]): (e["cost"], e["audit"]) for e in s["cell"]} for s in listed])
        rows.append((cost, audit, [{"start": p, "audit": a} for p, a in parts]))
    return pd.DataFrame(rows, columns=["cost", "audit", "parts"])


@pandas_udf(_EDITS)
def _edits(kinds: pd.Series, start: pd.Series, audit: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(("row", "role", "new"), e)) for e in edits(*row)] for row in zip(kinds, start, audit)])


@dataclass(frozen=True)
class Repair:
    """``report``: a row for each conversation; ``turns``: the repaired conversations,
    ``(conv_id, segment, place, role, text)``, in order by segment and place."""

    report: DataFrame
    turns: DataFrame


def repair(turns: DataFrame) -> Repair:
    """Conversations ``(conv_id, turn, role, text)`` with the cheapest edits that make
    them well formed.

    A null role or text counts as one space; rows with a null ``conv_id`` are one
    conversation; turns may be missing, null or repeated (see ``ordered``). A row's
    first fault counts: blank, duplicate (role and text seen earlier), truncated.
    A role of no known initial can't be kept. Other columns are ignored; texts are
    never looked at beyond their faults, so their length doesn't matter; an empty
    table gives empty ones."""
    rows = ordered(turns)
    seen = rows.groupBy("conv_id", "id").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    seen = written(seen.select(F.col("conv_id").alias("of"), F.col("id").alias("of_id"), "first"), "repeated-turns")
    narrow = rows.select("conv_id", "turn", "id", "initial", "blank", "ragged", "at").join(
        seen, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("id") == F.col("of_id")), "left")
    again = ~F.col("blank") & F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    ragged = ~F.col("blank") & ~again & F.col("ragged")
    kind = F.when(F.col("blank") | again, F.translate("initial", SOUND, LOST)).when(
        ragged, F.upper("initial")).otherwise(F.col("initial"))
    marked = narrow.select("conv_id", "turn", "at", "initial", "blank", again.alias("again"), ragged.alias("ragged"), kind.alias("kind"))
    segment = F.shiftright("at", SEGMENT_ROWS.bit_length() - 1)

    def strung(what: str) -> Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", what))), lambda s: s[what]), "")

    # at most SEGMENT_ROWS rows a group; the turns' own figures are plain sums
    parts = written(marked.withColumn("segment", segment).groupBy("conv_id", "segment").agg(
        strung("kind").alias("kinds"), strung("initial").alias("initials"), F.min("at").alias("at"),
        *[F.count_if(c).alias(c) for c in ("blank", "again", "ragged")], F.min("turn").alias("low"), F.max("turn").alias("high")),
        "repair-segments")
    celled = parts.select("conv_id", "segment", _cells("kinds").alias("cell"))
    whole = celled.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("segment", "cell"))).alias("cells"))
    choice = written(whole.select("conv_id", F.transform("cells", lambda s: s["segment"]).alias("segments"),
                                  _choices("cells").alias("c")).select("conv_id", "segments", "c.*"), "repair-choices")
    return Repair(_report(parts, rows, choice), _repaired(parts, rows, choice))


def _report(parts: DataFrame, rows: DataFrame, choice: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)``."""
    order = Window.partitionBy("conv_id").orderBy("segment")
    last = F.lag(F.substring("initials", -1, 1)).over(order)   # a row for each segment of a conversation
    joined = F.concat(F.coalesce(last, F.lit("")), F.col("initials"))
    # neighbours that may follow each other, overlapping: a look-ahead matches at each
    illegal = F.char_length(joined) - 1 - F.regexp_count(joined, F.lit("(?=su|ua|au)"))
    sums = parts.withColumn("illegal", illegal).groupBy("conv_id").agg(
        *[F.sum(c).alias(n) for c, n in (("blank", "blank"), ("again", "duplicate"), ("ragged", "truncated"), ("illegal", "illegal"))],
        F.min("low").alias("low"), F.max("high").alias("high"))
    turns = rows.where("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("turns")).withColumnRenamed("conv_id", "of")
    span = F.try_add(F.try_subtract("high", "low"), F.lit(1) - F.coalesce(F.col("turns"), F.lit(0)))
    all_sums = sums.join(turns, sums["conv_id"].eqNullSafe(turns["of"]), "left").drop("of")
    priced = choice.select(F.col("conv_id").alias("of"), "cost", "audit")
    return all_sums.join(priced, all_sums["conv_id"].eqNullSafe(priced["of"])).select(
        "conv_id", F.when(F.col("high").isNull(), F.lit(0)).otherwise(span).cast("long").alias("gaps"),
        *[F.col(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], "audit")


def _repaired(parts: DataFrame, rows: DataFrame, choice: DataFrame) -> DataFrame:
    slices = choice.select("conv_id", F.explode(F.arrays_zip("segments", "parts")).alias("z")).select(
        F.col("conv_id").alias("of"), F.col("z.segments").alias("of_segment"), F.col("z.parts.start").alias("start"),
        F.col("z.parts.audit").alias("audit"))
    at = parts["conv_id"].eqNullSafe(F.col("of")) & (F.col("segment") == F.col("of_segment"))
    turns = parts.join(slices, at).select("conv_id", "segment", "at", F.posexplode(_edits("kinds", "start", "audit")).alias("place", "e"))
    turns = turns.select("conv_id", "segment", "place", (F.col("at") + F.col("e.row")).alias("of_at"), "e.row",
                         F.col("e.role").alias("initial"), F.col("e.new").alias("new"))
    name = F.when(F.col("initial") == "u", ROLES["u"]).otherwise(ROLES["a"])
    put_in = turns.where("row < 0").select("conv_id", "segment", "place", name.alias("role"), F.lit("").alias("text"))
    texts = rows.select("at", "role", "text")   # numbers are unique: no key of this join is hot
    stay = turns.where("row >= 0").join(texts, F.col("of_at") == F.col("at")).select(
        "conv_id", "segment", "place", F.when(F.col("new") == 1, name).otherwise(F.col("role")).alias("role"), "text")
    return stay.unionByName(put_in)


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The digest of each conversation's ``role:text`` lines, which come in order."""
    now, digest, first = None, None, True
    for batch in batches:
        out = []
        for conv, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
            if digest is None or conv != now:
                if digest is not None:
                    out.append((now, digest.hexdigest()))
                now, digest, first = conv, hashlib.sha256(), True
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False
        if out:
            yield pd.DataFrame(out, columns=["conv_id", "sha256"])
    if digest is not None:
        yield pd.DataFrame([(now, digest.hexdigest())], columns=["conv_id", "sha256"])


def digests(turns: DataFrame) -> DataFrame:
    """``(conv_id, sha256)`` of repaired conversations. A digest runs over a whole
    conversation, so one task reads it, a turn at a time."""
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "place")
    texts = dealt.select(F.col("conv_id").cast("string").alias("conv_id"), "role", "text")   # nulls make floats of numbers
    hashed = texts.mapInPandas(_hashed, "conv_id string, sha256 string")
    return hashed.select(F.col("conv_id").cast(turns.schema["conv_id"].dataType).alias("conv_id"), "sha256")


_WS = r"\x20\x09-\x0D"
OP11_SQL = rf"""
WITH RECURSIVE crc AS (  -- the table of CRC-32, by its polynomial
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
         lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS t),
faulty AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(
           string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
           lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]))) % 20 AS fault
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role, copy,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM faulty)),
judged AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
         NOT regexp_matches(text, '[^{_WS}]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         regexp_matches(text, '[^{_WS}.!?][{_WS}]*\z') AS ragged FROM damaged),
marked AS (
  SELECT conv_id, turn, role, text, n, role[1] AS i, blank, again AND NOT blank AS again, ragged AND NOT again AND NOT blank AS ragged,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY n) || role[1] NOT IN ('su', 'ua', 'au') AS illegal FROM judged),
told AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE again) AS duplicate, count(*) FILTER (WHERE ragged) AS truncated,
         count(*) FILTER (WHERE illegal) AS illegal, count(*) AS rows FROM marked GROUP BY conv_id),
put (p, q, c, a, o) AS (  -- insertions from a place of the role pattern to another
  SELECT p, p, 0, '', CAST([] AS VARCHAR[]) FROM range(4) r(p) UNION ALL VALUES
  (0, 2, {INSERT}, 'I', ['user:']), (1, 2, {INSERT}, 'I', ['user:']), (3, 2, {INSERT}, 'I', ['user:']), (2, 3, {INSERT}, 'I', ['assistant:']),
  (0, 3, {2 * INSERT}, 'II', ['user:', 'assistant:']), (1, 3, {2 * INSERT}, 'II', ['user:', 'assistant:'])),
edit (p, q, c, a, i, o) AS (  -- what a row may do: its initial if it is kept, its role if it is new
  SELECT p, p, {DELETE}, 'D', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM range(4) r(p) UNION ALL VALUES
  (0, 1, {KEEP}, 'K', 's', NULL), (0, 2, {KEEP}, 'K', 'u', NULL), (1, 2, {KEEP}, 'K', 'u', NULL), (3, 2, {KEEP}, 'K', 'u', NULL),
  (2, 3, {KEEP}, 'K', 'a', NULL), (0, 2, {REROLE}, 'R', NULL, 'user'), (1, 2, {REROLE}, 'R', NULL, 'user'),
  (3, 2, {REROLE}, 'R', NULL, 'user'), (2, 3, {REROLE}, 'R', NULL, 'assistant')),
chart AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS p, row(CAST(0 AS BIGINT), '') AS best, CAST([] AS VARCHAR[]) AS lines FROM told
  UNION ALL
  SELECT conv_id, n, p, min(best), arg_min(lines, best) FROM (
    SELECT h.conv_id, m.n, CAST(e.q AS BIGINT) AS p,
           row(CAST(h.best[1] + u.c + e.c + CASE WHEN m.ragged AND e.a <> 'D' THEN {RAGGED} ELSE 0 END AS BIGINT), h.best[2] || u.a || e.a) AS best,
           list_concat(h.lines, u.o, CASE e.a WHEN 'D' THEN [] ELSE [coalesce(e.o, m.role) || ':' || m.text] END) AS lines
    FROM chart h JOIN marked m ON m.conv_id = h.conv_id AND m.n = h.n + 1 JOIN put u ON u.p = h.p JOIN edit e ON e.p = u.q
    WHERE e.a = 'D' OR NOT (m.blank OR m.again) AND (e.i IS NULL OR e.i = m.i)) GROUP BY conv_id, n, p),
ended AS (
  SELECT t.conv_id, row(h.best[1] + u.c, h.best[2] || u.a) AS best, list_concat(h.lines, u.o) AS lines
  FROM told t JOIN chart h ON h.conv_id = t.conv_id AND h.n = t.rows JOIN put u ON u.p = h.p WHERE u.q IN (0, 3)),
least_ones AS (SELECT conv_id, min(best) AS best, arg_min(lines, best) AS lines FROM ended GROUP BY conv_id)
SELECT c.conv_id, {', '.join(f'CAST(coalesce({x}, 0) AS BIGINT) AS {x}' for x in ('gaps', 'blank', 'duplicate', 'truncated', 'illegal'))},
       CAST(coalesce(l.best[1], 0) AS BIGINT) AS cost, coalesce(l.best[2], '') AS audit,
       sha256(coalesce(array_to_string(l.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN told t ON t.conv_id = c.conv_id LEFT JOIN least_ones l ON l.conv_id = c.conv_id
"""


@query("op11_conversation_repair", OP11_SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = repair(damage(conversations))
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    hashes = digests(fixed.turns).select(F.col("conv_id").alias("of"), "sha256")
    told = fixed.report.join(hashes, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(told, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
