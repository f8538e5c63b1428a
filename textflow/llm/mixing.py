"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order that depends on their
ids alone. A document's virtual finish time is the number of its source's words
up to its end, divided by the source's target: a source that is served at its
target rate reaches its target at time 1. The mix is the global order of finish
times, cut where the total budget is used up. The targets add up to the budget,
so that is at time 1; a document in service then is taken up to that time. A
queue that is served to its end starts over, once at most: the second pass over a
document is a service of its own, that finishes its source's words later
(``passes`` lists them all in the mix's order).

The cumulative words of a source are prefix sums in two steps, so that no task
has to hold a source: sums by range of the shuffle order first (a bounded number
of ranges a source), then sums within a range, which start from the first ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textflow.llm.catalog import query
from textflow.llm.common import col, private_name, row_hash, written
from textflow.plans.catalog import table

WEIGHTS = (5.0, 2.0, 1.0)   # of the sources in order, repeating
BUDGET = 1.5                # of all words
MOST = 2.0                  # times a source's words that its target may be
SHUFFLE = "mix:7"           # seed of the shuffle
RANGE_DIGITS = 3            # hex digits of the shuffle key that make a range: 4,096 a source

_WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text (null: 0)."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(_WORD))).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources in code-point order, null last, weigh ``weights``, repeating, and
    share ``budget`` times all words; targets stop at ``most`` times their
    source's words and the excess is shared again by weight until none is above.
    What that ends in has a closed form: with the sources by ascending
    ``most * size / weight``, the first ones are at their limit, and the others
    share what is left by weight. One row a source is looked at."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("turn") - 1, F.lit(len(weights))) + 1).cast("int"))
    limit = F.lit(float(most)) * F.col("source_size")
    weighed = (sizes.withColumn("turn", F.row_number().over(order)).withColumn("weight", by_turn)
               .withColumn("limit", limit))
    level = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    rest = level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stepped = weighed.withColumn("ratio", F.col("limit") / F.col("weight")).withColumn(
        "share", (F.lit(float(budget)) * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        / F.sum("weight").over(rest))
    # the first source whose limit is above its share sets the share of all after it
    shared = F.first(F.when(F.col("ratio") >= F.col("share"), F.col("share")), ignorenulls=True).over(whole)
    return stepped.withColumn("common", shared).select(
        "source", "source_size",
        F.least(F.col("limit"), F.coalesce(F.col("common") * F.col("weight"), F.col("limit"))).alias("target"))


def _served(docs: DataFrame, p: dict, weights, budget: float) -> DataFrame:
    """``docs`` with private columns: the size, the source's words and target, and an
    array of the document's services ``(pass, finish, taken)``, those of no words left out."""
    doc_id, hashed = col(docs, "doc_id").cast("string"), row_hash(docs)
    # rows without an id are shuffled by their content, so that they don't stand together
    seed = F.concat(F.coalesce(doc_id, F.lit("")), F.lit(":" + SHUFFLE), F.when(doc_id.isNull(), F.concat(F.lit(":"), F.hex(hashed))).otherwise(""))
    queue = F.coalesce(F.concat(F.lit("="), col(docs, "source").cast("string")), F.lit(""))  # never null: an equi-join key
    sized = docs.withColumns({p["queue"]: queue, p["size"]: n_words(col(docs, "text").cast("string")), p["key"]: F.md5(seed), p["hash"]: hashed})
    sized = sized.withColumn(p["range"], F.substring(F.col(p["key"]), 1, RANGE_DIGITS))
    ranges = written(sized.groupBy(F.col(p["queue"]).alias("o_queue"), F.col(p["range"]).alias("o_range"))
                     .agg(F.sum(p["size"]).alias("words")), "mix-ranges")
    earlier = Window.partitionBy("o_queue").orderBy("o_range").rowsBetween(Window.unboundedPreceding, -1)
    source = F.when(F.col("o_queue") != "", F.expr("substring(o_queue, 2)"))
    sizes = ranges.groupBy("o_queue").agg(F.sum("words").alias("source_size")).select(source.alias("source"), "source_size")
    goals = targets(sizes, weights, budget).select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("o_queue"),
        F.col("source_size").alias("o_source_size"), F.col("target").alias("o_target"))
    offsets = ranges.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0))).join(goals, "o_queue").drop("words")
    # the row hash last: rows that it doesn't part are equal, so any order of them is the same
    within = Window.partitionBy(p["queue"], p["range"]).orderBy(p["key"], col(sized, "doc_id"), p["size"], p["hash"]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = sized.withColumn(p["upto"], F.sum(p["size"]).over(within))
    offsets = offsets.select(*[F.col(c).alias(p[n]) for c, n in (
        ("o_queue", "o_queue"), ("o_range", "o_range"), ("offset", "offset"), ("o_source_size", "total"), ("o_target", "goal"))])
    joined = summed.join(offsets, (F.col(p["queue"]) == F.col(p["o_queue"])) & (F.col(p["range"]) == F.col(p["o_range"])))
    stop = F.col(p["offset"]) + F.col(p["upto"])

    def service(number: int) -> Column:
        """A pass over the document: when it is finished, and the words of it that are
        served by time 1."""
        end = stop + F.lit(number - 1) * F.col(p["total"])
        done = F.floor(F.col(p["goal"])) - (end - F.col(p["size"]))
        return F.struct(F.lit(number).alias("pass"), F.try_divide(end, F.col(p["goal"])).alias("finish"),
                        F.greatest(F.lit(0), F.least(F.col(p["size"]), done)).cast("long").alias("taken"))

    services = F.filter(F.array(service(1), service(2)), lambda s: s["taken"] > 0)
    # a source without words has target 0: nothing of it is served, at no time
    return joined.withColumns({p["served"]: services, p["finish"]: F.try_divide(stop, F.col(p["goal"]))})


def _names(docs: DataFrame) -> dict:
    return {n: private_name(docs, n) for n in ("queue", "key", "hash", "range", "size", "upto", "o_queue", "o_range", "offset",
                                               "total", "goal", "served", "finish")}


def mix(docs: DataFrame, size: str = "size", source_size: str = "source_size", target: str = "target",
        taken: str = "taken", finish: str = "finish", weights=WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """``docs`` in the mix's order (global, by virtual finish time) with five more
    columns: the document's words, its source's, its source's target, the words
    the mix takes of it (both passes over it added up; 0 if it stays out) and the
    virtual finish time of its first pass.

    A null source is a source; a null text or one without words has size 0 and
    is never taken; rows that repeat an id are documents of their own, in the
    order of their sizes, then of a hash of the row (rows that are equal in all
    columns may take each other's place); rows without an id are shuffled by that
    hash; a source without words has target 0; texts of any length are counted
    whole; an empty table stays empty. No document is taken more than twice. A
    column of ``docs`` that is called like an added one gives way to it."""
    p = _names(docs)
    served = _served(docs, p, weights, budget)
    total = F.aggregate(F.col(p["served"]), F.lit(0).cast("long"), lambda sum_, s: sum_ + s["taken"])
    added = {size: F.col(p["size"]), source_size: F.col(p["total"]), target: F.col(p["goal"]),
             taken: total, finish: F.col(p["finish"])}
    kept = [c for c in docs.columns if c.lower() not in {n.lower() for n in added}]
    mixed = served.select(*[col(served, c).alias(c) for c in kept], *[e.alias(n) for n, e in added.items()])
    return mixed.orderBy(F.col(finish).asc_nulls_last())


def passes(docs: DataFrame, number: str = "pass", taken: str = "taken", finish: str = "finish",
           weights=WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """The mix itself: a row for each service of a document, in the order of virtual finish
    times, with the pass (1 or 2) and the words taken in it. Read in order, each source
    comes at its target rate, second passes included. Rows as in ``mix``."""
    p = _names(docs)
    served = _served(docs, p, weights, budget)
    services = served.withColumn(p["served"], F.explode(p["served"]))
    added = {number: F.col(p["served"])["pass"], taken: F.col(p["served"])["taken"], finish: F.col(p["served"])["finish"]}
    kept = [c for c in docs.columns if c.lower() not in {n.lower() for n in added}]
    return services.select(*[col(services, c).alias(c) for c in kept], *[e.alias(n) for n, e in added.items()]).orderBy(finish)


_SQL_SIZE = "len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))"
OP3_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, CAST({_SQL_SIZE} AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{SHUFFLE}') AS k FROM documents),
sources AS (
  SELECT source, source_size, n, [{', '.join(map(str, WEIGHTS))}][1 + (n - 1) % {len(WEIGHTS)}] AS weight,
         CAST({MOST} * source_size AS DOUBLE) AS cap
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n
        FROM docs GROUP BY source)),
rounds AS (  -- share what is left among the sources below their cap, again and again
  SELECT 0 AS step, n, weight, cap, CAST(0 AS DOUBLE) AS target, FALSE AS capped,
         {BUDGET} * (SELECT sum(source_size) FROM sources) AS budget FROM sources
  UNION ALL
  SELECT step + 1, n, weight, cap,
         CASE WHEN capped THEN cap ELSE least(cap, left_over * weight / open_weight) END,
         capped OR left_over * weight / open_weight >= cap, budget
  FROM (SELECT *, budget - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS left_over,
               sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS open_weight FROM rounds)
  WHERE step <= (SELECT count(*) FROM sources)),
goals AS (SELECT s.source, s.source_size, r.target FROM sources s
          JOIN rounds r ON r.n = s.n AND r.step = (SELECT max(step) FROM rounds)),
queued AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start FROM docs)
SELECT q.doc_id, q.size, g.source_size, round(g.target, 6) AS target,
       CAST(greatest(0, least(q.size, floor(g.target) - q.start)) + greatest(0, least(q.size, floor(g.target) - q.start - g.source_size)) AS BIGINT) AS taken
FROM queued q JOIN goals g ON q.source IS NOT DISTINCT FROM g.source
"""


@query("op3_mixing", OP3_SQL)
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mix(docs)
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")
