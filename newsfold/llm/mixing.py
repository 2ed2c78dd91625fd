"""Mixing sources to target weights by weighted fair queueing.

The documents of each source stand in a shuffled order (by an MD5 of their id,
so that reruns agree); after the last one the queue starts over, once for
every further epoch.  A document copy's virtual finish time is the number of
words that its source has sent when it ends, divided by the source's target.
All copies, sorted by finish time (ties by the source's place), are taken until
the budget is reached; at finish time 1 every source has sent its target.

All steps are DataFrame functions.  The running sums use two levels: sums
per (source, slice of the shuffle) are accumulated over the slices, then rows
inside one slice, so no window holds a source.  The global order is cut the same
way: sums per slice of finish time give the slice in which the budget ends,
and only that slice is sorted by row.

Targets: sources in code-point order, null last, weigh 3, 1, 2, repeating;
they share the budget of 150 % of all words; a target stops at twice its
source's words and what it leaves is shared out again by weight, until none
is above.  Null text has no words; documents without words are not taken.  Rows that repeat an id are separate documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, text_of

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
EPOCHS = 2
SEED = "mix-1"
#: Slices of the shuffled order: the leading hexadecimal digits of the MD5.
DIGITS = 3
#: Slices of finish time per unit; slices end at time 2, all later copies lie in the last one.
TIME_SLICES = 1 << 15


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """doc_id, source, size in words, shuffle key."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary")).alias("key"),
    )


def targets(by_source: DataFrame, weights=WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """by_source: source, source_size.  Adds place and target.

    In order of cap / weight the sources that stop at their cap come first; the level at which the rest share is
    (budget - caps so far) / (weights from here on), taken at the first source whose cap is not below it."""
    placed = by_source.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    rest = placed.withColumn("weight", w).withColumn("cap", F.lit(epochs) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    rest = rest.withColumn(
        "level",
        (F.lit(budget) * F.sum("source_size").over(Window.partitionBy()) - (F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap")))
        / F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
    )
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("place"), F.col("level")))
    level = F.min(fits).over(Window.partitionBy())["level"]
    cap = F.col("cap").cast("double")
    return rest.select("source", "place", "source_size", F.when(level.isNull(), cap).otherwise(F.least(cap, level * F.col("weight"))).alias("target"))


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    budget: float = BUDGET,
    epochs: int = EPOCHS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = SEED,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies for every row of docs."""
    sized = cut(sizes(docs, id_col, text_col, source_col, seed).withColumn("slice", F.substring("key", 1, DIGITS)))
    per_slice = sized.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    by_source = targets(per_slice.groupBy("source").agg(F.sum("words").alias("source_size")), weights, budget, epochs)
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select("source", "slice", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    offsets = offsets.join(by_source, offsets["source"].eqNullSafe(by_source["source"])).drop(by_source["source"])
    inside = Window.partitionBy("source", "slice").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    running = sized.withColumn("inside", F.sum("size").over(inside))
    queued = running.join(
        offsets.withColumnsRenamed({"source": "its_source", "slice": "its_slice"}),
        F.col("source").eqNullSafe(F.col("its_source")) & (F.col("slice") == F.col("its_slice")),
    ).select("doc_id", "size", "source_size", "place", "target", (F.col("before") + F.col("inside")).alias("sent"))
    queued = cut(queued)
    finish = [F.coalesce((F.col("sent") + F.lit(e) * F.col("source_size")) / F.nullif("target", F.lit(0.0)), F.lit(0.0)) for e in range(epochs)]
    last = _last_taken(queued, finish, budget)
    copies = [
        F.when((f < F.lit(last[0])) | ((f == F.lit(last[0])) & (F.col("place") <= F.lit(last[1]))), 1).otherwise(0) for f in finish
    ]
    total = F.when(F.col("size") > 0, sum(copies[1:], copies[0])).otherwise(0).cast("long")
    return queued.select("doc_id", "size", "source_size", "target", (F.col("size") * total).alias("taken"), total.alias("copies"))


def _last_taken(queued: DataFrame, finish: list, budget: float) -> tuple[float, int]:
    """Finish time and place of the last copy within the budget."""
    timed = queued.filter("size > 0").select("size", "place", F.explode(F.array(*finish)).alias("finish"))
    timed = timed.withColumn("time", F.floor(F.least("finish", F.lit(2.0)) * TIME_SLICES))
    whole = queued.agg(F.sum("size")).first()[0] or 0
    sums = timed.groupBy("time").agg(F.sum("size").alias("words"))
    running = sums.withColumn("upto", F.sum("words").over(Window.orderBy("time")))  # a row per slice of time
    end = running.filter(F.col("upto") > F.lit(budget * whole)).orderBy("time").limit(1).collect()
    if not end:
        return float("inf"), 0
    at, left = end[0]["time"], budget * whole - (end[0]["upto"] - end[0]["words"])
    ranked = timed.filter(F.col("time") == at).withColumn("upto", F.sum("size").over(Window.orderBy("finish", "place")))
    found = ranked.filter(F.col("upto") <= F.lit(left)).agg(F.max(F.struct("finish", "place")).alias("last")).first()["last"]
    return (found["finish"], found["place"]) if found else (at / TIME_SLICES, -1)


ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('{SEED}-' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM d GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][((place - 1) % 3) + 1] AS weight, 2 * source_size AS cap FROM s
), l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - (sum(cap) OVER (ORDER BY cap::DOUBLE / weight, place) - cap))
            / sum(weight) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), t AS (
  SELECT source, place, source_size,
         coalesce(least(cap::DOUBLE, weight * first(level) OVER (
             ORDER BY level * weight > cap, cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), cap::DOUBLE) AS target
  FROM l
), q AS (
  SELECT d.doc_id, d.size, t.source_size, t.place, t.target,
         sum(d.size) OVER (PARTITION BY t.place ORDER BY d.key, d.size ROWS UNBOUNDED PRECEDING)::BIGINT AS sent
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT doc_id, size, place, (sent + e * source_size)::DOUBLE / target AS finish
  FROM q, (VALUES (0), (1)) AS epochs(e) WHERE size > 0
), k AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY finish, place) <= 1.5 * sum(size) OVER () / 2 AS took FROM c
), n AS (
  SELECT doc_id, sum(CASE WHEN took THEN size ELSE 0 END)::BIGINT AS taken, count(*) FILTER (WHERE took) AS copies FROM k GROUP BY doc_id
)
SELECT q.doc_id, q.size::BIGINT AS size, q.source_size, q.target, coalesce(n.taken, 0)::BIGINT AS taken, coalesce(n.copies, 0)::BIGINT AS copies
FROM q LEFT JOIN n USING (doc_id)
"""
