"""Mixing sources to target weights (operator 4): DataFrame functions only.

One aggregation gives the words of each source.  Sources in code-point order (null last) get
the weights in turn and share ``budget`` times all words; a target stops at ``most`` times
its source's words and the excess goes to the other sources by weight.  That has a closed
form: in the order of limit to weight, the sources before the first one that can take its
share are full, and all others get one rate per weight.  A source's rate is its target over
its words; a document is emitted floor(rate) times, plus once if a number drawn from the
SHA-256 of seed and document id is below the fraction.

The plan has one row per source; it is written and read back, so that Catalyst knows its
size when it picks the join (broadcast if small, else a join whose skew AQE splits).

Contract: a null text has no words, a null source is a source of its own, a null id draws
like the text ``null``; rows that repeat an id draw alike; sources without words have target
0; an empty table gives an empty result; extra columns of the input are kept by ``emit``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.texts import WORD
from quayside.session import scratch_path

WEIGHTS, BUDGET, MOST, SEED = (5, 2, 1), 1.5, 2, "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def mix_plan(sized: DataFrame, source_col: str = "source", size_col: str = "size", weights: tuple[int, ...] = WEIGHTS,
             budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """(source, source_size, target, rate), one row per source, as a written table."""
    spark = sized.sparkSession
    per = sized.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_col).alias("source_size"))
    in_turn = Window.orderBy(F.col("source").asc_nulls_last())
    per = (per.withColumn("turn", F.row_number().over(in_turn))
           .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("turn") - 1) % len(weights) + 1))
           .withColumn("limit", most * F.col("source_size")))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "turn")
    all_rows = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = (per.withColumn("full_before", F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("weight_left", F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("share", (F.lit(budget) * F.sum("source_size").over(all_rows) - F.col("full_before")) / F.col("weight_left"))
            .withColumn("open", F.col("weight") * F.col("share") <= F.col("limit"))
            .withColumn("level", F.max(F.when(F.col("open"), F.col("share"))).over(all_rows)))
    target = F.coalesce(F.least(F.col("limit").cast("double"), F.col("weight") * F.col("level")), F.col("limit").cast("double"))
    rate = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    path = scratch_path(spark, "mix-plan")
    fill.select("source", "source_size", target.alias("target"), rate.alias("rate")).write.parquet(path)
    return spark.read.parquet(path)


def copies(rate: Column, doc_id: Column, seed: str = SEED) -> Column:
    """floor(rate), plus 1 with probability rate - floor(rate)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    draw = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def mix_sizes(df: DataFrame, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **plan) -> DataFrame:
    """(id, size, source_size, target, taken, copies) of every document."""
    spark = df.sparkSession
    path = scratch_path(spark, "mix-sizes")   # words are counted once
    df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")).write.parquet(path)
    sized = spark.read.parquet(path)
    plan = mix_plan(sized, **plan).withColumnRenamed("source", "plan_source")
    n = copies(F.col("rate"), F.col("id"), seed)
    return (sized.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
            .select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * n).alias("taken"), n.alias("copies")))


def emit(df: DataFrame, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **plan) -> DataFrame:
    """The mix itself: every row of ``df`` as often as its source's rate says, with the columns of ``df``."""
    sized = df.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    rates = mix_plan(sized, **plan).select(F.struct("source", "rate").alias("__plan"))
    # the plan's names can't clash with the table's: they stay inside a struct
    joined = df.join(rates, F.col(source_col).eqNullSafe(F.col("__plan.source")))
    return (joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies(F.col("__plan.rate"), F.col(id_col), seed).cast("int"))))
            .select(*[joined[c] for c in df.columns]))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS turn FROM sized GROUP BY source),
lim AS (SELECT *, [5, 2, 1][(turn - 1) % 3 + 1] AS weight, 2 * source_size AS lim FROM per),
fill AS (
  SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT)
             - CAST(coalesce(sum(lim) OVER (ORDER BY lim::DOUBLE / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
            / CAST(sum(weight) OVER (ORDER BY lim::DOUBLE / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS share FROM lim),
lev AS (SELECT *, max(CASE WHEN weight * share <= lim THEN share END) OVER () AS level FROM fill),
plan AS (
  SELECT source, source_size, coalesce(least(lim::DOUBLE, weight * level), lim::DOUBLE) AS target,
         CASE WHEN source_size > 0 THEN least(coalesce(least(lim::DOUBLE, weight * level), lim::DOUBLE) / source_size, 2.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate
  FROM lev),
drawn AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.rate,
         CAST('0x' || substr(sha256('mix:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT)::DOUBLE / 281474976710656.0::DOUBLE AS draw
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
n AS (SELECT *, CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies FROM drawn)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM n
"""
