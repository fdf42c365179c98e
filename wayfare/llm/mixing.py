"""Mixing sources to target weights.

Words are counted per source; the sources' targets follow from weights and a
ceiling on repetition; each document is then emitted floor(rate) times plus one
more copy by a coin whose seed is a digest of the document and whose chance is
the fraction of the rate. Only DataFrame functions: nothing here runs in Python.

Results in odd cases: a null text has size 0; null sources are one source of
their own, last in order; a source without words has target 0 and gives no
copies; an empty table gives an empty mix. Equal rows get equal coins, so the
mix does not depend on where a row is read. Extra columns stay; input columns
named like an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import running, saved, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
CEILING = 3
SEED = "mix-1"
ADDED = ("size", "source_size", "target", "copies", "taken")


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(docs: DataFrame, weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """(source, source_size, target) per source.

    Targets share all words by weight (dealt to the sources in code point order,
    null last, again and again). No target passes ``ceiling`` times its source;
    what is cut off is shared anew by weight. That has a closed form: in order of
    ceiling / weight, the sources before some place are at their ceiling and all
    later ones get weight times one level.
    """
    sized = saved(docs.groupBy("source").agg(F.sum(words(F.col("text"))).alias("source_size")), "sources")
    at = running(sized, [F.col("source").asc_nulls_last()], {"place": F.lit(1)})
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    at = at.withColumns({"weight": weight.cast("long"), "most": F.col("source_size") * ceiling})
    at = running(at, [(F.col("most") / F.col("weight")).asc(), F.col("place").asc()],
                 {"capped": F.col("most"), "lighter": F.col("weight")})
    at = saved(at, "sources")
    whole = at.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (F.lit(whole[0]).cast("long") - F.col("capped")) / (F.lit(whole[1]).cast("long") - F.col("lighter"))
    fits = at.withColumn("level", level).where("most >= weight * level")
    found = fits.agg(F.min_by("level", F.struct(F.col("most") / F.col("weight"), "place"))).first()[0]
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(found).cast("double"))
    return saved(at.select("source", "source_size", target.alias("target")), "targets")


def coin(docs: DataFrame, seed: str) -> Column:
    """A number in [0, 1) from the digest of a document's id and text; the same on every run."""
    parts = [F.coalesce(docs[c].cast("string"), F.lit("")) for c in ("doc_id", "text")]
    digest = F.md5(F.concat_ws(":", F.lit(seed), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def plan(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING, seed: str = SEED,
) -> DataFrame:
    """Every document with its size, its source's size and target, its copies and the words they hold."""
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    goal = targets(docs, weights, ceiling).withColumnRenamed("source", "__source")
    sized = docs.select(*kept, words(F.col("text")).alias("size"), coin(docs, seed).alias("__coin"))
    met = sized.join(goal, F.col("source").eqNullSafe(F.col("__source")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor("__rate") + F.when(F.col("__coin") < F.col("__rate") - F.floor("__rate"), 1).otherwise(0)
    return (
        met.withColumn("__rate", rate).withColumn("copies", copies.cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size")).select(*kept, *ADDED)
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows themselves, in the columns of ``docs``: each document as often as planned."""
    names = docs.columns
    shelved = docs.withColumnsRenamed({c: f"__in_{c}" for c in names if c.lower() in ADDED})
    planned = plan(shelved, **options)
    rows = planned.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select(*(F.col(f"__in_{c}" if c.lower() in ADDED else c).alias(c) for c in names))


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    return plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS coin
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source),
w AS (SELECT *, place % 3 + 1 AS weight, 3 * source_size AS most FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER before, 0))::BIGINT::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT::DOUBLE AS level
  FROM w WINDOW before AS (ORDER BY most::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT arg_min(level, (most::DOUBLE / weight, place)) AS level FROM l WHERE most >= weight * level),
t AS (SELECT source, source_size, least(most::DOUBLE, weight * (SELECT level FROM g)) AS target FROM w),
r AS (
  SELECT doc_id, size, source_size, target, coin,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM r
"""
