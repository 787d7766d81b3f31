"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import materialise

from .common import table, word_count
from .order import sums_before

SHARE = 1.5  # words of the mix, as a multiple of the words there are
MOST = 2.0  # largest repetition rate of a source
WEIGHTS = (3.0, 1.0, 2.0)  # of the sources in order of their names, repeating
SEED = "mix-1"


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """`sizes` (source, source_size, weight) with `target`.

    Sources share `share` times all words by weight. A target stops at `most` times its source's size;
    what it leaves is shared by the others by weight until no target is above. Every step is one small
    aggregate over the sources; a step caps at least one more source or is the last.
    """
    sizes = materialise(sizes, "sources")
    cap = F.col("source_size") * most
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    per_weight, capped = 0.0, -1
    above = F.lit(False)
    while True:
        n, used, weight = sizes.agg(F.count_if(above), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        if n == capped:
            break
        capped = n
        per_weight = max(0.0, share * total - (used or 0.0)) / weight if weight else 0.0
        above = (F.lit(per_weight) * F.col("weight") > cap) if weight else F.lit(True)
    return sizes.withColumn("target", F.when(above, cap).otherwise(F.lit(per_weight) * F.col("weight")))


def chance(key: Column, seed: str = SEED) -> Column:
    """Number from 0 to 1 that follows from the key and the seed alone."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", share: float = SHARE, most: float = MOST, weights: tuple[float, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """One row per document: item (the whole row as a struct), size, source_size, target, copies.

    Words are summed per source (a null source is one of its own, last in order), each source has the
    repetition rate target / source_size, and a document is taken floor(rate) times, plus once more if
    the number hashed from its doc_id is below the fraction. So reruns agree; rows that share a doc_id,
    null included, share the decision. A null or empty text has size 0 and adds nothing to a target; in
    a source without words the rate is 0 and nothing is taken. No documents give no rows.
    """
    sized = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("item"), word_count(docs[text]).alias("size"), docs[source].alias("source"), chance(docs[doc_id], seed).alias("chance"))
    sizes = materialise(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
    ranked = sums_before(sizes.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], "one")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("before") % len(weights) + 1).cast("int"))
    rates = targets(ranked.select("source", "source_size", weight.alias("weight")), share, most)
    rates = materialise(rates, "targets").withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor(rate) + F.when(F.col("chance") < rate - F.floor(rate), 1).otherwise(0)
    return sized.join(rates, sized["source"].eqNullSafe(rates["of"])).select("item", "size", "source_size", "target", copies.cast("long").alias("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its number of the copy."""
    return mixed.where("copies > 0").select("item", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("item.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM d GROUP BY source
), r AS (  -- by cap per weight, the capped sources come first
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(2.0::DOUBLE * source_size) OVER w, 0) AS used,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS left_weight
  FROM s WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT *, (1.5::DOUBLE * total - used) / left_weight * weight > 2.0::DOUBLE * source_size AS capped FROM r
), f AS (
  SELECT (1.5::DOUBLE * any_value(total) - coalesce(sum(2.0::DOUBLE * source_size) FILTER (capped), 0)) / sum(weight) FILTER (NOT capped) AS per_weight FROM c
), t AS (
  SELECT source, source_size, CASE WHEN capped THEN 2.0::DOUBLE * source_size ELSE per_weight * weight END AS target FROM c, f
), m AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS chance
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, size * (floor(rate) + (chance < rate - floor(rate))::INT)::BIGINT AS taken,
       (floor(rate) + (chance < rate - floor(rate))::INT)::BIGINT AS copies FROM m
"""
