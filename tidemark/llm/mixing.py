"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, table

WEIGHTS = (3, 1, 2)
SEED = "mix"


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(_tm_source, _tm_source_size, _tm_target) from rows (_tm_source, _tm_size).

    One row per source is all that meets in one place: the partial sums are made before the shuffle. Sources in order of code
    point, null last, weigh ``weights``, repeating. A source is full at ``most`` times its size; what it leaves is shared by
    weight among the others. With sources sorted by fullness per weight, the common level is the first for which the next source
    is not full, so that the repeated sharing needs no loop. No words at all: every target is 0.
    """
    per = sizes.groupBy("_tm_source").agg(F.sum("_tm_size").alias("_tm_source_size"))
    order = W.orderBy(F.col("_tm_source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("_w", weight.cast("long"))
    filled = W.orderBy((F.col("_tm_source_size") / F.col("_w")), F.col("_tm_source").asc_nulls_last())
    before, after = filled.rowsBetween(W.unboundedPreceding, -1), filled.rowsBetween(0, W.unboundedFollowing)
    level = (share * F.sum("_tm_source_size").over(W.partitionBy()) - most * F.coalesce(F.sum("_tm_source_size").over(before), F.lit(0))) / F.sum("_w").over(after)
    per = per.withColumn("_level", level)
    fits = F.when(F.col("_level") <= most * F.col("_tm_source_size") / F.col("_w"), F.col("_level"))
    first = F.coalesce(F.first(fits, ignorenulls=True).over(filled.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)), F.lit(0.0))
    return per.select("_tm_source", "_tm_source_size", F.least(most * F.col("_tm_source_size"), first * F.col("_w")).alias("_tm_target"))


def mixed(docs: DataFrame, share: float = 1.5, most: float = 2.0, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """docs with _tm_size, _tm_source_size, _tm_target and _tm_copies: how often the mix takes the row.

    A row is taken floor(target / source size) times, and once more with the fraction as probability, drawn from md5 of its id, so
    that reruns and retried tasks agree. Null texts and texts without words have size 0 and are drawn alike; a null source is a
    source of its own, rows that repeat an id share its draw, and columns of docs that aren't named are kept as they are.
    """
    sized = docs.withColumn("_tm_size", n_words(text)).withColumn("_tm_key", F.col(source))
    per = source_targets(docs.select(F.col(source).alias("_tm_source"), n_words(text).alias("_tm_size")), share, most)
    rate = F.when(F.col("_tm_source_size") > 0, F.least(F.lit(most), F.col("_tm_target") / F.col("_tm_source_size"))).otherwise(F.lit(0.0))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(SEED), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))).cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0
    joined = sized.join(per, F.col("_tm_key").eqNullSafe(F.col("_tm_source")), "left")
    copies = (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")
    return joined.withColumn("_tm_copies", copies).drop("_tm_source", "_tm_key")


def repeated(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with the columns of docs."""
    out = mixed(docs, **kw)
    return out.where("_tm_copies > 0").withColumn("_tm_copy", F.explode(F.sequence(F.lit(1), F.col("_tm_copies")))).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixed(docs).select("doc_id", F.col("_tm_size").alias("size"), F.col("_tm_source_size").alias("source_size"), F.col("_tm_target").alias("target"), (F.col("_tm_size") * F.col("_tm_copies")).alias("taken"))


def copies_sql(docs: str) -> str:
    """DuckDB: rows of docs with size, source_size, target and copies."""
    return rf"""
sized AS (SELECT *, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM {docs}),
per AS (SELECT source AS src, sum(size)::BIGINT AS ss FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY src NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM per),
levels AS (SELECT *, (1.5::DOUBLE * sum(ss) OVER () - 2.0::DOUBLE * coalesce(sum(ss) OVER (ORDER BY ss / w, src NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(w) OVER (ORDER BY ss / w, src NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM weighed),
lvl AS (SELECT coalesce(arg_min(lv, struct_pack(a := ss / w, b := src IS NULL, c := src)) FILTER (lv <= 2.0::DOUBLE * ss / w), 0.0) AS lv FROM levels),
targets AS (SELECT src, ss, least(2.0::DOUBLE * ss, lvl.lv * w) AS target FROM weighed, lvl),
rated AS (SELECT s.*, t.ss AS source_size, t.target, CASE WHEN t.ss > 0 THEN least(2.0::DOUBLE, t.target / t.ss) ELSE 0 END AS rate,
  ('0x' || substr(md5('{SEED}' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS draw FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.src),
copied AS (SELECT *, (floor(rate) + (CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS copies FROM rated)"""


SQL = f"WITH {copies_sql('documents')} SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken FROM copied"
