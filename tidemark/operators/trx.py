"""Transactions: assembly, sizes, empty runs, flush points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.ordered import running
from tidemark.plans.model import ROW_OPERATIONS

#: Fixed value: empty transactions in a row after which a sink flushes.
EMPTY_RUN = 1000


def with_trx(ops: DataFrame) -> DataFrame:
    """ops with trx, which counts the BEGINs of the server so far: a transaction runs from its BEGIN to its COMMIT."""
    return running(ops, "trx", "sum", (F.col("op") == "begin").cast("long"))


def row_counts(ops: DataFrame) -> DataFrame:
    """(server_id, trx, gtid, rows, operations) for each transaction; partial sums are made before the shuffle."""
    is_row = F.col("op").isin(*ROW_OPERATIONS)
    return with_trx(ops).where(F.col("op").isin("begin", "commit", *ROW_OPERATIONS) & (F.col("trx") > 0)).groupBy("server_id", "trx").agg(F.min("gtid").alias("gtid"), F.count_if(is_row).alias("rows"), F.count("*").alias("operations"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


def assembled(ops: DataFrame) -> DataFrame:
    """(server_id, trx, kinds): the operations of each transaction in order. For transactions that fit in a row; row_counts has no such bound."""
    inside = with_trx(ops).where(F.col("op").isin("begin", "commit", *ROW_OPERATIONS) & (F.col("trx") > 0))
    return inside.groupBy("server_id", "trx").agg(F.array_sort(F.collect_list(F.struct("seq", "op"))).alias("o")).select("server_id", "trx", F.array_join("o.op", ",").alias("kinds"))


def empty_runs(counts: DataFrame) -> DataFrame:
    """(server_id, first_trx, length) of runs of transactions without rows.

    Only empty transactions are ordered, and those in windows of 2**16 transactions; runs that meet at a window's edge are joined by
    their one row each.
    """
    empty = counts.where("rows = 0").withColumn("part", F.expr("trx div 65536"))
    island = empty.withColumn("g", F.col("trx") - F.row_number().over(W.partitionBy("server_id", "part").orderBy("trx")))
    local = island.groupBy("server_id", "part", "g").agg(F.min("trx").alias("a"), F.max("trx").alias("b"))
    order = W.partitionBy("server_id").orderBy("a")
    new = F.when(F.col("a") == F.lag("b").over(order) + 1, 0).otherwise(1)
    return local.withColumn("new", new).withColumn("run", F.sum("new").over(order)).groupBy("server_id", "run").agg(F.min("a").alias("first_trx"), (F.max("b") - F.min("a") + 1).alias("length")).drop("run")


def flush_points(ops: DataFrame) -> DataFrame:
    """(seq, op) where a sink sends what it holds: a COMMIT with rows, a DDL, a ROTATE, or the last of each EMPTY_RUN empty transactions in a row."""
    counts = row_counts(ops)
    runs = empty_runs(counts)
    many = runs.where(F.col("length") >= EMPTY_RUN).select("server_id", F.explode(F.sequence(F.col("first_trx") + EMPTY_RUN - 1, F.col("first_trx") + F.col("length") - 1, F.lit(EMPTY_RUN).cast("long"))).alias("trx"))
    ends = counts.where("rows > 0").select("server_id", "trx").unionByName(many)
    commits = with_trx(ops).where("op = 'commit'").join(ends, ["server_id", "trx"], "left_semi").select("seq", "op")
    return commits.unionByName(ops.where("op in ('ddl', 'rotate')").select("seq", "op"))


def gtid_intervals(df: DataFrame, key: str = "server_id", number: str = "gno") -> DataFrame:
    """(key, lo, hi): the sets of transaction numbers as intervals, in windows of 2**16 numbers whose edges are joined after."""
    d = df.select(key, number).distinct().withColumn("part", F.expr(f"{number} div 65536"))
    island = d.withColumn("g", F.col(number) - F.row_number().over(W.partitionBy(key, "part").orderBy(number)))
    local = island.groupBy(key, "part", "g").agg(F.min(number).alias("a"), F.max(number).alias("b"))
    order = W.partitionBy(key).orderBy("a")
    new = local.withColumn("new", F.when(F.col("a") == F.lag("b").over(order) + 1, 0).otherwise(1)).withColumn("n", F.sum("new").over(order))
    return new.groupBy(key, "n").agg(F.min("a").alias("lo"), F.max("b").alias("hi")).drop("n")


def gtid_set_text(intervals: DataFrame, uuid: str, key: str = "server_id") -> DataFrame:
    """(key, gset): uuid:lo-hi:lo-hi, one number alone as such."""
    one = F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat_ws("-", F.col("lo").cast("string"), F.col("hi").cast("string")))
    return intervals.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("lo", one.alias("t")))).alias("x")).select(key, F.concat_ws(":", F.lit(uuid), F.array_join("x.t", ":")).alias("gset"))
