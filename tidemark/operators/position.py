"""Positions and progress: order, zero test, rendering, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def position_key(name: str = "log_name", pos: str = "log_pos") -> Column:
    """Order of positions on one server: file names as text, then the offset. Beyond six digits the text order of names is not that of numbers."""
    return F.struct(F.col(name), F.col(pos))


def compare_positions(a: str, b: str) -> Column:
    """-1, 0 or 1 for structs (log_name, log_pos, server_id); null across servers."""
    x, y = (F.struct(F.col(f"{s}.log_name"), F.col(f"{s}.log_pos")) for s in (a, b))
    same = F.col(f"{a}.server_id") == F.col(f"{b}.server_id")
    return F.when(same, F.when(x < y, -1).when(x > y, 1).otherwise(0))


def is_zero(progress: str) -> Column:
    """With a GTID set (even an empty one): whether its text is empty; else whether name and offset are unset."""
    p = lambda f: F.col(f"{progress}.{f}")
    return F.when(p("gset").isNotNull(), p("gset") == "").otherwise((F.coalesce(p("log_name"), F.lit("")) == "") & (F.coalesce(p("log_pos"), F.lit(0)) == 0))


def compare_progress(a: str, b: str) -> Column:
    """A zero progress is least; else by position alone. GTID sets need not contain each other, so they don't count."""
    za, zb = is_zero(a), is_zero(b)
    return F.when(za & zb, 0).when(za, -1).when(zb, 1).otherwise(compare_positions(a, b))


def text(progress: str) -> Column:
    p = lambda f: F.col(f"{progress}.{f}")
    return F.when(p("gset").isNotNull() & (p("gset") != ""), p("gset")).otherwise(F.concat(p("log_name"), F.lit(":"), p("log_pos").cast("string")))


def new_since(df: DataFrame, server_id: int | None, log_name: str = "", log_pos: int = 0) -> DataFrame:
    """Rows that a sink at this progress has not had: from the first row on that is later or of another server, in order of ``seq``, all are new.

    No progress (None or zero): every row. Servers follow each other as the log has them, whatever their ids are. Where the first new
    row is comes from one aggregate; nothing is shuffled for it.
    """
    if server_id is None or (not log_name and not log_pos):
        return df
    later = (F.col("server_id") != server_id) | (F.struct("log_name", "log_pos") > F.struct(F.lit(log_name), F.lit(log_pos).cast("long")))
    first = df.where(later).agg(F.min("seq").alias("_tm_first"))  # one row
    return df.crossJoin(F.broadcast(first)).where(F.col("seq") >= F.col("_tm_first")).drop("_tm_first")


def server_changes(df: DataFrame) -> DataFrame:
    """(server_id, first_seq, old_server): where the log goes on from another server; a row for each server is ordered."""
    firsts = df.groupBy("server_id").agg(F.min("seq").alias("first_seq"))
    return firsts.withColumn("old_server", F.lag("server_id").over(W.orderBy("first_seq"))).where("old_server is not null")


def newest_progress(df: DataFrame) -> DataFrame:
    """One row: the position of the last commit or schema change in order of ``seq``, whatever the servers' ids are."""
    return df.where(F.col("op").isin("commit", "ddl")).agg(F.max_by(F.struct("server_id", "log_name", "log_pos"), F.col("seq")).alias("p")).where("p is not null").select("p.*")
