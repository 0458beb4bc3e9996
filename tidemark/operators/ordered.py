"""Running values along the log, computed file by file.

A window over a whole server's log would be one task. A log file is of bounded size, so each is a window of its own; what it starts
from comes from one row for each file, which is all that is ordered across files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FILE = ("server_id", "log_name")
ORDER = ("log_pos", "seq")
_SO_FAR = (W.unboundedPreceding, W.currentRow)


def within_file() -> W:
    return W.partitionBy(*FILE).orderBy(*ORDER)


def running(df: DataFrame, out: str, kind: str, value: Column) -> DataFrame:
    """df with ``out``: the sum, the greatest or the last non-null value from the server's first row to this one."""
    df = df.withColumn("_tm_v", value)
    rank = F.struct(*ORDER)
    local, whole = {
        "sum": (F.sum("_tm_v"), F.sum("_tm_v")),
        "max": (F.max("_tm_v"), F.max("_tm_v")),
        "last": (F.last("_tm_v", ignorenulls=True), F.max_by("_tm_v", F.when(F.col("_tm_v").isNotNull(), rank))),
    }[kind]
    files = df.groupBy(*FILE).agg(whole.alias("_tm_f"))
    earlier = W.partitionBy("server_id").orderBy("log_name").rowsBetween(W.unboundedPreceding, -1)
    before = {"sum": F.sum("_tm_f"), "max": F.max("_tm_f"), "last": F.last("_tm_f", ignorenulls=True)}[kind].over(earlier)
    starts = files.select(*FILE, before.alias("_tm_b"))
    here = local.over(within_file().rowsBetween(*_SO_FAR))
    joined = df.withColumn("_tm_l", here).join(starts, list(FILE), "left")
    total = {"sum": F.coalesce("_tm_l", F.lit(0)) + F.coalesce("_tm_b", F.lit(0)), "max": F.greatest("_tm_l", "_tm_b"), "last": F.coalesce("_tm_l", "_tm_b")}[kind]
    return joined.withColumn(out, total).drop("_tm_v", "_tm_l", "_tm_b")


def previous(df: DataFrame, out: str, value: Column) -> DataFrame:
    """df with ``out``: the value of the row before on the same server, across files."""
    df = df.withColumn("_tm_v", value)
    lasts = df.groupBy(*FILE).agg(F.max_by("_tm_v", F.struct(*ORDER)).alias("_tm_f"))
    lasts = lasts.select(*FILE, F.lag("_tm_f").over(W.partitionBy("server_id").orderBy("log_name")).alias("_tm_b"))
    first = F.row_number().over(within_file()) == 1
    out_ = F.when(first, F.col("_tm_b")).otherwise(F.lag("_tm_v").over(within_file()))
    return df.join(lasts, list(FILE), "left").withColumn(out, out_).drop("_tm_v", "_tm_b")
