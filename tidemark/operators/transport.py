"""Messages: numbering, splitting, fragments, duplicates, reassembly."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed value: bytes of a payload beyond which it is split.
MAX_PAYLOAD = 1 << 20


def numbered(df: DataFrame, order: str, out: str, start: int = 1, part: Column | None = None, block: int = 1 << 16) -> DataFrame:
    """df with consecutive numbers in ``order``, a column of whole numbers: within blocks of it, then the blocks' sums (a row each)."""
    own = df.withColumn("_tm_p", part if part is not None else F.floor(F.col(order) / block))
    sizes = own.groupBy("_tm_p").agg(F.count("*").alias("_tm_n"))
    starts = sizes.select("_tm_p", F.coalesce(F.sum("_tm_n").over(W.orderBy("_tm_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_tm_s"))
    rank = F.row_number().over(W.partitionBy("_tm_p").orderBy(order))
    return own.withColumn("_tm_r", rank).join(starts, "_tm_p").withColumn(out, F.col("_tm_s") + F.col("_tm_r") + (start - 1)).drop("_tm_p", "_tm_r", "_tm_s")


def fragments(payloads: DataFrame, most: int = MAX_PAYLOAD) -> DataFrame:
    """(id, part, parts, more_fragment, payload) of (id, payload binary): slices of ``most`` bytes, an empty payload is one."""
    n = F.greatest(F.lit(1), F.ceil(F.octet_length("payload") / most).cast("int"))
    cut = payloads.withColumn("parts", n).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    piece = F.substring(F.col("payload"), F.col("part") * most + 1, F.lit(most))
    return cut.select("id", "part", "parts", (F.col("part") < F.col("parts") - 1).alias("more_fragment"), piece.alias("payload"))


def messages(payloads: DataFrame, producer: int, start: int = 1, most: int = MAX_PAYLOAD, block: int = 1 << 16) -> DataFrame:
    """Numbered messages of (id, payload): group_id is the first number of the payload's.

    Numbers come from how many fragments payloads have, summed within blocks of ids and from a row for each block, so that payloads of
    any size fit.
    """
    n = F.greatest(F.lit(1), F.ceil(F.octet_length("payload") / most).cast("int"))
    own = payloads.withColumn("_tm_n", n).withColumn("_tm_b", F.floor(F.col("id") / block))
    sizes = own.groupBy("_tm_b").agg(F.sum("_tm_n").alias("_tm_s"))
    so_far = (W.unboundedPreceding, -1)
    starts = sizes.select("_tm_b", F.coalesce(F.sum("_tm_s").over(W.orderBy("_tm_b").rowsBetween(*so_far)), F.lit(0)).alias("_tm_s"))
    before = F.coalesce(F.sum("_tm_n").over(W.partitionBy("_tm_b").orderBy("id").rowsBetween(*so_far)), F.lit(0))
    first = own.withColumn("_tm_w", before).join(starts, "_tm_b").withColumn("group_id", F.col("_tm_s") + F.col("_tm_w") + start)
    cut = first.withColumn("_tm_p", F.explode(F.sequence(F.lit(0), F.col("_tm_n") - 1)))
    piece = F.substring(F.col("payload"), F.col("_tm_p") * most + 1, F.lit(most))
    return cut.select(F.lit(1).cast("long").alias("version"), F.lit(producer).cast("long").alias("producer_id"), (F.col("group_id") + F.col("_tm_p")).alias("seq"), (F.col("_tm_p") < F.col("_tm_n") - 1).alias("more_fragment"), "group_id", F.col("id").alias("payload_id"), piece.alias("payload"))


def accepted(received: DataFrame, block: int = 1 << 16) -> DataFrame:
    """Messages that a consumer takes, in sequence: the first copy of each number, up to the first gap of its producer.

    The first gap is found from one row for each block of numbers, not from an ordered walk through all.
    """
    first = received.groupBy("producer_id", "seq").agg(F.min_by(F.struct(*[c for c in received.columns if c not in ("producer_id", "seq")]), "offset").alias("m"))
    inside = first.select("producer_id", "seq", F.floor(F.col("seq") / block).alias("b"))
    step = inside.withColumn("next", F.lead("seq").over(W.partitionBy("producer_id", "b").orderBy("seq")))
    edges = step.groupBy("producer_id", "b").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.min(F.when(F.col("next") > F.col("seq") + 1, F.col("seq"))).alias("gap"))
    after = F.lead("lo").over(W.partitionBy("producer_id").orderBy("b"))
    ends = edges.withColumn("end", F.coalesce("gap", F.when(after > F.col("hi") + 1, F.col("hi")))).groupBy("producer_id").agg(F.min("end").alias("end"))
    return first.join(ends, "producer_id").where(F.col("end").isNull() | (F.col("seq") <= F.col("end"))).select("producer_id", "seq", "m.*")


def gaps(received: DataFrame, block: int = 1 << 16) -> DataFrame:
    """(producer_id, after_seq, next_seq) where numbers are missing."""
    s = received.select("producer_id", "seq").distinct().withColumn("b", F.floor(F.col("seq") / block))
    own = s.withColumn("next_seq", F.lead("seq").over(W.partitionBy("producer_id", "b").orderBy("seq"))).where(F.col("next_seq") > F.col("seq") + 1).select("producer_id", F.col("seq").alias("after_seq"), "next_seq")
    edges = s.groupBy("producer_id", "b").agg(F.min("seq").alias("lo"), F.max("seq").alias("after_seq"))
    across = edges.withColumn("next_seq", F.lead("lo").over(W.partitionBy("producer_id").orderBy("b"))).where(F.col("next_seq") > F.col("after_seq") + 1).select("producer_id", "after_seq", "next_seq")
    return own.unionByName(across)


def reassembled(taken: DataFrame) -> DataFrame:
    """(producer_id, group_id, payload, begin_seq, end_seq, begin_offset, end_offset) of whole groups: the last fragment says that no more follow.

    A group's fragments make one payload, which has to fit in a row; groups are of one payload each, so that none is hot.
    """
    g = taken.groupBy("producer_id", "group_id").agg(F.array_sort(F.collect_list(F.struct("seq", "payload"))).alias("f"), F.min("seq").alias("begin_seq"), F.max("seq").alias("end_seq"), F.min("offset").alias("begin_offset"), F.max("offset").alias("end_offset"), F.max_by("more_fragment", "seq").alias("open"))
    whole = g.where(~F.col("open") & (F.size("f") == F.col("end_seq") - F.col("begin_seq") + 1) & (F.col("begin_seq") == F.col("group_id")))
    payload = F.aggregate("f", F.lit(b""), lambda a, x: F.concat(a, x["payload"]))
    return whole.select("producer_id", "group_id", payload.alias("payload"), "begin_seq", "end_seq", "begin_offset", "end_offset")


def halved(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Ranges [lo, hi) of operations whose sizes sum to ``most`` or less, by halving; one too large alone stays alone. In order, each once."""
    out, todo = [], [(0, len(sizes))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= 1 or sum(sizes[lo:hi]) <= most:
            if hi > lo:
                out.append((lo, hi))
            continue
        mid = (lo + hi) // 2
        todo += [(mid, hi), (lo, mid)]
    return out


def split_batches(batches: DataFrame, most: int = MAX_PAYLOAD) -> DataFrame:
    """(id, lo, hi): how each batch (id, sizes array<int>) is cut."""
    @F.pandas_udf("array<struct<lo:int,hi:int>>")
    def cut(sizes: pd.Series) -> pd.Series:
        return sizes.map(lambda s: [{"lo": a, "hi": b} for a, b in halved([int(x) for x in s], most)])

    return batches.select("id", F.explode(cut("sizes")).alias("r")).select("id", "r.lo", "r.hi")
