"""The message path: operations gathered to flush points, encoded, split, compressed, cut into numbered messages, and back."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import codec
from tidemark.operators import transport, trx
from tidemark.operators.ops import as_json, operation
from tidemark.operators.ordered import running


def batches(ops: DataFrame) -> DataFrame:
    """(id, seqs, ops): what a sink holds up to each flush point, as JSON in order; id is the first sequence number. What no flush point ends stays behind."""
    flush = trx.flush_points(ops).select("seq", F.lit(1).cast("long").alias("flush"))
    marked = ops.join(flush, "seq", "left").withColumn("flush", F.coalesce("flush", F.lit(0).cast("long")))
    run = running(marked, "_tm_g", "sum", F.col("flush")).withColumn("_tm_g", F.col("_tm_g") - F.col("flush"))
    each = operation(run, "server_id", "_tm_g", "flush").select("server_id", "_tm_g", "flush", F.struct("seq", as_json(F.col("operation")).alias("j")).alias("o"))
    grouped = each.groupBy("server_id", "_tm_g").agg(F.array_sort(F.collect_list("o")).alias("o"), F.max("flush").alias("whole")).where("whole = 1")
    return grouped.select(F.col("o")[0]["seq"].alias("id"), F.col("o.seq").alias("seqs"), F.col("o.j").alias("ops"))


def payloads(held: DataFrame, most: int = transport.MAX_PAYLOAD) -> DataFrame:
    """(id, payload) from ``batches``: a batch over ``most`` bytes is halved until its parts fit, an operation that is too large stays alone."""

    @F.pandas_udf(T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("payload", T.BinaryType())])))
    def encoded(seqs: pd.Series, ops: pd.Series) -> pd.Series:
        def one(seqs: list[int], ops: list[str]) -> list[dict]:
            parts = [codec.encode_ops([json.loads(j)]) for j in ops]  # a payload of several is theirs end to end
            return [{"id": int(seqs[a]), "payload": b"".join(parts[a:b])} for a, b in transport.halved([len(p) for p in parts], most)]

        return pd.Series([one(s, o) for s, o in zip(seqs, ops, strict=True)])

    return held.select(F.explode(encoded("seqs", "ops")).alias("p")).select("p.*")


def messages(ops: DataFrame, producer: int, start: int = 1, most: int = transport.MAX_PAYLOAD, compression: int = codec.NONE) -> DataFrame:
    """Numbered messages (version, producer_id, seq, more_fragment, group_id, compression, payload binary) of a sink's operations."""
    packed = payloads(batches(ops), most).withColumn("payload", codec.compress("payload", F.lit(compression)))
    return transport.messages(packed, producer, start, most).withColumn("compression", F.lit(compression))


def operations(received: DataFrame) -> DataFrame:
    """(producer_id, group_id, place, operation) of messages with an offset: repeats dropped, fragments joined, text decompressed."""
    kinds = received.groupBy("producer_id", "group_id").agg(F.max("compression").alias("compression"))
    whole = transport.reassembled(transport.accepted(received)).join(kinds, ["producer_id", "group_id"])
    read = codec.from_payload(codec.decompress("payload", "compression"))
    return whole.select("producer_id", "group_id", F.posexplode(read).alias("place", "operation"))


def on_the_wire(messages: DataFrame) -> DataFrame:
    """(seq, value): each message as the bytes that go to the topic."""

    @F.pandas_udf(T.BinaryType())
    def framed(fields: pd.DataFrame) -> pd.Series:
        out = []
        for r in fields.to_dict("records"):
            m = codec.message_class("Message")()
            codec._fill(m, {k: bytes(v) if k == "payload" else v for k, v in r.items()}, "Message")
            out.append(m.SerializeToString())
        return pd.Series(out)

    return messages.select("seq", framed(F.struct("version", "producer_id", "seq", "more_fragment", "group_id", "compression", "payload")).alias("value"))


def off_the_wire(value: Column) -> Column:
    """A message's fields from its bytes."""
    schema = "version long, producer_id long, seq long, more_fragment boolean, group_id long, compression int, payload binary"

    @F.pandas_udf(schema)
    def read(raw: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([codec._read(codec.message_class("Message").FromString(r), "Message") for r in raw], columns=["version", "producer_id", "seq", "more_fragment", "group_id", "compression", "payload"])

    return read(value)
