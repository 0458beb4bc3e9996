"""From changes to operations: headers, images, definitions, progress, JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import wire_value
from tidemark.plans.model import OPERATIONS, ROW_OPERATIONS


def header() -> Column:
    return F.struct("server_id", "type", "timestamp", "log_pos")


def image(*columns: str) -> Column:
    return F.array(*(wire_value(F.col(c)) for c in columns))


def row_action(event: Column) -> Column:
    """insert, update or delete of a row event's type, versions 1 and 2; any other is an error."""
    return F.when(event.rlike("^WRITE_ROWS"), "insert").when(event.rlike("^UPDATE_ROWS"), "update").when(event.rlike("^DELETE_ROWS"), "delete").otherwise(F.raise_error(F.concat(F.lit("not a row event: "), event)))


def paired(rows: Column) -> Column:
    """Update images come in twos, before and after; an odd number is an error, none are null."""
    pairs = F.transform(F.sequence(F.lit(0), (F.size(rows) / 2).cast("int") - 1), lambda i: F.struct(F.get(rows, 2 * i).alias("before"), F.get(rows, 2 * i + 1).alias("after")))
    return F.when(F.size(rows) % 2 == 1, F.raise_error(F.lit("an update has an odd number of images"))).when(F.size(rows) > 0, pairs)


def progress() -> Column:
    return F.struct(F.when(F.col("gset").isNull(), F.lit("")).when(F.col("gset").contains(":"), F.lit("mysql")).otherwise(F.lit("mariadb")).alias("flavor"), "server_id", "log_name", "log_pos", "gset")


def operation(ops: DataFrame, *more: str) -> DataFrame:
    """(seq, more, operation): each with the fields of its kind, others null. Images are (key, value, props)."""
    kind = F.col("op")
    own = kind.isin(*ROW_OPERATIONS)
    after = image("key", "value", "props")
    return ops.withColumn("gset", F.when(kind.isin("commit", "ddl"), F.col("gtid"))).select(
        "seq",
        *more,
        F.struct(
            header().alias("header"),
            F.when(kind == "rotate", F.col("log_name")).alias("next_log_name"),
            F.when(kind == "rotate", F.col("log_pos")).alias("next_log_pos"),
            F.when(kind == "gtid", F.col("gtid")).alias("gtid"),
            F.when(kind == "gtid", F.col("gno") - 1).alias("last_committed"),
            F.when(kind == "gtid", F.col("gno")).alias("sequence_number"),
            F.when(kind.isin("ddl", "query"), F.col("database")).alias("database"),
            F.when(kind.isin("ddl", "query"), F.col("statement")).alias("statement"),
            F.when(own, F.struct("database", F.col("table").alias("name"))).alias("table"),
            F.when(own, F.array(F.struct(F.when(kind.isin("update", "delete"), after).alias("before"), F.when(kind.isin("insert", "update"), after).alias("after")))).alias("rows"),
            F.when(kind.isin("commit", "ddl"), progress()).alias("progress"),
        ).alias("operation"),
    )


def as_json(op: Column, pretty: bool = False) -> Column:
    """Null and absent fields are left out."""
    return F.to_json(op, {"ignoreNullFields": "true", "pretty": str(pretty).lower()})


def consumer_lines(ops: DataFrame, seq: bool = True, offset: bool = True, most: int | None = None) -> DataFrame:
    """Lines of text: sequence number, offset, JSON, joined by tabs; the first ``most`` in order of sequence, if it is given."""
    ops = ops if most is None else ops.orderBy("seq").limit(most)
    parts = [F.col("seq").cast("string")] * seq + [F.col("offset").cast("string")] * offset + [as_json(F.col("operation"))]
    return ops.select(F.concat_ws("\t", *parts).alias("line"))


def counters(ops: DataFrame) -> DataFrame:
    """Transactions, row events, DDL (DCL too) of each server."""
    n = lambda *kinds: F.count_if(F.col("op").isin(*kinds))
    return ops.groupBy("server_id").agg(n("begin").alias("trx_total"), n(*ROW_OPERATIONS).alias("row_event_total"), n("ddl").alias("ddl_total"), F.count("*").alias("operation_total"))


def type_name(code: Column) -> Column:
    names = F.create_map(*(F.lit(x) for k, v in OPERATIONS.items() for x in (v, k)))
    return names[code]


def materialised(changes: DataFrame) -> DataFrame:
    """The current table: the latest image of each key, deleted ones left out. One aggregate with partial sums, no sort."""
    latest = F.max_by(F.struct("action", "value", "props"), F.col("e"))
    last = changes.groupBy("database", "table", "key").agg(latest.alias("l"), F.max("e").alias("last_e"))
    return last.where("l.action <> 'delete'").select("database", "table", "key", "l.value", "last_e")
