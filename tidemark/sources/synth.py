"""A deterministic changelog derived from the events table: rows, transactions, rotations, schema changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.model import OPERATIONS

UUID = "cb477437-aacb-11e8-90e7-0242ac110002"
PLACES = ("rotate", "gtid", "begin", "ddl", "row", "query", "commit")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row change for each event, with its place in the log."""
    e = F.col("event_id")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        e.alias("e"),
        (F.expr("1001 + event_id div 4000")).alias("server_id"),
        F.concat(F.lit("mysql-bin."), F.lpad(F.expr("event_id div 1000 + 1").cast("string"), 6, "0")).alias("log_name"),
        (e % 1000 * 100 + 104).alias("log_pos"),
        F.expr("event_id div 5 + 1").alias("gno"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.lit("shop").alias("database"),
        F.col("event_type").alias("table"),
        F.when(e % 10 <= 5, "insert").when(e % 10 <= 8, "update").otherwise("delete").alias("action"),
        F.col("user_id").alias("key"),
        "value",
        "props",
    )


def operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole stream: changes with the markers around them. ``seq`` is its order, ``op`` the kind of operation."""
    e = F.col("e")

    def marker(name: str, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(name).alias("op"), F.lit(PLACES.index(name)).alias("place")))

    row = F.struct(F.col("action").alias("op"), F.lit(PLACES.index("row")).alias("place"))
    every = F.array(marker("rotate", e % 1000 == 0), marker("gtid", e % 5 == 0), marker("begin", e % 5 == 0), marker("ddl", e % 500 == 250), row, marker("query", e % 700 == 3), marker("commit", e % 5 == 4))
    out = changes(spark, sf_dir).withColumn("m", F.explode(F.filter(every, lambda m: m.isNotNull())))
    own = F.col("m.op").isin("insert", "update", "delete")
    codes = F.create_map(*(F.lit(x) for kv in OPERATIONS.items() for x in kv))
    statement = F.when(F.col("m.op") == "ddl", F.concat(F.lit("alter  table "), F.col("table"), F.lit(" /*add*/ add column c"), e.cast("string"), F.lit(" int"))).when(F.col("m.op") == "query", F.lit("savepoint a")).when(F.col("m.op") == "begin", F.lit("begin"))
    return out.select(
        (e * 8 + F.col("m.place")).alias("seq"), "e", "server_id", "log_name", (F.col("log_pos") - 4 + F.col("m.place")).alias("log_pos"),
        F.col("m.op").alias("op"), codes[F.col("m.op")].alias("type"), F.when(F.col("m.op") == "rotate", F.lit(0).cast("long")).otherwise(F.col("timestamp")).alias("timestamp"),
        "gno", F.concat(F.lit(UUID + ":"), F.col("gno").cast("string")).alias("gtid"), F.when(own | (F.col("m.op") == "ddl"), F.col("database")).alias("database"),
        F.when(own, F.col("table")).alias("table"), F.when(own, F.col("key")).alias("key"), F.when(own, F.col("value")).alias("value"), F.when(own, F.col("props")).alias("props"), statement.alias("statement"),
    )


SQL_CHANGES = """chg AS (SELECT event_id AS e, 1001 + event_id // 4000 AS server_id, 'mysql-bin.' || lpad((event_id // 1000 + 1)::VARCHAR, 6, '0') AS log_name,
  event_id % 1000 * 100 + 104 AS log_pos, event_id // 5 + 1 AS gno, floor(epoch(ts))::BIGINT AS timestamp, 'shop' AS database, event_type AS "table",
  CASE WHEN event_id % 10 <= 5 THEN 'insert' WHEN event_id % 10 <= 8 THEN 'update' ELSE 'delete' END AS action, user_id AS key, value, props FROM events)"""
SQL_OPERATIONS = (
    SQL_CHANGES
    + f""",
marks AS (SELECT *, 'rotate' AS op, 0 AS place FROM chg WHERE e % 1000 = 0 UNION ALL SELECT *, 'gtid', 1 FROM chg WHERE e % 5 = 0 UNION ALL SELECT *, 'begin', 2 FROM chg WHERE e % 5 = 0
  UNION ALL SELECT *, 'ddl', 3 FROM chg WHERE e % 500 = 250 UNION ALL SELECT *, action, 4 FROM chg UNION ALL SELECT *, 'query', 5 FROM chg WHERE e % 700 = 3 UNION ALL SELECT *, 'commit', 6 FROM chg WHERE e % 5 = 4),
ops AS (SELECT e * 8 + place AS seq, e, server_id, log_name, log_pos - 4 + place AS log_pos, op,
  CASE op {' '.join(f"WHEN '{k}' THEN {v}" for k, v in OPERATIONS.items())} END AS type, CASE WHEN op = 'rotate' THEN 0 ELSE timestamp END AS timestamp, gno, '{UUID}:' || gno AS gtid,
  CASE WHEN place IN (3, 4) THEN database END AS database, CASE WHEN place = 4 THEN "table" END AS "table", CASE WHEN place = 4 THEN key END AS key, CASE WHEN place = 4 THEN value END AS value, CASE WHEN place = 4 THEN props END AS props,
  CASE op WHEN 'ddl' THEN 'alter  table ' || "table" || ' /*add*/ add column c' || e || ' int' WHEN 'query' THEN 'savepoint a' WHEN 'begin' THEN 'begin' END AS statement FROM marks)"""
)
