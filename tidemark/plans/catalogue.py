"""Registered changelog queries, and the SQL that each is compared with.

Each pair states one operator twice: as this library runs it, and as plain SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import codec, text
from tidemark.operators import checkpoint, filters, gtid, ops, position, schemas, transport, trx
from tidemark.operators.ordered import previous, running
from tidemark.sources import synth
from tidemark.sources.dump import Scope, parsed
from tidemark.sources.synth import SQL_CHANGES, SQL_OPERATIONS
from tidemark.streaming import wire

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RESUME = (1001, "mysql-bin.000001", 45004)
CLICKS = filters.Sink("clicks", filters.TableFilter((r"shop\.click",)))
MIXED = filters.TableFilter((r"shop\..*",), (r"\.view$", r"sig.up"))


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def with_ops(sql: str) -> str:
    return f"WITH {SQL_OPERATIONS}\n{sql}"


def with_changes(sql: str) -> str:
    return f"WITH {SQL_CHANGES}\n{sql}"


def literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def quoted(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def values_sql(rows: list[tuple], names: str) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(quoted(v) if isinstance(v, str) or v is None else str(v) for v in r) + ")" for r in rows) + f") t({names})"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row changes per transaction that the clicks sink gets after it resumes."""
    own = filters.for_sink(synth.operations(spark, sf_dir), CLICKS)
    return trx.row_counts(position.new_since(own, *RESUME)).select("server_id", "trx", "gtid", "rows")


@query("op_headers", with_ops("SELECT seq, server_id, type, timestamp, log_pos FROM ops"))
def op_headers(spark, d):
    return synth.operations(spark, d).select("seq", ops.header().alias("h")).select("seq", "h.*").withColumn("type", F.col("type").cast("int"))


@query("row_actions", "SELECT k, CASE WHEN k LIKE 'WRITE%' THEN 'insert' WHEN k LIKE 'UPDATE%' THEN 'update' ELSE 'delete' END AS action FROM " + values_sql([(f"{a}_ROWS_EVENT{v}",) for a in ("WRITE", "UPDATE", "DELETE") for v in ("", "V1", "V2")], "k"))
def row_actions(spark, d):
    kinds = literal(spark, [(f"{a}_ROWS_EVENT{v}",) for a in ("WRITE", "UPDATE", "DELETE") for v in ("", "V1", "V2")], "k string")
    return kinds.select("k", ops.row_action(F.col("k")).alias("action"))


@query("table_filter_include_exclude", with_changes("""SELECT e, "table" FROM chg WHERE regexp_matches(database || '.' || "table", 'shop\\..*') AND NOT regexp_matches(database || '.' || "table", '\\.view$') AND NOT regexp_matches(database || '.' || "table", 'sig.up')"""))
def table_filter_include_exclude(spark, d):
    return filters.tables_kept(synth.changes(spark, d), MIXED).select("e", "table")


@query("table_filter_exclude_only", with_changes("""SELECT "table", count(*) AS n, 0::BIGINT AS kept, count(*) FILTER ("table" <> 'view') AS kept_rest FROM chg GROUP BY "table\""""))
def table_filter_exclude_only(spark, d):
    key = filters.table_key()
    strict, rest = filters.TableFilter(exclude=(r"\.view",)), filters.TableFilter(exclude=(r"\.view",), exclude_only_keeps_rest=True)
    return synth.changes(spark, d).groupBy("table").agg(F.count("*").alias("n"), F.count_if(strict.keeps(key)).alias("kept"), F.count_if(rest.keeps(key)).alias("kept_rest"))


@query("row_only_filter", with_ops("""SELECT op, count(*) AS n FROM ops WHERE op <> 'query' AND (op NOT IN ('insert', 'update', 'delete') OR "table" = 'click') GROUP BY op"""))
def row_only_filter(spark, d):
    return filters.for_sink(synth.operations(spark, d), CLICKS).groupBy("op").agg(F.count("*").alias("n"))


@query("sink_fan_out", with_ops("""SELECT sink, op, count(*) AS n FROM ops, (VALUES ('clicks', 'click'), ('all', '')) s(sink, t) WHERE op <> 'query' AND (op NOT IN ('insert', 'update', 'delete') OR t = '' OR "table" = t) GROUP BY sink, op"""))
def sink_fan_out(spark, d):
    sinks = [filters.Sink("clicks", filters.TableFilter(("none",))), filters.Sink("all"), CLICKS]
    return filters.fan_out(synth.operations(spark, d), sinks).groupBy("sink", "op").agg(F.count("*").alias("n"))


@query("dedup_by_progress", with_changes("SELECT e, server_id, log_name, log_pos FROM chg WHERE server_id <> 1001 OR (log_name, log_pos) > ('mysql-bin.000001', 45004)"))
def dedup_by_progress(spark, d):
    rows = synth.changes(spark, d).withColumn("seq", F.col("e"))
    return position.new_since(rows, *RESUME).select("e", "server_id", "log_name", "log_pos")


@query("dedup_sticky", with_ops("""SELECT seq FROM (SELECT seq, max(CASE WHEN server_id <> 1001 OR (log_name, log_pos) > ('mysql-bin.000001', 50000) THEN 1 ELSE 0 END) OVER (ORDER BY server_id, log_name, log_pos, seq) AS fresh FROM ops) WHERE fresh = 1"""))
def dedup_sticky(spark, d):
    return position.new_since(synth.operations(spark, d), 1001, "mysql-bin.000001", 50000).select("seq")


@query("fake_rotate_carry_forward", with_ops("SELECT seq, last_value(CASE WHEN timestamp = 0 THEN log_name END IGNORE NULLS) OVER (PARTITION BY server_id ORDER BY seq) AS current_log FROM ops"))
def fake_rotate_carry_forward(spark, d):
    name = F.when((F.col("op") == "rotate") & (F.col("timestamp") == 0), F.col("log_name"))
    return running(synth.operations(spark, d), "current_log", "last", name).select("seq", "current_log")


@query("previous_operation", with_ops("SELECT seq, lag(op) OVER (PARTITION BY server_id ORDER BY seq) AS before FROM ops"))
def previous_operation(spark, d):
    return previous(synth.operations(spark, d), "before", F.col("op")).select("seq", "before")


@query("server_failover_points", with_changes("SELECT min(e) AS first_e, server_id, lag(server_id) OVER (ORDER BY server_id) AS old_server FROM chg GROUP BY server_id QUALIFY old_server IS NOT NULL"))
def server_failover_points(spark, d):
    return position.server_changes(synth.changes(spark, d).withColumn("seq", F.col("e"))).withColumnRenamed("first_seq", "first_e")


FAILOVER_SQL = ", moved AS (SELECT * REPLACE (3000 - server_id AS server_id) FROM ops)"


def _falling(spark, d):
    """The log with ids that fall from server to server."""
    return synth.operations(spark, d).withColumn("server_id", 3000 - F.col("server_id"))


@query("dedup_after_failover", with_ops(FAILOVER_SQL + " SELECT seq FROM moved WHERE seq >= (SELECT min(seq) FROM moved WHERE server_id <> 1999 OR (log_name, log_pos) > ('mysql-bin.000001', 50000))").replace("\n,", ",", 1))
def dedup_after_failover(spark, d):
    return position.new_since(_falling(spark, d), 1999, "mysql-bin.000001", 50000).select("seq")


@query("progress_after_failover", with_ops(FAILOVER_SQL + " SELECT server_id, log_name, log_pos FROM moved WHERE op IN ('commit', 'ddl') ORDER BY seq DESC LIMIT 1").replace("\n,", ",", 1))
def progress_after_failover(spark, d):
    return position.newest_progress(_falling(spark, d))


@query("failover_points_of_falling_ids", with_ops(FAILOVER_SQL + " SELECT server_id, min(seq) AS first_seq, server_id + 1 AS old_server FROM moved WHERE server_id < 1999 GROUP BY server_id").replace("\n,", ",", 1))
def failover_points_of_falling_ids(spark, d):
    return position.server_changes(_falling(spark, d))


@query("gtid_start", with_ops("SELECT seq FROM ops WHERE NOT (gno BETWEEN 1 AND 50 OR gno = 77 OR gno BETWEEN 100 AND 120)"))
def gtid_start(spark, d):
    return gtid.behind(synth.operations(spark, d), f"{synth.UUID}:1-40:100-120, {synth.UUID}:30-50:77").select("seq")


@query("gtid_start_by_domain", with_ops("SELECT seq FROM ops WHERE NOT (gno % 3 = 0 AND gno <= 60 OR gno % 3 = 2 AND gno <= 9)"))
def gtid_start_by_domain(spark, d):
    numbered = synth.operations(spark, d).withColumn("gtid", F.concat_ws("-", (F.col("gno") % 3).cast("string"), F.col("server_id").cast("string"), F.col("gno").cast("string")))
    return gtid.behind(numbered, "0-1001-60,2-1001-9").select("seq")


TRX_SQL = "trx AS (SELECT *, sum(CASE WHEN op = 'begin' THEN 1 ELSE 0 END) OVER (PARTITION BY server_id ORDER BY seq)::BIGINT AS trx FROM {0}), inside AS (SELECT * FROM trx WHERE trx > 0 AND op IN ('begin', 'commit', 'insert', 'update', 'delete')), counts AS (SELECT server_id, trx, min(gtid) AS gtid, count(*) FILTER (op IN ('insert', 'update', 'delete')) AS rows, count(*) AS operations, min(seq) AS first_seq, max(seq) AS last_seq FROM inside GROUP BY ALL)"
CLICK_SQL = """own AS (SELECT * FROM ops WHERE op <> 'query' AND (op NOT IN ('insert', 'update', 'delete') OR "table" = 'click'))"""


@query("trx_assembly", with_ops(", " + TRX_SQL.format("ops") + " SELECT server_id, trx, string_agg(op, ',' ORDER BY seq) AS kinds FROM inside GROUP BY ALL").replace("\n,", ",", 1))
def trx_assembly(spark, d):
    return trx.assembled(synth.operations(spark, d))


@query("trx_row_counts", with_ops(", " + CLICK_SQL + ", " + TRX_SQL.format("own") + " SELECT * FROM counts").replace("\n,", ",", 1))
def trx_row_counts(spark, d):
    return trx.row_counts(filters.for_sink(synth.operations(spark, d), CLICKS))


@query("resumed_trx_row_counts", with_ops(", " + CLICK_SQL + ", fresh AS (SELECT * FROM own WHERE server_id <> 1001 OR (log_name, log_pos) > ('mysql-bin.000001', 45004)), " + TRX_SQL.format("fresh") + " SELECT server_id, trx, gtid, rows FROM counts").replace("\n,", ",", 1))
def resumed_trx_row_counts(spark, d):
    return flagship(spark, d)


@query("empty_trx_runs", with_ops(", " + CLICK_SQL + ", " + TRX_SQL.format("own") + ", g AS (SELECT *, trx - row_number() OVER (PARTITION BY server_id ORDER BY trx) AS g FROM counts WHERE rows = 0) SELECT server_id, min(trx) AS first_trx, count(*) AS length FROM g GROUP BY server_id, g").replace("\n,", ",", 1))
def empty_trx_runs(spark, d):
    return trx.empty_runs(trx.row_counts(filters.for_sink(synth.operations(spark, d), CLICKS)))


@query("flush_points", with_ops(", " + CLICK_SQL + ", " + TRX_SQL.format("own") + ", g AS (SELECT *, trx - row_number() OVER (PARTITION BY server_id ORDER BY trx) AS g FROM counts WHERE rows = 0), n AS (SELECT *, row_number() OVER (PARTITION BY server_id, g ORDER BY trx) AS k FROM g), ends AS (SELECT server_id, trx FROM counts WHERE rows > 0 UNION ALL SELECT server_id, trx FROM n WHERE k % 1000 = 0) SELECT seq, op FROM trx WHERE op IN ('ddl', 'rotate') OR (op = 'commit' AND (server_id, trx) IN (SELECT (server_id, trx) FROM ends))").replace("\n,", ",", 1))
def flush_points(spark, d):
    return trx.flush_points(filters.for_sink(synth.operations(spark, d), CLICKS))


@query("counters", with_ops("SELECT server_id, count(*) FILTER (op = 'begin') AS trx_total, count(*) FILTER (op IN ('insert', 'update', 'delete')) AS row_event_total, count(*) FILTER (op = 'ddl') AS ddl_total, count(*) AS operation_total FROM ops GROUP BY server_id"))
def counters(spark, d):
    return ops.counters(synth.operations(spark, d))


@query("gtid_intervals", with_changes(", n AS (SELECT DISTINCT server_id, gno FROM chg WHERE key % 7 <> 0), g AS (SELECT *, gno - row_number() OVER (PARTITION BY server_id ORDER BY gno) AS g FROM n) SELECT server_id, min(gno) AS lo, max(gno) AS hi FROM g GROUP BY server_id, g").replace("\n,", ",", 1))
def gtid_intervals(spark, d):
    return trx.gtid_intervals(synth.changes(spark, d).where("key % 7 <> 0"))


@query("gtid_set_text", with_changes(f"SELECT server_id, '{synth.UUID}:' || min(gno) || '-' || max(gno) AS gset FROM chg GROUP BY server_id"))
def gtid_set_text(spark, d):
    return trx.gtid_set_text(trx.gtid_intervals(synth.changes(spark, d)), synth.UUID)


@query("update_image_pairs", """WITH o AS (SELECT l_orderkey AS k, list(l_linenumber ORDER BY l_linenumber)[1 : 2 * (count(*) // 2)] AS r FROM lineitem GROUP BY ALL), i AS (SELECT k, r, unnest(generate_series(1, len(r) // 2)) AS i FROM o) SELECT k, i::INT AS i, r[2 * i - 1] AS b, r[2 * i] AS a FROM i""")
def update_image_pairs(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("r"))
    even = lines.withColumn("r", F.slice("r", F.lit(1), (F.size("r") / 2).cast("int") * 2)).where("size(r) > 0")
    return even.select(F.col("l_orderkey").alias("k"), F.posexplode(ops.paired(F.col("r"))).alias("i", "p")).select("k", (F.col("i") + 1).cast("int").alias("i"), F.col("p.before").alias("b"), F.col("p.after").alias("a"))


@query("unsigned_fix", "SELECT event_id, ((event_id % 256 - 128) & 255)::BIGINT AS u8, ((event_id * 7 % 65536 - 32768) & 65535)::BIGINT AS u16, ((event_id * -3)::BIGINT & 4294967295)::BIGINT AS u32, (CASE WHEN event_id > 0 THEN (18446744073709551616::HUGEINT - event_id) ELSE 0 END)::DECIMAL(20, 0)::VARCHAR AS u64 FROM events")
def unsigned_fix(spark, d):
    e = F.col("event_id")
    ev = spark.read.parquet(f"{d}/events.parquet")
    return ev.select("event_id", text.unsigned((e % 256 - 128).cast("byte"), 8).alias("u8"), text.unsigned((e * 7 % 65536 - 32768).cast("short"), 16).alias("u16"), text.unsigned((e * -3).cast("int"), 32).alias("u32"), text.unsigned(-e, 64).cast("string").alias("u64"))


@query("column_values_text", "SELECT event_id, event_type IS NULL OR event_id % 3 = 0 AS a_null, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS a, user_id::VARCHAR AS b, round(value, 2)::DECIMAL(18, 2)::VARCHAR AS c FROM events")
def column_values_text(spark, d):
    ev = spark.read.parquet(f"{d}/events.parquet").withColumn("t", F.when(F.col("event_id") % 3 != 0, F.col("event_type"))).withColumn("v", F.round("value", 2).cast("decimal(18,2)"))
    return ev.select("event_id", text.wire_value(F.col("t")).alias("x"), text.wire_value(F.col("user_id")).alias("y"), text.wire_value(F.col("v")).alias("z")).select("event_id", F.col("x.is_null").alias("a_null"), F.col("x.value").alias("a"), F.col("y.value").alias("b"), F.col("z.value").alias("c"))


STATEMENTS = ["\t create\n\nview  v as\r\nselect 1", "-- first\n-- second\nalter  table é add x int", "  # why\ntruncate t", "/* one */rename /* two\n * lines */ table p to q", "commit", "BEGIN", "revoke select on p from q", "drop schema\tp", "CREATE  DATABASE p", "update p set x = 1", "flush tables", ""]
_LITERALS = values_sql([(i, s) for i, s in enumerate(STATEMENTS)], "id, s")


def _trim_sql(c: str) -> str:
    for p, r in text.TRIM:
        c = f"regexp_replace({c}, {quoted(p)}, {quoted(r)}, 'gs')"
    return f"upper({c})"


@query("stmt_normalise", f"SELECT id, {_trim_sql('s')} AS normal FROM {_LITERALS}".replace("'gs')", "'g')"))
def stmt_normalise(spark, d):
    return literal(spark, list(enumerate(STATEMENTS)), "id int, s string").select("id", text.normalised(F.col("s")).alias("normal"))


@query("stmt_classify", with_ops(f", n AS (SELECT seq, {_trim_sql('statement')} AS s FROM ops WHERE statement IS NOT NULL) SELECT seq, CASE WHEN s = 'BEGIN' THEN 'begin' WHEN s = 'COMMIT' THEN 'commit' WHEN regexp_matches(s, '^(CREATE|DROP|ALTER|RENAME|TRUNCATE|GRANT|REVOKE|FLUSH)') THEN 'ddl' ELSE 'query' END AS kind, regexp_matches(s, '^(CREATE|DROP|ALTER|RENAME|TRUNCATE)') AS is_schema_change, regexp_matches(s, '^(CREATE|DROP) (DATABASE|SCHEMA)') AS clears FROM n").replace("'gs')", "'g')").replace("\n,", ",", 1))
def stmt_classify(spark, d):
    n = text.normalised(F.col("statement"))
    return synth.operations(spark, d).where("statement is not null").select("seq", text.statement_kind(n).alias("kind"), text.is_schema_change(n).alias("is_schema_change"), text.clears_database(n).alias("clears"))


def _history(spark, d):
    o = synth.operations(spark, d).where("op = 'ddl'")
    return o.select("database", F.split("statement", "\\s+")[2].alias("table"), "seq", F.col("seq").alias("version"))


ASOF = """SELECT o.seq, o."table", h.seq AS version FROM (SELECT * FROM ops WHERE op IN ('insert', 'update', 'delete')) o ASOF LEFT JOIN (SELECT database, split_part(regexp_replace(statement, '\\s+', ' ', 'g'), ' ', 3) AS t, seq FROM ops WHERE op = 'ddl') h ON o.database = h.database AND o."table" = h.t AND o.seq >= h.seq"""


@query("schema_asof", with_ops(ASOF))
def schema_asof(spark, d):
    rows = synth.operations(spark, d).where("op in ('insert', 'update', 'delete')")
    return schemas.bound(rows, _history(spark, d)).select("seq", "table", "version")


@query("schema_missing_fallback", with_ops(f"""SELECT seq, CASE WHEN seq % 16 = 4 THEN 'ha_health_check' ELSE "table" END AS "table", CASE WHEN seq % 16 = 4 THEN 0 ELSE coalesce(version, -1) END AS version FROM ({ASOF})"""))
def schema_missing_fallback(spark, d):
    rows = synth.operations(spark, d).where("op in ('insert', 'update', 'delete')")
    health = F.col("seq") % 16 == 4
    rows = rows.withColumn("database", F.when(health, "mysql").otherwise(F.col("database"))).withColumn("table", F.when(health, "ha_health_check").otherwise(F.col("table")))
    return schemas.with_fallback(schemas.bound(rows, _history(spark, d))).select("seq", "table", "version")


DUMP = ["CHANGE MASTER TO MASTER_LOG_FILE='log-bin.123456', MASTER_LOG_POS=98765432101;", "-- CHANGE MASTER TO MASTER_LOG_FILE='b.000001', MASTER_LOG_POS=4;", "SET @@GLOBAL.GTID_PURGED='0f0e0d0c-0000-1111-2222-333344445555:1-7:9';", "SET GLOBAL gtid_slave_pos='5-6-7,8-9-10';", "USE `größe`;", "CREATE\tTABLE `t` (`x` text);", "CREATED `t`;", "INSERT INTO `t` VALUES ('USE `t`;', NULL, 'x), (\\'y');", "INSERT INTO `t u` VALUES ();", "INSERT INTO `t` VALUES (1, 2)", ""]
_DUMP = values_sql([(i, s) for i, s in enumerate(DUMP)], "id, statement")


def _rx(p: str, g: int) -> str:
    return f"nullif(regexp_extract(statement, {quoted(p)}, {g}), '')"


@query("dump_parse", f"SELECT id, {_rx(text.BINLOG_AT, 1)} AS binlog_name, {_rx(text.BINLOG_AT, 2)}::BIGINT AS binlog_pos, coalesce({_rx(text.GTID_AT[0], 1)}, {_rx(text.GTID_AT[1], 1)}) AS gtid, {_rx(text.USE, 1)} AS use_db, regexp_matches(statement, '^CREATE\\s') AS is_create, {_rx(text.INSERT, 1)} AS \"table\", {_rx(text.INSERT, 2)} AS \"values\" FROM {_DUMP}")
def dump_parse(spark, d):
    return parsed(literal(spark, list(enumerate(DUMP)), "id int, statement string")).drop("statement")


@query("dump_values", "SELECT event_id, 3 AS n, user_id::VARCHAR AS a, '''x,' || event_type || '''' AS b, '''''' AS c FROM events")
def dump_values(spark, d):
    ev = spark.read.parquet(f"{d}/events.parquet")
    row = F.concat(F.col("user_id").cast("string"), F.lit(", 'x,"), F.col("event_type"), F.lit("',''"))
    return ev.select("event_id", text.values_of(row).alias("v")).select("event_id", F.size("v").alias("n"), F.col("v")[0].alias("a"), F.col("v")[1].alias("b"), F.col("v")[2].alias("c"))


@query("dump_unescape", "SELECT event_id, event_type || chr(10) || '''' || '\\n' || 'q' AS v FROM events")
def dump_unescape(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", text.unescape(F.concat("event_type", F.lit("\\n\\'\\\\n\\q"))).alias("v"))


@query("dump_scope", """SELECT database, "table", count(*) AS n FROM (SELECT 'shop' AS database, event_type AS "table", value FROM events) WHERE "table" IN ('click', 'view', 'error') AND "table" <> 'error' AND value > 1 GROUP BY ALL""")
def dump_scope(spark, d):
    scope = Scope(where="value > 1")
    scope.add_tables("other", "x")
    scope.add_tables("shop", "click", "view")
    scope.add_tables("shop", "error")
    scope.ignore("shop.error")
    return scope.covers(synth.changes(spark, d)).groupBy("database", "table").agg(F.count("*").alias("n"))


def _received(spark, d):
    """Messages as a consumer meets them: some twice, some of one producer missing."""
    e = F.col("event_id")
    m = spark.read.parquet(f"{d}/events.parquet").select((e % 2 + 1).alias("producer_id"), F.expr("event_id div 2").alias("seq"), e.alias("offset"), F.col("event_type").alias("payload"))
    again = m.where("offset % 10 < 3").withColumn("offset", F.col("offset") + 1000000)
    return m.unionByName(again).where("not (producer_id = 2 and (seq = 333 or seq % 1000 = 999))")


_RECEIVED = "m AS (SELECT event_id % 2 + 1 AS producer_id, event_id // 2 AS seq, event_id AS \"offset\", event_type AS payload FROM events), r AS (SELECT * FROM (SELECT * FROM m UNION ALL SELECT producer_id, seq, \"offset\" + 1000000, payload FROM m WHERE \"offset\" % 10 < 3) WHERE NOT (producer_id = 2 AND (seq = 333 OR seq % 1000 = 999)))"


@query("seq_dedup", f"WITH {_RECEIVED}, u AS (SELECT producer_id, seq, min(\"offset\") AS \"offset\", arg_min(payload, \"offset\") AS payload FROM r GROUP BY ALL), n AS (SELECT *, seq - row_number() OVER (PARTITION BY producer_id ORDER BY seq) AS g FROM u) SELECT producer_id, seq, \"offset\", payload FROM n WHERE g = -1")
def seq_dedup(spark, d):
    return transport.accepted(_received(spark, d)).select("producer_id", "seq", "offset", "payload")


@query("seq_gaps", f"WITH {_RECEIVED}, u AS (SELECT DISTINCT producer_id, seq FROM r), n AS (SELECT producer_id, seq AS after_seq, lead(seq) OVER (PARTITION BY producer_id ORDER BY seq) AS next_seq FROM u) SELECT * FROM n WHERE next_seq > after_seq + 1")
def seq_gaps(spark, d):
    return transport.gaps(_received(spark, d))


def _payloads(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("id"), F.repeat("event_type", (F.col("event_id") % 9).cast("int")).cast("binary").alias("payload"))


_PIECES = "p AS (SELECT event_id AS id, repeat(event_type, (event_id % 9)::INT) AS payload FROM events), k AS (SELECT *, greatest(1, (len(payload) + 9) // 10) AS parts FROM p), f AS (SELECT id, parts, unnest(generate_series(0, parts - 1)) AS part, payload FROM k)"


@query("message_fragments", f"WITH {_PIECES} SELECT id, part::INT AS part, parts::INT AS parts, part < parts - 1 AS more_fragment, substr(payload, part * 10 + 1, 10) AS payload FROM f")
def message_fragments(spark, d):
    return transport.fragments(_payloads(spark, d), 10).withColumn("payload", F.col("payload").cast("string"))


@query("message_numbers", f"WITH {_PIECES}, s AS (SELECT id, part, row_number() OVER (ORDER BY id, part) + 99 AS seq FROM f) SELECT id AS payload_id, seq, seq - part AS group_id FROM s")
def message_numbers(spark, d):
    return transport.messages(_payloads(spark, d), 7, 100, 10).select("payload_id", "seq", "group_id")


@query("fragment_reassembly", f"WITH {_PIECES}, s AS (SELECT id, part, parts, payload, row_number() OVER (ORDER BY id, part) + 99 AS seq FROM f) SELECT 7::BIGINT AS producer_id, min(seq) AS group_id, any_value(payload) AS payload, min(seq) AS begin_seq, max(seq) AS end_seq, min(seq) + 5 AS begin_offset, max(seq) + 5 AS end_offset FROM s GROUP BY id HAVING NOT bool_or(seq % 50 = 0)")
def fragment_reassembly(spark, d):
    sent = transport.messages(_payloads(spark, d), 7, 100, 10).withColumn("offset", F.col("seq") + 5).where("seq % 50 <> 0")
    return transport.reassembled(sent).withColumn("payload", F.col("payload").cast("string"))


@query("batch_split", "SELECT event_id AS id, i::INT AS lo, (i + 2)::INT AS hi FROM events, (VALUES (0), (2)) t(i)")
def batch_split(spark, d):
    return transport.split_batches(spark.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("id"), F.array(*map(F.lit, (5, 5, 6, 4))).alias("sizes")), 10)


def _checkpoints(spark, d):
    """A checkpoint for each event type: the last position of its transactions but the few last, none for errors."""
    c = synth.changes(spark, d).where("server_id = 1001 and key % 5 <> 0").groupBy("table").agg(F.max(F.struct("log_name", "log_pos")).alias("p"))
    zero = F.col("table") == "error"
    return c.select(F.col("table").alias("sink"), F.lit(1001).cast("long").alias("server_id"), F.when(zero, "").otherwise(F.col("p.log_name")).alias("log_name"), F.when(zero, 0).otherwise(F.col("p.log_pos")).alias("log_pos"))


_CKP = """c AS (SELECT "table" AS sink, 1001::BIGINT AS server_id, CASE WHEN "table" = 'error' THEN '' ELSE max((log_name, log_pos))[1] END AS log_name, CASE WHEN "table" = 'error' THEN 0 ELSE max((log_name, log_pos))[2] END AS log_pos FROM chg WHERE server_id = 1001 AND key % 5 <> 0 GROUP BY "table")"""


def with_ckp(sql: str) -> str:
    return f"WITH {SQL_CHANGES}, {_CKP}\n{sql}"


@query("min_progress", with_ckp("SELECT server_id, log_name, log_pos FROM c WHERE log_name <> '' ORDER BY log_name, log_pos LIMIT 1"))
def min_progress(spark, d):
    return checkpoint.least_progress(_checkpoints(spark, d))


@query("aligned_progress", with_ckp("SELECT 1001::BIGINT AS server_id, 'mysql-bin.000009' AS log_name, 77::BIGINT AS log_pos"))
def aligned_progress(spark, d):
    moved = _checkpoints(spark, d).withColumn("server_id", F.when(F.col("sink") == "click", 1002).otherwise(F.col("server_id")).cast("long"))
    return checkpoint.least_progress(moved, (1001, "mysql-bin.000009", 77))


@query("barrier_reached", with_ckp("SELECT 'all' AS which, bool_and((log_name, log_pos) >= ('mysql-bin.000001', 104)) AS reached FROM c UNION ALL SELECT 'set', bool_and((log_name, log_pos) >= ('mysql-bin.000001', 104)) FROM c WHERE log_name <> ''"))
def barrier_reached(spark, d):
    c = _checkpoints(spark, d)
    at = (1001, "mysql-bin.000001", 104)
    return checkpoint.reached(c, *at).select(F.lit("all").alias("which"), "reached").unionByName(checkpoint.reached(c.where("log_name <> ''"), *at).select(F.lit("set").alias("which"), "reached"))


@query("registered_checkpoints", with_ckp("SELECT * FROM c WHERE sink IN ('click', 'view')"))
def registered_checkpoints(spark, d):
    return checkpoint.registered(_checkpoints(spark, d), literal(spark, [("click",), ("view",), ("new",)], "sink string"))


@query("checkpoint_lookup", with_ckp("SELECT s.sink, coalesce(server_id, 0) AS server_id, coalesce(log_name, '') AS log_name, coalesce(log_pos, 0) AS log_pos FROM (VALUES ('click'), ('new')) s(sink) LEFT JOIN c USING (sink)"))
def checkpoint_lookup(spark, d):
    return checkpoint.lookup(literal(spark, [("click",), ("new",)], "sink string"), _checkpoints(spark, d))


@query("servers_aligned", with_ckp("SELECT count(DISTINCT server_id) FILTER (log_name <> '') <= 1 AS aligned FROM c"))
def servers_aligned(spark, d):
    return checkpoint.same_server(_checkpoints(spark, d))


@query("newest_document", "SELECT props AS data FROM events ORDER BY event_id DESC LIMIT 1")
def newest_document(spark, d):
    return checkpoint.newest(spark.read.parquet(f"{d}/events.parquet").select(F.col("props").alias("data"), F.col("event_id").alias("mtime")))


@query("checkpoint_context", "SELECT event_id, coalesce(CASE WHEN event_id % 2 = 0 THEN event_id END, -1) AS seq FROM events")
def checkpoint_context(spark, d):
    ctx = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("acked_seq"), F.col("event_id").cast("string"))).otherwise(F.create_map(F.lit("topic"), F.lit("t")))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", ctx.alias("ctx")).select("event_id", text.context_value(F.col("ctx"), "acked_seq", -1, "long").alias("seq"))


def _records(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("seq"), F.col("o_orderdate").cast("timestamp").alias("ts"), F.lit("shop").alias("database"), F.col("o_orderpriority").alias("table"), (F.col("o_orderkey") % 3 != 0).alias("present"))


@query("schema_retention", "SELECT o_orderkey AS seq FROM orders WHERE NOT (o_orderkey < (SELECT max(o_orderkey) FROM orders) AND o_orderdate <= TIMESTAMP '1998-01-01' - INTERVAL 7 DAY)")
def schema_retention(spark, d):
    return schemas.retained(_records(spark, d), F.lit("1998-01-01 00:00:00").cast("timestamp")).select("seq")


@query("schema_latest", "SELECT max(o_orderkey) AS seq FROM orders")
def schema_latest(spark, d):
    return schemas.latest(_records(spark, d)).select("seq")


@query("schema_listing", "SELECT 'shop' AS database, o_orderpriority AS \"table\" FROM orders GROUP BY o_orderpriority HAVING max(o_orderkey) % 3 <> 0")
def schema_listing(spark, d):
    return schemas.listing(_records(spark, d))


@query("ddl_fold", with_ops("""SELECT seq, "table", k + 1 AS columns FROM (SELECT seq, split_part(regexp_replace(statement, '\\s+', ' ', 'g'), ' ', 3) AS "table", row_number() OVER (PARTITION BY split_part(regexp_replace(statement, '\\s+', ' ', 'g'), ' ', 3) ORDER BY seq) AS k FROM ops WHERE op = 'ddl')"""))
def ddl_fold(spark, d):
    """Schema changes are folded on the driver, as each depends on those before; they are few beside the rows."""
    mirror = schemas.Mirror()
    for t in ("click", "error", "purchase", "signup", "view"):
        mirror.apply(f"CREATE TABLE shop.{t} (id int PRIMARY KEY)")
    todo = synth.operations(spark, d).where("op = 'ddl'").select("seq", "log_name", "log_pos", "database", "statement").orderBy("seq")
    history, failed = schemas.folded((tuple(r) for r in todo.toLocalIterator()), mirror)
    if failed:
        raise ValueError(f"schema changes failed: {failed[:3]}")
    return literal(spark, [(h[0], h[4], len(h[5])) for h in history], "seq long, table string, columns long")


PROGRESS = [("mysql-bin.000002", 1001, None), ("mysql-bin.000002", 1000, None), ("mysql-bin.000002", 1002, None), ("mysql-bin.000010", 4, "x:1-3"), ("", 0, None), ("mysql-bin.000002", 1001, "")]
_PROGRESS = values_sql([(i, *p) for i, p in enumerate(PROGRESS)], "id, log_name, log_pos, gset")


@query("progress_zero", f"SELECT id, CASE WHEN gset IS NOT NULL THEN gset = '' ELSE log_name = '' AND log_pos = 0 END AS zero, CASE WHEN gset <> '' THEN gset ELSE log_name || ':' || log_pos END AS text FROM {_PROGRESS}")
def progress_zero(spark, d):
    p = literal(spark, [(i, *p) for i, p in enumerate(PROGRESS)], "id int, log_name string, log_pos long, gset string").select("id", F.struct("log_name", "log_pos", "gset").alias("p"))
    return p.select("id", position.is_zero("p").alias("zero"), position.text("p").alias("text"))


@query("progress_compare", f"WITH p AS (SELECT *, CASE WHEN gset IS NOT NULL THEN gset = '' ELSE log_name = '' AND log_pos = 0 END AS zero FROM {_PROGRESS}) SELECT a.id AS x, b.id AS y, CASE WHEN a.zero AND b.zero THEN 0 WHEN a.zero THEN -1 WHEN b.zero THEN 1 WHEN (a.log_name, a.log_pos) < (b.log_name, b.log_pos) THEN -1 WHEN (a.log_name, a.log_pos) > (b.log_name, b.log_pos) THEN 1 ELSE 0 END AS c FROM p a, p b")
def progress_compare(spark, d):
    pairs = [(i, j, *p, *q) for i, p in enumerate(PROGRESS) for j, q in enumerate(PROGRESS)]
    rows = literal(spark, pairs, "x int, y int, n1 string, p1 long, g1 string, n2 string, p2 long, g2 string")
    side = lambda k: F.struct(F.col(f"n{k}").alias("log_name"), F.col(f"p{k}").alias("log_pos"), F.lit(1).alias("server_id"), F.col(f"g{k}").alias("gset"))
    return rows.select("x", "y", side(1).alias("a"), side(2).alias("b")).select("x", "y", position.compare_progress("a", "b").alias("c"))


@query("ops_json", with_ops("""SELECT seq, type, CASE WHEN op = 'gtid' THEN gtid END AS gtid, CASE WHEN op = 'ddl' THEN statement END AS statement, "table" AS name, CASE WHEN op IN ('insert', 'update') THEN key::VARCHAR END AS after_key, CASE WHEN op IN ('commit', 'ddl') THEN 'mysql' END AS flavor FROM ops WHERE op <> 'query'"""))
def ops_json(spark, d):
    j = ops.operation(synth.operations(spark, d).where("op <> 'query'")).select("seq", ops.as_json(F.col("operation")).alias("j"))
    get = lambda p, name: F.get_json_object("j", p).alias(name)
    return j.select("seq", get("$.header.type", "type"), get("$.gtid", "gtid"), get("$.statement", "statement"), get("$.table.name", "name"), get("$.rows[0].after[0].value", "after_key"), get("$.progress.flavor", "flavor")).withColumn("type", F.col("type").cast("int"))


@query("consumer_lines", with_ops("""SELECT seq, seq::VARCHAR AS first, (seq + 3)::VARCHAR AS second, op = 'rotate' AS rotates FROM ops"""))
def consumer_lines(spark, d):
    o = ops.operation(synth.operations(spark, d)).withColumn("offset", F.col("seq") + 3)
    parts = F.split("line", "\t")
    return ops.consumer_lines(o).select(parts[0].cast("long").alias("seq"), parts[0].alias("first"), parts[1].alias("second"), F.col("line").contains("next_log_name").alias("rotates"))


@query("consumer_first_messages", with_ops("SELECT seq FROM ops ORDER BY seq LIMIT 25"))
def consumer_first_messages(spark, d):
    o = ops.operation(synth.operations(spark, d)).withColumn("offset", F.col("seq") + 3)
    return ops.consumer_lines(o, most=25).select(F.split("line", "\t")[0].cast("long").alias("seq"))


WIRE_SQL = CLICK_SQL + ", " + TRX_SQL.format("own") + """, g0 AS (SELECT *, trx - row_number() OVER (PARTITION BY server_id ORDER BY trx) AS g FROM counts WHERE rows = 0),
n0 AS (SELECT *, row_number() OVER (PARTITION BY server_id, g ORDER BY trx) AS k FROM g0), ends AS (SELECT server_id, trx FROM counts WHERE rows > 0 UNION ALL SELECT server_id, trx FROM n0 WHERE k % 1000 = 0),
fl AS (SELECT *, CASE WHEN op IN ('ddl', 'rotate') OR (op = 'commit' AND (server_id, trx) IN (SELECT (server_id, trx) FROM ends)) THEN 1 ELSE 0 END AS f FROM trx),
gr AS (SELECT *, sum(f) OVER (PARTITION BY server_id ORDER BY seq) - f AS g FROM fl), whole AS (SELECT *, max(f) OVER (PARTITION BY server_id, g) AS w FROM gr)"""


@query("kafka_messages", with_ops(", " + WIRE_SQL + """ SELECT server_id, log_pos, type::INT AS type, coalesce("table", '') AS "table", CASE WHEN op = 'gtid' THEN gtid ELSE '' END AS gtid, CASE WHEN op IN ('commit', 'ddl') THEN gtid ELSE '' END AS gset, count(*) AS n FROM whole WHERE w = 1 GROUP BY ALL""").replace("\n,", ",", 1))
def kafka_messages(spark, d):
    sent = wire.messages(filters.for_sink(synth.operations(spark, d), CLICKS), 7, 100, 300, codec.ZLIB)
    raw = wire.on_the_wire(sent).withColumn("copy", F.explode(F.sequence(F.lit(1), 1 + (F.col("seq") % 3 == 0).cast("int"))))  # some come twice
    back = raw.select(F.col("seq").alias("offset"), wire.off_the_wire(F.col("value")).alias("m")).select("offset", "m.*")
    o = wire.operations(back).select("operation.*")
    return o.groupBy("header.server_id", "header.log_pos", "header.type", F.coalesce("table.name", F.lit("")).alias("table"), "gtid", F.coalesce("progress.gset", F.lit("")).alias("gset")).agg(F.count("*").alias("n"))


@query("checkpoint_document", with_ckp("SELECT sink, 'mysql' AS flavor, server_id, log_name, log_pos, CASE WHEN log_name <> '' THEN 'u:1-' || log_pos END AS gset, log_pos + 1 AS acked FROM c"))
def checkpoint_document(spark, d):
    c = _checkpoints(spark, d).select("sink", F.lit("mysql").alias("flavor"), "server_id", "log_name", "log_pos", F.when(F.col("log_name") != "", F.concat(F.lit("u:1-"), F.col("log_pos").cast("string"))).alias("gset"), F.create_map(F.lit("acked"), (F.col("log_pos") + 1).cast("string")).alias("ctx"))
    back = checkpoint.from_document(checkpoint.full_document(c))
    return back.select("sink", "flavor", "server_id", "log_name", "log_pos", "gset", F.col("ctx")["acked"].cast("long").alias("acked"))


@query("changelog_materialise", with_changes("""SELECT database, "table", key, arg_max(value, e) AS value, max(e) AS last_e FROM chg GROUP BY ALL HAVING arg_max(action, e) <> 'delete'"""))
def changelog_materialise(spark, d):
    return ops.materialised(synth.changes(spark, d))


@query("error_union", "SELECT event_type AS source, count(*) AS n FROM events WHERE event_type IN ('error', 'signup') GROUP BY ALL")
def error_union(spark, d):
    from functools import reduce

    ev = spark.read.parquet(f"{d}/events.parquet")
    return reduce(DataFrame.unionByName, (ev.where(F.col("event_type") == k).select(F.lit(k).alias("source")) for k in ("error", "signup"))).groupBy("source").agg(F.count("*").alias("n"))


def _encoded(spark, d):
    o = ops.operation(synth.operations(spark, d)).select("seq", ops.as_json(F.array("operation")).alias("j"))
    return o.select("seq", codec.compress(codec.to_payload("j"), F.lit(codec.ZLIB)).alias("p"))


@query("protobuf_roundtrip", with_ops("""SELECT seq, type::INT AS type, CASE WHEN op = 'gtid' THEN gtid ELSE '' END AS gtid, coalesce("table", '') AS "table", CASE WHEN op IN ('insert', 'update') THEN key::VARCHAR ELSE '' END AS after_key FROM ops"""))
def protobuf_roundtrip(spark, d):
    back = _encoded(spark, d).select("seq", codec.from_payload(codec.decompress("p", F.lit(codec.ZLIB)))[0].alias("o"))
    row = F.get(F.col("o.rows"), F.lit(0))
    return back.select("seq", F.col("o.header.type").alias("type"), F.col("o.gtid").alias("gtid"), F.coalesce("o.table.name", F.lit("")).alias("table"), F.coalesce(F.get(row["after"], F.lit(0))["value"], F.lit("")).alias("after_key"))


@query("zlib_roundtrip", "SELECT event_id, props FROM events")
def zlib_roundtrip(spark, d):
    ev = spark.read.parquet(f"{d}/events.parquet")
    kind = (F.col("event_id") % 3).cast("int")
    return ev.select("event_id", codec.decompress(codec.compress(F.col("props").cast("binary"), kind), kind).cast("string").alias("props"))
