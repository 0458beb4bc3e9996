"""Schemas and codes of the changelog."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "binary": T.BinaryType(), "timestamp": T.TimestampType(), "decimal(20|0)": T.DecimalType(20, 0), "map<string|string>": T.MapType(T.StringType(), T.StringType())}


def _flat(ddl: str) -> T.StructType:
    """A struct of simple fields; needs no session, so that workers can import this module. A comma inside a type is written as a bar."""
    return T.StructType([T.StructField(*(lambda n, k: (n, _KINDS[k]))(*f.split())) for f in ddl.split(",")])


# Operation codes on the wire, and their names in JSON.
OPERATIONS = {"rotate": 0, "gtid": 1, "begin": 2, "commit": 3, "insert": 4, "update": 5, "delete": 6, "query": 7, "ddl": 8}
ROW_OPERATIONS = ("insert", "update", "delete")

# Column type codes.
TYPES = {
    "decimal": 0, "tiny": 1, "short": 2, "long": 3, "float": 4, "double": 5, "null": 6, "timestamp": 7, "longlong": 8, "int24": 9, "date": 10, "time": 11, "datetime": 12, "year": 13, "newdate": 14, "varchar": 15, "bit": 16,
    "timestamp2": 17, "datetime2": 18, "time2": 19, "json": 245, "newdecimal": 246, "enum": 247, "set": 248, "tinyblob": 249, "mediumblob": 250, "longblob": 251, "blob": 252, "varstring": 253, "string": 254, "geometry": 255,
}

POSITION = _flat("log_name string, log_pos bigint, server_id bigint")
PROGRESS = _flat("flavor string, server_id bigint, log_name string, log_pos bigint, gset string")
COLUMN = _flat("is_null boolean, value string")
ROW = T.StructType([T.StructField("before", T.ArrayType(COLUMN)), T.StructField("after", T.ArrayType(COLUMN))])
COLUMN_DEF = _flat("name string, sql_type string, inner_type int, unsigned boolean, key string, charset string")
TABLE_DEF = T.StructType([T.StructField("database", T.StringType()), T.StructField("name", T.StringType()), T.StructField("columns", T.ArrayType(COLUMN_DEF))])
HEADER = _flat("server_id bigint, type int, timestamp bigint, log_pos bigint")
OPERATION = T.StructType(
    [T.StructField("header", HEADER), *_flat("next_log_name string, next_log_pos bigint, gtid string, last_committed bigint, sequence_number bigint, database string, statement string").fields,
     T.StructField("table", TABLE_DEF), T.StructField("rows", T.ArrayType(ROW)), T.StructField("progress", PROGRESS)]
)
MESSAGE = _flat("version bigint, producer_id decimal(20|0), seq decimal(20|0), more_fragment boolean, group_id decimal(20|0), compression int, payload binary")
CHECKPOINT = _flat("sink string, flavor string, server_id bigint, name string, pos bigint, gset string, ctx map<string|string>")
SCHEMA_HISTORY = _flat("seq bigint, log_name string, log_pos bigint, snapshot string, db string, statement string, ts timestamp")


def spark_type(sql_type: str, unsigned: bool = False) -> T.DataType:
    """The Spark type that holds a column of a SQL type; text that doesn't fit any stays a string."""
    head, _, rest = sql_type.lower().partition("(")
    args = [int(x) for x in rest.split(")")[0].split(",") if x.strip().isdigit()]
    unsigned = unsigned or "unsigned" in sql_type.lower()
    head = head.split()[0]
    whole = {"tinyint": (T.ByteType(), T.ShortType()), "smallint": (T.ShortType(), T.IntegerType()), "mediumint": (T.IntegerType(), T.IntegerType()), "int": (T.IntegerType(), T.LongType()), "integer": (T.IntegerType(), T.LongType()), "bigint": (T.LongType(), T.DecimalType(20, 0))}
    if head in whole:
        return whole[head][unsigned]
    if head in ("decimal", "numeric"):
        precision, scale = (args + [10, 0])[:1][0], args[1] if len(args) > 1 else 0
        return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()
    if head in ("time",):
        return T.DayTimeIntervalType()
    kinds = {"float": T.FloatType(), "double": T.DoubleType(), "date": T.DateType(), "datetime": T.TimestampNTZType(), "timestamp": T.TimestampType(), "year": T.ShortType(), "bit": T.BinaryType(), "set": T.ArrayType(T.StringType())}
    if head in kinds:
        return kinds[head]
    return T.BinaryType() if head.endswith("blob") or head in ("binary", "varbinary", "geometry") else T.StringType()
