"""Payload encoding: protocol buffers and compression, as Arrow UDFs."""

from __future__ import annotations

import gzip
import zlib
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.model import OPERATION

# Message fields with their numbers on the wire. (name, number, kind, repeated)
FIELDS = {
    "Column": [("is_null", 1, "bool", 0), ("value", 2, "string", 0)],
    "Row": [("before", 1, "Column", 1), ("after", 2, "Column", 1)],
    "ColumnDef": [("name", 1, "string", 0), ("sql_type", 2, "string", 0), ("inner_type", 3, "int32", 0), ("unsigned", 4, "bool", 0), ("key", 5, "string", 0), ("charset", 6, "string", 0)],
    "TableDef": [("database", 1, "string", 0), ("name", 2, "string", 0), ("columns", 3, "ColumnDef", 1)],
    "Progress": [("flavor", 1, "string", 0), ("server_id", 2, "uint32", 0), ("log_name", 3, "string", 0), ("log_pos", 4, "uint32", 0), ("gset", 5, "string", 0)],
    "OperationHeader": [("server_id", 1, "uint32", 0), ("type", 2, "int32", 0), ("timestamp", 3, "uint32", 0), ("log_pos", 4, "uint32", 0)],
    "Operation": [
        ("header", 1, "OperationHeader", 0), ("next_log_name", 6, "string", 0), ("next_log_pos", 7, "uint32", 0), ("gtid", 8, "string", 0), ("last_committed", 9, "int64", 0), ("sequence_number", 10, "int64", 0),
        ("database", 11, "string", 0), ("statement", 12, "string", 0), ("table", 13, "TableDef", 0), ("rows", 14, "Row", 1), ("progress", 15, "Progress", 0),
    ],
    "Payload": [("ops", 1, "Operation", 1)],
    "Message": [("version", 1, "uint32", 0), ("producer_id", 2, "uint64", 0), ("seq", 5, "uint64", 0), ("more_fragment", 6, "bool", 0), ("group_id", 7, "uint64", 0), ("compression", 8, "int32", 0), ("payload", 15, "bytes", 0)],
}
NONE, ZLIB, GZIP = 0, 1, 2


@cache
def message_class(name: str):
    """The message type, built in code: no jar and no generated module are needed."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    kinds = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(name="tidemark.proto", package="tidemark", syntax="proto3")
    for message, fields in FIELDS.items():
        m = file.message_type.add(name=message)
        for field, number, kind, many in fields:
            f = m.field.add(name=field, number=number, label=kinds.LABEL_REPEATED if many else kinds.LABEL_OPTIONAL)
            if kind in FIELDS:
                f.type, f.type_name = kinds.TYPE_MESSAGE, f".tidemark.{kind}"
            else:
                f.type = getattr(kinds, f"TYPE_{kind.upper()}")
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"tidemark.{name}"))


def _fill(message, value, name: str) -> None:
    for field, _, kind, many in FIELDS[name]:
        v = value.get(field) if value is not None else None
        if v is None:
            continue
        if many:
            for x in v:
                _fill(getattr(message, field).add(), x, kind)
        elif kind in FIELDS:
            getattr(message, field).SetInParent()
            _fill(getattr(message, field), v, kind)
        else:
            setattr(message, field, v)


def encode_ops(ops: list[dict]) -> bytes:
    """The payload of operations given as nested dicts; unset and null fields are left out."""
    payload = message_class("Payload")()
    for op in ops:
        _fill(payload.ops.add(), op, "Operation")
    return payload.SerializeToString()


def _read(message, name: str) -> dict:
    """Every field; those not on the wire have their zero value, absent messages are None."""
    out = {}
    for field, _, kind, many in FIELDS[name]:
        if many:
            out[field] = [_read(x, kind) for x in getattr(message, field)]
        elif kind in FIELDS:
            out[field] = _read(getattr(message, field), kind) if message.HasField(field) else None
        else:
            out[field] = getattr(message, field)
    return out


def decode_ops(payload: bytes) -> list[dict]:
    return [_read(op, "Operation") for op in message_class("Payload").FromString(payload).ops]


@F.pandas_udf(T.BinaryType())
def to_payload(ops_json: pd.Series) -> pd.Series:
    """From JSON arrays of operations."""
    import json

    return ops_json.map(lambda j: None if j is None else encode_ops(json.loads(j)))


@F.pandas_udf(T.StringType())
def payload_json(payload: pd.Series) -> pd.Series:
    import json

    return payload.map(lambda p: None if p is None else json.dumps(decode_ops(p)))


def from_payload(payload: Column) -> Column:
    return F.from_json(payload_json(payload), T.ArrayType(OPERATION))


@F.pandas_udf(T.BinaryType())
def compress(payload: pd.Series, kind: pd.Series) -> pd.Series:
    make = {NONE: bytes, ZLIB: zlib.compress, GZIP: lambda p: gzip.compress(p, mtime=0)}
    return pd.Series([None if p is None else make[k](p) for p, k in zip(payload, kind, strict=True)])


@F.pandas_udf(T.BinaryType())
def decompress(payload: pd.Series, kind: pd.Series) -> pd.Series:
    make = {NONE: bytes, ZLIB: zlib.decompress, GZIP: gzip.decompress}
    return pd.Series([None if p is None else make[k](p) for p, k in zip(payload, kind, strict=True)])
