"""Other inputs: configuration files, Kafka, JDBC."""

from __future__ import annotations

import time
import tomllib

from pyspark.sql import DataFrame, SparkSession


def config(path: str) -> dict:
    """A TOML file, with what each sink needs checked: a type, and for Kafka brokers and a topic."""
    with open(path, "rb") as f:
        out = tomllib.load(f)
    names = set()
    for sink in out.get("sink", []):
        if not sink.get("name") or sink["name"] in names:
            raise ValueError("each sink needs a name of its own")
        names.add(sink["name"])
        validate_sink(sink)
    return out


def validate_sink(sink: dict) -> None:
    if sink.get("type") not in ("kafka", "stdout", "table"):
        raise ValueError(f"unknown sink type {sink.get('type')!r}")
    if sink["type"] == "kafka" and not (sink.get("brokers") and sink.get("topic")):
        raise ValueError("a Kafka sink needs brokers and a topic")
    if sink.get("compression", "none") not in ("none", "zlib", "gzip"):
        raise ValueError(f"unknown compression {sink['compression']!r}")


def host_port(address: str) -> tuple[str, int]:
    host, sep, port = address.rpartition(":")
    if not sep or not host or not port.isdigit():
        raise ValueError(f"address must be host:port, not {address!r}")
    return host, int(port)


def kafka_offsets(acked: int, high_water: int, first_run: bool = False) -> tuple[int, int] | None:
    """(start, end) of what a restarted sink reads again; None if there is nothing. -1 is from the start."""
    if first_run:
        return max(high_water - 1, 0), high_water
    if acked < -1:
        return None
    if high_water < acked + 1:
        raise ValueError(f"the log ends at {high_water}, before what was acknowledged ({acked})")
    return None if high_water == acked + 1 else (acked + 1, high_water)


def kafka(spark: SparkSession, brokers: str, topic: str, partition: int = 0, start: int = 0, end: int | None = None) -> DataFrame:
    """Needs Spark's Kafka connector on the class path; a batch between offsets if ``end`` is given, else a stream."""
    at = lambda n: f'{{"{topic}":{{"{partition}":{n}}}}}'
    common = {"kafka.bootstrap.servers": brokers, "assign": f'{{"{topic}":[{partition}]}}', "startingOffsets": at(start), "failOnDataLoss": "true"}
    if end is None:
        return spark.readStream.format("kafka").options(**common).load()
    return spark.read.format("kafka").options(**common, endingOffsets=at(end)).load()


def jdbc(spark: SparkSession, url: str, query: str, attempts: int = 3, **options: str) -> DataFrame:
    """A query's rows; a connection that can't be made is tried again."""
    for n in range(attempts):
        try:
            return spark.read.format("jdbc").options(url=url, query=query, **options).load()
        except Exception:
            if n == attempts - 1:
                raise
            time.sleep(0.2 * (n + 1))
    raise ValueError("attempts must be positive")
