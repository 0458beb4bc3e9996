"""python -m tidemark --cfg FILE: runs the configured sinks over a changelog; --version."""

from __future__ import annotations

import argparse

from tidemark import __version__


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("--cfg", help="TOML file: [source] path, dump, [checkpoint] path, [schema] path, [http] address, [[sink]] name, type, ..")
    parser.add_argument("--version", action="version", version=__version__)
    given = parser.parse_args(args)
    if not given.cfg:
        parser.print_help()
        return 2

    from pyspark.sql import SparkSession

    from tidemark.operators.checkpoint import FileStore
    from tidemark.sources.dump import read_statements
    from tidemark.sources.other import config, host_port
    from tidemark.streaming.bootstrap import History, first_position
    from tidemark.streaming.control import serve
    from tidemark.streaming.sinks import Engine

    cfg = config(given.cfg)
    spark = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    history = None
    if "schema" in cfg:
        history = History(spark, cfg["schema"]["path"])
        if not history.exists():
            history.reset()
    engine = Engine(spark, cfg["sink"], FileStore(cfg["checkpoint"]["path"] + "/progress.json"), history=history)
    if engine.start_position() is None and cfg["source"].get("dump"):
        first_position(None, read_statements(spark, cfg["source"]["dump"]), engine.mirror)
    server = serve(engine, *host_port(cfg["http"]["address"])) if "http" in cfg else None
    source = cfg["source"]["path"]
    log = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    engine.start(log, cfg["checkpoint"]["path"] + "/stream", cfg.get("interval")).awaitTermination()
    engine.close()
    if server is not None:
        server.shutdown()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
