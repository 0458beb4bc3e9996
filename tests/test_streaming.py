"""Streams against the batch operators: duplicates, reassembly, the binlog source, the engine."""

import pytest

from tidemark.operators import checkpoint
from tidemark.sources import synth
from tidemark.sources.binlog import COLUMNS, BinlogSource, options_of
from tidemark.streaming import processors
from tidemark.streaming.sinks import Engine


def collected(stream, name, spark):
    q = stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def test_sequence_dedup_stream(spark, tmp_path):
    rows = [(1, n, f"p{n}") for n in (1, 2, 2, 4, 3, 1, 7)] + [(2, n, f"q{n}") for n in (5, 6)]
    spark.createDataFrame(rows, "producer_id long, seq long, payload string").coalesce(1).write.parquet(str(tmp_path / "in"))
    got = collected(processors.dedup_stream(spark.readStream.schema("producer_id long, seq long, payload string").parquet(str(tmp_path / "in"))), "seq_dedup", spark)
    assert sorted((r.producer_id, r.seq) for r in got.collect()) == [(1, 1), (1, 2), (1, 3), (1, 4), (2, 5), (2, 6)]


def test_reassembly_stream(spark, tmp_path):
    rows = [(1, 1, 1, False, "ab"), (1, 2, 2, True, "c"), (1, 3, 2, False, "d"), (1, 4, 4, True, "lost"), (1, 5, 5, False, "e")]
    spark.createDataFrame(rows, "producer_id long, seq long, group_id long, more_fragment boolean, payload string").coalesce(1).write.parquet(str(tmp_path / "in"))
    got = collected(processors.reassemble_stream(spark.readStream.schema("producer_id long, seq long, group_id long, more_fragment boolean, payload string").parquet(str(tmp_path / "in"))), "fragments", spark)
    assert sorted((r.group_id, r.payload) for r in got.collect()) == [(1, "ab"), (2, "cd"), (5, "e")]


def test_binlog_source_and_engine(spark, sf_dir, tmp_path):
    ops = synth.operations(spark, sf_dir).where("e < 300")
    ops.select(*COLUMNS).write.parquet(str(tmp_path / "log"))
    spark.dataSource.register(BinlogSource)
    read = spark.read.format("binlog").option("path", str(tmp_path / "log"))
    assert read.load().count() == ops.count()
    later = read.option("serverid", "1001").option("logname", "mysql-bin.000001").option("logpos", "20000").load()
    assert later.count() == ops.where("log_pos > 20000").count()
    known = read.option("logname", "").option("logpos", "0").option("serverid", "0").option("gset", f"{synth.UUID}:1-20").load()
    assert known.count() == ops.where("gno > 20").count()
    stream = spark.readStream.format("binlog").option("path", str(tmp_path / "log")).option("batchsize", "77").load()
    assert [r.seq for r in collected(stream.select("seq"), "binlog_rows", spark).collect()] == [r.seq for r in ops.select("seq").orderBy("seq").collect()][:77]  # one batch
    for bad in ({"path": "x", "binlogformat": "STATEMENT"}, {}, {"path": "x", "gtidenabled": "true"}):
        with pytest.raises(ValueError):
            options_of(bad)
    store = checkpoint.MemoryStore()
    engine = Engine(spark, [{"name": "clicks", "type": "table", "path": str(tmp_path / "out"), "include": [r"shop\.click"]}], store)
    for name in {"click", *(r.statement.split()[2] for r in ops.where("op = 'ddl'").collect())}:  # what the schema changes are about
        engine.exec_ddl(f"create table shop.{name} (id int primary key)")
    engine.batch(ops, 0)
    once = spark.read.parquet(str(tmp_path / "out"))
    n = ops.where("op <> 'query' and (op not in ('insert', 'update', 'delete') or table = 'click')").count()
    assert once.count() == n
    engine.batch(ops, 0)  # comes again: nothing is written twice
    assert spark.read.parquet(str(tmp_path / "out")).count() == n
    assert engine.synced()["server_id"] == 1001 and store.load()["sinks"]["clicks"]["ctx"]["batch"] == 0
    assert engine.status()["mode"] == "standalone" and engine.databases() == ["shop"]


def test_a_failed_schema_change_stops_what_comes_after_it(spark, sf_dir, tmp_path):
    from tidemark.streaming.bootstrap import History
    from tidemark.streaming.sinks import Parked

    ops = synth.operations(spark, sf_dir).where("e < 600").cache()  # schema changes at 250, of a table that isn't known
    history = History(spark, str(tmp_path / "history"))
    history.reset()
    store = checkpoint.MemoryStore()
    sink = {"name": "all", "type": "table", "path": str(tmp_path / "out")}
    engine = Engine(spark, [sink], store, history=history)
    with pytest.raises(Parked):
        engine.batch(ops, 0)
    ddl = ops.where("op = 'ddl'").orderBy("seq").first()
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.agg({"seq": "max"}).first()[0] < ddl.seq and engine.synced()["log_pos"] < ddl.log_pos
    assert engine.metrics()["failed_ddl_total"] == 1 and engine.failed_ddl()["statement"] == ddl.statement
    with pytest.raises(Parked):
        engine.batch(ops, 1)
    for d in ops.where("op = 'ddl'").collect():
        name = d.statement.split()[2]
        if name not in engine.tables("shop"):
            engine.exec_ddl(f"create table shop.{name} (id int primary key)")
    engine.retry_ddl()
    engine.batch(ops, 0)  # comes again, and goes on behind what was written
    seqs = [r.seq for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(seqs) == len(set(seqs)) == ops.where("op <> 'query'").count()
    again = Engine(spark, [sink], store, history=history)
    assert again.start_position()["log_pos"] == engine.synced()["log_pos"]
    assert history.rows().count() == 1 and again.mirror.tables == engine.mirror.tables


def test_servers_change_at_a_barrier(spark, sf_dir, tmp_path):
    from tidemark.streaming.sinks import Hooks

    seen = []

    class Noted(Hooks):
        def before_server_change(self, server_id):
            seen.append((server_id, dict(engine.synced()), engine.manager.aligned["server_id"]))

    ops = synth.operations(spark, sf_dir).where("e < 200 and op <> 'ddl'").selectExpr("*", "if(e < 100, 1009, 1004) as new").drop("server_id").withColumnRenamed("new", "server_id")
    engine = Engine(spark, [{"name": n, "type": "table", "path": str(tmp_path / n)} for n in "ab"], checkpoint.MemoryStore(), Noted())
    engine.batch(ops, 0)
    assert [s[0] for s in seen] == [1004] and seen[0][1]["server_id"] == seen[0][2] == 1009
    assert engine.synced()["server_id"] == 1004 and engine.metrics()["operation_total"] == ops.count()


def test_kafka_sink_numbers_on_from_its_checkpoint(spark, sf_dir):
    from tidemark.streaming import wire
    from tidemark.streaming.sinks import KafkaSink

    sent = []

    class Kept(KafkaSink):
        def send(self, out):
            sent.extend(bytes(r.value) for r in out.collect())

    ops = synth.operations(spark, sf_dir).where("op <> 'query'").cache()
    sink = Kept({"name": "k", "type": "kafka", "brokers": "b:1", "topic": "t", "max_payload": 200, "compression": "gzip"})
    sink.write(ops.where("e < 100"), 0)
    after = Kept(sink.config)
    after.restore(sink.context())
    after.write(ops.where("e >= 100 and e < 200"), 1)
    back = spark.createDataFrame([(i, b) for i, b in enumerate(sent)], "offset long, value binary").select("offset", wire.off_the_wire("value").alias("m")).select("offset", "m.*")
    assert [r.seq for r in back.orderBy("offset").collect()] == list(range(1, len(sent) + 1))
    assert wire.operations(back).count() == ops.where("e < 200").count()


def test_control_plane(spark):
    import json
    from urllib.request import Request, urlopen

    from tidemark.streaming.control import answer, serve

    engine = Engine(spark, [], checkpoint.MemoryStore())
    server = serve(engine)
    at = f"http://127.0.0.1:{server.server_address[1]}"
    assert json.load(urlopen(Request(f"{at}/ddl/exec", data=b"create table shop.t (id int unsigned primary key)"))) == {"ok": True}
    assert json.load(urlopen(f"{at}/schema")) == ["shop"] and json.load(urlopen(f"{at}/schema/shop")) == ["t"]
    assert json.load(urlopen(f"{at}/schema/shop/t"))["columns"][0]["unsigned"] is True
    assert b"tidemark_failed_ddl_total 0" in urlopen(f"{at}/metrics").read()
    server.shutdown()
    assert answer(engine, "GET", "/status")[1]["mode"] == "init" and answer(engine, "POST", "/ddl/retry")[0] == 400 and answer(engine, "GET", "/x")[0] == 404


def test_sets_of_transactions():
    from tidemark.operators import gtid

    assert gtid.written(gtid.parsed("B:1-3:5, b:4, a:9")) == "a:9,b:1-5" and gtid.parsed("0-1-7,2-3-9") == {"0": [(0, 7)], "2": [(0, 9)]} and gtid.parsed("") == {}
    for bad in ("a:3-1", "a:x", "1-2"):
        with pytest.raises(ValueError):
            gtid.parsed(bad)


def test_bootstrap_and_command_line(spark, sf_dir, tmp_path):
    from tidemark.__main__ import main
    from tidemark.operators.schemas import Mirror
    from tidemark.sources.dump import read_statements
    from tidemark.streaming.bootstrap import History, first_position

    (tmp_path / "dump.sql").write_text("-- header;\nCHANGE MASTER TO MASTER_LOG_FILE='mysql-bin.000007', MASTER_LOG_POS=1234;\nUSE `shop`;\nCREATE TABLE `click` (\n `id` int,\n PRIMARY KEY (`id`));\nINSERT INTO `click` VALUES (1);\nopen")
    mirror = Mirror()
    at = first_position(None, read_statements(spark, str(tmp_path / "dump.sql")), mirror)
    assert (at["log_name"], at["log_pos"]) == ("mysql-bin.000007", 1234) and mirror.table("shop", "click").columns[0].key == "PRI"
    history = History(spark, str(tmp_path / "history"))
    history.reset()
    assert history.last() is None and history.save(mirror, "f", 4, "shop", "s") and not history.save(mirror, "f", 4, "shop", "s")
    assert history.last().tables == mirror.tables and history.kept().count() == 1
    assert first_position({"log_pos": 1}, None, mirror) == {"log_pos": 1}

    synth.operations(spark, sf_dir).where("e < 50").write.parquet(str(tmp_path / "log"))
    (tmp_path / "c.toml").write_text(f'[source]\npath = "{tmp_path}/log"\n[checkpoint]\npath = "{tmp_path}/ckp"\n[[sink]]\nname = "all"\ntype = "table"\npath = "{tmp_path}/out"\n')
    assert main(["--cfg", str(tmp_path / "c.toml")]) == 0 and main(["--cfg", str(tmp_path / "c.toml")]) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == synth.operations(spark, sf_dir).where("e < 50 and op <> 'query'").count()
