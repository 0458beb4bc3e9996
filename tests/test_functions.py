"""Table-driven cases of text, positions, schemas, splitting, checkpoints, codecs."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import codec, text
from tidemark.operators import checkpoint, filters, schemas, transport
from tidemark.operators.ops import row_action
from tidemark.plans.model import spark_type
from tidemark.sources import other
from tidemark.sources.dump import statements


@pytest.mark.parametrize("s", ["create  index\tnächste on t(x)", "\n\ncreate index nächste\r\non t(x)", "-- why\n-- and why not\ncreate index nächste on t(x)", "/* a */create /* b\n * c */ index nächste on t(x)", "  # note\ncreate index nächste on t(x)"])
def test_statements_have_one_normal_form(spark, s):
    assert spark.createDataFrame([(s,)], "s string").select(F.trim(text.normalised(F.col("s")))).first()[0] == "CREATE INDEX NÄCHSTE ON T(X)"


def test_escapes():
    for letter, stands_for in text.ESCAPES.items():
        assert text.unescaped(f"\\{letter}") == stands_for
    assert text.unescaped("größe\\%\\_\\\\\\r\\0\\") == "größe%_\\\r\0"


@given(st.text())
def test_unescape_reads_what_escaping_wrote(value):
    letters = {v: k for k, v in text.ESCAPES.items()}
    written = "".join("\\" + letters.get(c, c) if c in letters or c in "\\'\"" else c for c in value)
    assert text.unescaped(written) == value
    assert text.unescaped(value.replace("\\", "\\\\")) == value


@given(st.lists(st.one_of(st.integers().map(str), st.just("NULL"), st.text().map(lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'")), min_size=1), st.sampled_from([",", ", ", ",   "]))
def test_values_split_where_they_were_joined(values, comma):
    assert text.split_values(comma.join(values)) == values


def test_split_of_nothing_and_of_an_open_quote():
    assert text.split_values("") == []
    for cut in ("'", "7, 'seven", "'it\\'s"):
        with pytest.raises(ValueError):
            text.split_values(cut)


def test_dump_statements_join_lines_and_drop_an_open_end():
    assert list(statements(["CREATE TABLE a (\r\n", "x int);\n", "\n", "INSERT\n"])) == ["CREATE TABLE a (x int);"]


@pytest.mark.parametrize("key, kept", [("shop.orders", True), ("shop.orders_2024", True), ("shop.orders_tmp", False), ("audit.orders", False), ("shop.returns", False), ("workshop.orders", True)])
def test_filter_verdicts(spark, key, kept):
    rule = filters.TableFilter((r"shop\.orders.*",), (r"audit\..*", r".*_tmp"))
    assert spark.range(1).select(rule.keeps(F.lit(key))).first()[0] is kept


def test_bad_pattern_is_an_error_at_once():
    with pytest.raises(Exception):
        filters.TableFilter(("(",))


def test_row_action_of_another_event_is_an_error(spark):
    with pytest.raises(Exception):
        spark.range(1).select(row_action(F.lit("QUERY_EVENT"))).collect()


def test_schema_mirror():
    m = schemas.Mirror()
    m.apply("CREATE TABLE test.canal_test (id int AUTO_INCREMENT, content blob NULL, name varchar(100), PRIMARY KEY (id), KEY k (name))")
    m.apply("alter table canal_test ADD `age` INT(5) NOT NULL AFTER name", "test")
    assert [(c.name, c.key) for c in m.table("TEST", "Canal_Test").columns] == [("id", "PRI"), ("content", ""), ("name", "MUL"), ("age", "")]
    m.apply("alter table test.canal_test modify name varchar(50) first, change age years int unsigned, drop column content")
    assert [(c.name, c.unsigned) for c in m.table("test", "canal_test").columns] == [("name", False), ("id", False), ("years", True)]
    m.apply("rename table test.canal_test to test.x")
    m.apply("create table y like x", "test")
    m.apply("drop table if exists z, x", "test")
    assert sorted(m.tables) == [("test", "y")]
    with pytest.raises(Exception):
        m.apply("alter table y add a int, add a int", "test")
    assert len(m.table("test", "y").columns) == 3
    assert m.table("mysql", "ha_health_check").columns
    with pytest.raises(KeyError):
        m.table("test", "none")


def test_fold_skips_a_repeated_position_and_keeps_failures():
    history, failed = schemas.folded([(1, "f", 4, "d", "create table a (x int)"), (1, "f", 4, "d", "create table a (x int)"), (2, "f", 9, "d", "drop table none"), (3, "f", 12, "d", "alter table a add y int")])
    assert [h[0] for h in history] == [1, 3] and [f[0] for f in failed] == [2]


def test_halving_keeps_order_and_sends_each_once():
    assert transport.halved([5, 4, 6, 4, 20, 1], 10) == [(0, 1), (1, 3), (3, 4), (4, 5), (5, 6)]
    out = transport.halved([3] * 17, 10)
    assert [i for a, b in out for i in range(a, b)] == list(range(17)) and all(3 * (b - a) <= 10 for a, b in out)
    assert transport.halved([], 10) == []


def test_codec_round_trip():
    op = {"header": {"server_id": 66693, "type": 4, "timestamp": 1545490602, "log_pos": 803916}, "table": {"database": "test", "name": "test1", "columns": [{"name": "id", "sql_type": "int(10) unsigned", "inner_type": 3, "unsigned": True, "key": "PRI"}]}, "rows": [{"after": [{"is_null": False, "value": "255"}, {"is_null": True}]}]}
    back = codec.decode_ops(codec.encode_ops([op]))[0]
    assert back["header"] == op["header"] and back["table"]["columns"][0]["unsigned"] and back["rows"][0]["after"][1] == {"is_null": True, "value": ""} and back["progress"] is None


def test_checkpoints(tmp_path):
    store = checkpoint.FileStore(str(tmp_path / "c" / "state.json"))
    assert store.load() is None
    m = checkpoint.Manager(store)
    at = {"kafka1": {"server_id": 1, "log_name": "mysql-bin.000002", "log_pos": 99}, "kafka2": {"server_id": 1, "log_name": "mysql-bin.000002", "log_pos": 199}}
    for n in at:
        m.register(n, lambda n=n: at[n])
    with pytest.raises(ValueError):
        m.register("kafka1", dict)
    m.save()
    again = checkpoint.Manager(store)
    assert again.least()["log_pos"] == 99 and again.last("kafka2")["log_pos"] == 199 and again.last("new")["log_pos"] == 0
    assert not m.done(1, "mysql-bin.000002", 150)
    at["kafka1"]["log_pos"] = 150
    assert m.done(1, "mysql-bin.000002", 150)
    m.align(1, "mysql-bin.000002", 150)
    at["kafka2"]["server_id"] = 2
    m.save()
    assert checkpoint.Manager(store).least() == m.aligned
    (tmp_path / "c" / "state.json").write_text("{")
    with pytest.raises(ValueError):
        checkpoint.Manager(store)


def test_offsets_and_addresses(tmp_path):
    assert other.kafka_offsets(-2, 9) is None and other.kafka_offsets(8, 9) is None and other.kafka_offsets(4, 9) == (5, 9) and other.kafka_offsets(0, 9, True) == (8, 9)
    with pytest.raises(ValueError):
        other.kafka_offsets(10, 9)
    assert other.host_port("a:3306") == ("a", 3306)
    for bad in ("a", ":1", "a:b"):
        with pytest.raises(ValueError):
            other.host_port(bad)
    (tmp_path / "c.toml").write_text('[[sink]]\nname = "a"\ntype = "kafka"\n')
    with pytest.raises(ValueError):
        other.config(str(tmp_path / "c.toml"))


def test_types():
    assert spark_type("bigint(20) unsigned").simpleString() == "decimal(20,0)" and spark_type("decimal(12,3)").simpleString() == "decimal(12,3)" and spark_type("decimal(65,3)").simpleString() == "string"
    assert spark_type("longtext").simpleString() == "string" and spark_type("tinyint").simpleString() == "tinyint" and spark_type("blob").simpleString() == "binary"
