"""Running values, numbers and gaps where a block or a run ends: small blocks against plain Python."""

import random

from tidemark.operators import schemas, transport, trx


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_numbers_do_not_depend_on_the_block(spark):
    df = spark.createDataFrame([(i,) for i in (0, 1, 2, 3, 7, 8, 15, 16, 31, 32)], "id long")
    assert rows_of(transport.numbered(df, "id", "n", block=4)) == rows_of(transport.numbered(df, "id", "n")) == [(i, n) for n, (i,) in enumerate(rows_of(df), 1)]


def test_gaps_across_blocks(spark):
    seqs = [1, 2, 3, 4, 5, 7, 8, 12, 16, 17, 40]
    df = spark.createDataFrame([(p, s, s) for p in (1, 2) for s in seqs for _ in range(2)], "producer_id int, seq long, offset long")
    missing = [(p, a, b) for p in (1, 2) for a, b in zip(seqs, seqs[1:], strict=False) if b > a + 1]
    assert rows_of(transport.gaps(df, block=4)) == rows_of(transport.gaps(df)) == missing
    taken = [(p, s) for p in (1, 2) for s in seqs if s <= 5]
    for block in (4, 5, 6, 1 << 16):
        assert rows_of(transport.accepted(df, block).select("producer_id", "seq")) == taken


def test_a_gap_at_the_edge_of_a_block_ends_what_is_accepted(spark):
    df = spark.createDataFrame([(1, s, s) for s in (1, 2, 3, 5, 6)], "producer_id int, seq long, offset long")
    assert [r.seq for r in transport.accepted(df, 4).orderBy("seq").collect()] == [1, 2, 3]


def test_versions_are_carried_across_blocks(spark):
    dice = random.Random(7)
    rows = [(dice.choice(["a", "b", None]), dice.choice(["t", "u"]), n, f"r{n}") for n in dice.sample(range(60), 40)]
    history = [("a", "t", 3, 3), ("a", "t", 9, None), ("a", "t", 10, 10), ("a", "t", 40, 40), ("b", "u", 0, 0), ("b", "u", 31, 31), (None, "t", 1, 1), ("c", "t", 1, 1)]
    df = spark.createDataFrame(rows, "database string, table string, seq long, note string")
    past = spark.createDataFrame(history, "database string, table string, seq long, version long")

    def version(db, table, seq):
        held = [(s, v) for d, t, s, v in history if d == db and t == table and db is not None and s <= seq]
        return max(held)[1] if held else None

    expected = sorted((seq, note, version(db, table, seq)) for db, table, seq, note in rows)
    for block in (1, 4, 10, 1 << 16):
        out = schemas.bound(df, past, block)
        assert out.columns == ["database", "table", "seq", "note", "version"]
        assert sorted((r.seq, r.note, r.version) for r in out.collect()) == expected
    none = schemas.bound(df, past.limit(0))
    assert none.count() == len(rows) and none.where("version is not null").count() == 0


def test_a_sink_flushes_after_each_thousand_empty_transactions(spark):
    """Runs of 2,500 and 999 empty transactions around one with a row; the second server's run crosses a window of 2**16 transactions."""
    kinds = ["begin", "commit"] * 2500 + ["begin", "insert", "commit"] + ["begin", "commit"] * 999
    ops = spark.createDataFrame([(1, "f", n, n, op, f"g{n}") for n, op in enumerate(kinds)], "server_id int, log_name string, log_pos long, seq long, op string, gtid string")
    commits = [n for n, op in enumerate(kinds) if op == "commit"]
    assert rows_of(trx.flush_points(ops)) == [(commits[k], "commit") for k in (999, 1999, 2500)]
    counts = spark.createDataFrame([(2, t, 0) for t in range(65_000, 66_500)] + [(2, 66_500, 1), (2, 66_501, 0)], "server_id int, trx long, rows long")
    assert rows_of(trx.empty_runs(counts)) == [(2, 65_000, 1500), (2, 66_501, 1)]
