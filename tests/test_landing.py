"""Incremental landing and the handover from snapshot to changes."""

from pyspark.sql import functions as F

from emporia.plans import changes, inputs
from emporia.sources import landing

SOURCE = "k long, v string, mark long, gone boolean"


def full(spark, dest, dt):
    return sorted((tuple(r)[:3] for r in landing.read_full(spark, dest, dt).collect()), key=str)


def test_two_loads_equal_a_full_one(spark, tmp_path):
    dest = str(tmp_path)
    day1 = [(1, "a", 1, False), (2, "b", 2, False), (2, "bb", 3, False), (None, "null key", 4, False), (9, "mark unknown", None, False)]
    day2 = [*day1, (1, "aa", 5, False), (3, "c", 6, None), (2, "bb", 7, True), (None, "again", 8, False)]
    assert landing.land_increment(spark.createDataFrame(day1, SOURCE), dest, "2024-01-01", ["k"], "mark", "gone") == {"from": None, "to": 4}
    assert landing.land_increment(spark.createDataFrame(day2, SOURCE), dest, "2024-01-03", ["k"], "mark", "gone") == {"from": 4, "to": 8}
    want = [(None, "again", 8), (1, "aa", 5), (3, "c", 6), (9, "mark unknown", None)]
    assert full(spark, dest, "2024-01-03") == sorted(want, key=str)
    inc = spark.read.parquet(f"{dest}/inc/dt=2024-01-03")
    assert inc.count() == 4


def test_a_load_can_be_run_again(spark, tmp_path):
    dest = str(tmp_path)
    rows = spark.createDataFrame([(i % 20, f"v{i}", i, False) for i in range(100)], SOURCE)
    for dt, top in (("2024-01-01", 40), ("2024-01-02", 70), ("2024-01-03", 99)):
        landing.land_increment(rows.filter(F.col("mark") <= top), dest, dt, ["k"], "mark")
    before = full(spark, dest, "2024-01-03")
    # An earlier day again, then the later one: the marks are each day's own.
    assert landing.land_increment(rows.filter("mark <= 70"), dest, "2024-01-02", ["k"], "mark") == {"from": 40, "to": 70}
    assert landing.land_increment(rows, dest, "2024-01-03", ["k"], "mark") == {"from": 70, "to": 99}
    assert full(spark, dest, "2024-01-03") == before == sorted(((i % 20, f"v{i}", i) for i in range(80, 100)), key=str)
    # Nothing new: the day before, and its mark.
    assert landing.land_increment(rows, dest, "2024-01-04", ["k"], "mark") == {"from": 99, "to": 99}
    assert full(spark, dest, "2024-01-04") == before


def test_handover_neither_loses_nor_repeats(spark, small):
    log = changes.parse_changes(inputs.change_log(spark, small), inputs.CHANGE_ROW)
    flat = changes.flatten_change(log, inputs.CHANGE_ROW)
    at = 400
    snapshot = changes.current_state(flat.filter(F.col("lsn") <= at), ["user_id"]).select(*inputs.CHANGE_ROW.names)
    for low in (0, 200, at):
        # The log is followed from ``low`` on, before or when the snapshot is taken.
        both = changes.handover([(snapshot, "public", "events", at)], log.filter(F.col("source.lsn") > low))
        kept = changes.flatten_change(changes.filter_tables(both, "public", "events"), inputs.CHANGE_ROW)
        assert kept.filter("op = 'r' and ts_ms = 0").count() == snapshot.count()
        assert kept.filter(F.col("lsn") > at).count() == flat.filter(F.col("lsn") > at).count()
        state = changes.current_state(kept, ["user_id"]).select(*inputs.CHANGE_ROW.names)
        want = changes.current_state(flat, ["user_id"]).select(*inputs.CHANGE_ROW.names)
        assert state.exceptAll(want).isEmpty() and want.exceptAll(state).isEmpty()


def test_marks_are_per_table(spark):
    row = "struct<id:long>"
    rows = spark.sql(f"""select cast(null as {row}) before, named_struct('id', id) after, 'u' op, id ts_ms,
        named_struct('schema', 'public', 'table', if(id % 2 = 0, 'a', 'b'), 'lsn', if(id = 9, null, id)) source from range(10)""")
    marks = spark.createDataFrame([("public", "a", 3), ("public", "a", 5), ("other", "b", 99)], changes.MARKS)
    assert sorted(r.ts_ms for r in changes.after_marks(rows, marks).collect()) == [1, 3, 5, 6, 7, 8, 9]
