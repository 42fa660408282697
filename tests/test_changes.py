import json

from emporia.plans import changes
from emporia.plans.inputs import CHANGE_ROW


def _log(spark, events):
    return spark.createDataFrame([(json.dumps(e),) for e in events] + [("{not json",)], "value string")


def env(op, ts, lsn, after=None, before=None):
    return {"before": before, "after": after, "op": op, "ts_ms": ts, "source": {"schema": "public", "table": "t", "lsn": lsn}}


def test_current_state_snapshot_update_delete_reinsert(spark):
    r = lambda u, v: {"user_id": u, "event_type": "x", "value": v}
    events = [
        env("r", 1, 1, after=r(1, 1.0)),
        env("u", 2, 2, after=r(1, 2.0)),
        env("r", 1, 3, after=r(2, 1.0)),
        env("d", 5, 4, before={"user_id": 2}),
        env("r", 1, 5, after=r(3, 1.0)),
        env("d", 2, 6, before={"user_id": 3}),
        env("c", 3, 7, after=r(3, 9.0)),  # re-insert after delete
        env("u", 4, 8, after=r(1, 4.0)),
        env("u", 4, 9, after=r(1, 5.0)),  # equal ts_ms: log position decides
    ]
    parsed = changes.parse_changes(_log(spark, events), CHANGE_ROW)
    assert parsed.count() == len(events)  # the malformed line is dropped
    flat = changes.flatten_change(changes.filter_tables(parsed), CHANGE_ROW)
    got = {r.user_id: (r.value, r.op) for r in changes.current_state(flat, ["user_id"]).collect()}
    assert got == {1: (5.0, "u"), 3: (9.0, "c")}


def test_union_snapshot_changes(spark):
    snap = spark.createDataFrame([(1, "a", 1.0)], CHANGE_ROW)
    chg = changes.parse_changes(_log(spark, [env("u", 9, 1, after={"user_id": 1, "event_type": "b", "value": 2.0})]),
                                CHANGE_ROW)
    both = changes.union_snapshot_changes(snap, chg, "public", "t")
    assert sorted(r.op for r in both.collect()) == ["r", "u"]
    flat = changes.flatten_change(both, CHANGE_ROW)
    assert changes.current_state(flat, ["user_id"]).first().event_type == "b"
