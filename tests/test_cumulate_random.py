"""Randomised check of the cumulative GMV / Top-N report against a direct
Python evaluation of the definition (every window end of every day)."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest

from emporia.plans.gmv import gmv_topn_report


def brute(rows, step=600, n=5):
    by_day = defaultdict(list)
    for t, amt, i, p in rows:
        by_day[t.date()].append((t, Decimal(str(amt)).quantize(Decimal("0.01")), i, p))
    out = {}
    for d, evs in by_day.items():
        start = dt.datetime.combine(d, dt.time())
        first = min(int((t - start).total_seconds()) // step + 1 for t, *_ in evs)
        for k in range(first, 86400 // step + 1):
            end = start + dt.timedelta(seconds=k * step)
            inside = [e for e in evs if e[0] < end]
            ids, prods = defaultdict(Decimal), defaultdict(Decimal)
            for _, a, i, p in inside:
                ids[i] += a
                prods[p] += a
            top = lambda m: ",".join(x for x, _ in sorted(m.items(), key=lambda kv: (-kv[1], kv[0]))[:n])
            out[(start, end)] = (sum(a for _, a, _, _ in inside), top(ids), top(prods))
    return out


@pytest.mark.parametrize("seed, ids", [(1, 9), (2, 9), (3, 9), (4, 80), (5, 300)])
def test_report_matches_definition(spark, seed, ids):
    rnd = random.Random(seed)
    base = dt.datetime(2025, 10, 23)
    rows = []
    for _ in range(rnd.randint(30, 120) if ids < 10 else 700):
        t = base + dt.timedelta(days=rnd.randint(0, 1), seconds=rnd.randint(0, 86399))
        if rnd.random() < 0.1:
            t = t.replace(minute=(t.minute // 10) * 10, second=0, microsecond=0)  # on a boundary
        amt = rnd.choice([rnd.randint(1, 5000) / 100, -rnd.randint(1, 300) / 100, 10.0])
        rows.append((t, amt, f"u{rnd.randint(0, ids)}", f"p{rnd.randint(0, 6)}"))
    df = spark.createDataFrame(rows, "event_time timestamp_ntz, total_amount double, id string, product_id string")
    got = {(r.window_start, r.window_end): (r.gmv, r.top5_ids, r.top5_product_ids)
           for r in gmv_topn_report(df).collect()}
    assert got == brute(rows)
