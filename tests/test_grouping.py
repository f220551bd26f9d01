"""Group wait, regroup and repeat against a plain walk over every look."""

import datetime as dt
import random

import pytest

from skylight.operators.grouping import active_intervals, grouped_notices

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "grp string, alert string, ts timestamp_ntz"


def plain(rows, wait, interval, repeat, resolve):
    """Looks one after the other, activity from the sightings themselves."""
    out = []
    for grp in {g for g, a, t in rows if g is not None and a is not None and t is not None}:
        seen = {}
        for g, a, t in rows:
            if g == grp and a is not None and t is not None:
                seen.setdefault(a, []).append(round((t - T0).total_seconds() * 1000))
        spans = []
        for a, ts in seen.items():
            ts.sort()
            start = prev = ts[0]
            for t in ts[1:] + [None]:
                if t is None or t - prev > resolve * 1000:
                    spans.append((a, start, prev + resolve * 1000))
                    start = t
                prev = t
        t = -1
        while any(s > t for _, s, _ in spans):
            opened = min(s for _, s, _ in spans if s > t)
            look, told, last = opened + wait * 1000, set(), None
            while True:
                active = {a for a, s, e in spans if s <= look < e}
                if not active:
                    break
                if active - told or look - last >= repeat * 1000:
                    out.append((grp, T0 + dt.timedelta(milliseconds=look), "new" if active - told else "repeat", len(active), len(active - told)))
                    told, last = active, look
                look += interval * 1000
            t = look
    return sorted(out)


def run(spark, rows, **opts):
    got = grouped_notices(spark.createDataFrame(rows, SCHEMA).repartition(5), "grp", "alert", "ts", **opts)
    return sorted(tuple(r) for r in got.collect())


def at(s):
    return T0 + dt.timedelta(seconds=s)


@pytest.mark.parametrize("seed,wait,interval,repeat,resolve", [(1, 30, 300, 3600, 300), (2, 30, 300, 43200, 900), (3, 900, 60, 600, 45), (4, 0, 300, 300, 1)])
def test_random_alerts(spark, seed, wait, interval, repeat, resolve):
    r = random.Random(seed)
    rows = []
    for g in range(6):
        for a in range(r.randint(1, 6)):
            for _ in range(r.randint(1, 8)):
                first, step = r.randrange(0, 60000), r.choice([1, 60, 290, 300, 301])
                rows += [(f"g{g}", f"a{a}", at(first + step * k)) for k in range(r.randint(1, 25))]
    rows += rows[:50]
    r.shuffle(rows)
    want = plain(rows, wait, interval, repeat, resolve)
    assert len(want) > 20
    assert run(spark, rows, wait_s=wait, interval_s=interval, repeat_s=repeat, resolve_s=resolve) == want


def test_three_timers(spark):
    seen = lambda alert, start, end: [("g", alert, at(s)) for s in range(start, end + 1, 60)]
    rows = seen("a", 0, 50000) + seen("b", 10, 400) + seen("c", 100, 110)
    # c comes after the first look, b is not told of when it ends; then only the repeat
    assert run(spark, rows) == [("g", at(30), "new", 2, 2), ("g", at(330), "new", 3, 1), ("g", at(330 + 43200), "repeat", 1, 0)]


def test_back_before_and_after_the_next_notice(spark):
    base = [("g", "a", at(s)) for s in range(0, 6000, 100)]
    back = [("g", "b", at(0)), ("g", "b", at(2000))]
    assert [r[1] for r in run(spark, base + back)] == [at(30)]
    other = [("g", "c", at(1000))]
    assert [r[1:] for r in run(spark, base + back + other)] == [(at(30), "new", 2, 2), (at(1230), "new", 2, 1), (at(2130), "new", 2, 1)]


def test_short_alerts_nulls_and_no_rows(spark):
    assert run(spark, [("g", "a", at(0)), (None, "a", at(0)), ("g", None, at(0)), ("g", "a", None)], resolve_s=20) == []
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        run(spark, [], interval_s=0)


def test_a_busy_alert_is_one_interval(spark):
    rows = spark.range(200000).selectExpr("'g' AS grp", "'a' AS alert", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id % 7000) AS ts")
    assert [tuple(r)[:2] for r in active_intervals(rows, "grp", "alert", "ts").collect()] == [("g", "a")]
