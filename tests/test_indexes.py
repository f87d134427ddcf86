"""Grid, gram and interval indexes against comparing everything with everything."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from support import rows
from millrace.operators.intervals import counted_within
from millrace.operators.joins import gram_pairs, resolved
from millrace.operators.nearest import nearest

PLACES = "place int, y double, x double"
POINTS = "n int, lat double, lon double, place string"


def plain_nearest(points, places):
    ids = np.array([p[0] for p in places])
    y, x = (np.array([p[k] for p in places]) for k in (1, 2))
    out = []
    for lat, lon in points:
        dy, dx = y - lat, (x - lon) * np.cos(np.radians(lat))
        d = dy * dy + dx * dx
        out.append(int(ids[d == d.min()].min()))
    return out


def looked_up(spark, points, places):
    df = spark.createDataFrame([(i, *p, "taken") for i, p in enumerate(points)], POINTS).drop("place")
    got = nearest(df, "lat", "lon", spark.createDataFrame(places, PLACES), "place", "y", "x")
    return {r["n"]: r["place"] for r in got.collect()}


def test_ten_thousand_places_in_crowds(spark):
    rng = np.random.default_rng(1)
    places = [(i, *map(float, rng.normal([17.4, 78.4], 0.002) if i % 3 == 0 else rng.uniform([17, 78], [18, 79]))) for i in range(10_000)]
    points = [tuple(map(float, rng.uniform([16.5, 77.5], [18.5, 79.5]))) for _ in range(600)]
    points += [tuple(map(float, rng.normal([17.4, 78.4], 0.002))) for _ in range(600)] + [(17.4, 78.4)] * 3000
    points += [(0.0, 0.0), (-60.0, 179.0), (89.9, 10.0)]
    got = looked_up(spark, points, places)
    assert [got[i] for i in range(len(points))] == plain_nearest(points, places)


def test_ties_repeats_and_odd_positions(spark):
    places = [(7, 1.0, 1.0), (3, 1.0, 1.0), (5, 1.0, 3.0), (9, -1.0, 1.0), (1, None, 1.0)]
    points = [(1.0, 2.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0)]
    got = looked_up(spark, [*points, (None, 1.0), (float("nan"), 1.0), (1.0, None)], places)
    assert got == {**dict(enumerate(plain_nearest(points, places[:4]))), 4: None, 5: None, 6: None}
    assert looked_up(spark, points, [(4, 0.5, 0.5)]) == dict.fromkeys(range(4), 4)
    assert looked_up(spark, points, []) == dict.fromkeys(range(4))
    assert looked_up(spark, [], places) == {}


def test_no_term_meets_all_names_of_one_beginning(spark):
    names = [(i, f"Supplier#{i * 7919 % 10**9:09d}") for i in range(3000)]
    terms = [n[k:] for (_, n), k in zip(names, [0, 3, 8, 9, 10, 11] * 100)] + ["Supplier#zz", "plier#00000", "  SUPPLIER#000000000 "]
    table = spark.createDataFrame(names, "id int, name string")
    asked = spark.createDataFrame([(t,) for t in set(terms)], "t string")
    assert gram_pairs(asked.where("t NOT LIKE '%lier#00000'"), "t", table).count() < 20 * len(set(terms))
    got = dict(rows(resolved(asked, "t", table)))
    for t in set(terms):
        text = t.strip().lower()
        exact = int(text) if text.isdigit() and int(text) < 3000 else None
        assert got[t] == (exact if exact is not None else min((i for i, n in names if text in n.lower()), default=None)), t


def test_intervals_of_any_length(spark):
    rng = random.Random(3)
    at = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(10**6), microseconds=rng.choice([0, 0, 1, 999_999]))
    keys = [1] * 8 + [2, 3, None]  # one key holds most rows
    events = [(rng.choice(keys), at()) for _ in range(4000)] + [(1, None)]
    spans = [(rng.choice(keys), b, b + dt.timedelta(seconds=int(rng.choice([1, 60, 3600, 10**5, 10**6, 0, -5]) * rng.random())))
             for b in (at() for _ in range(300))]
    spans += spans[:20] + [(1, None, at()), (2, at(), None), (9, at(), dt.datetime(2025, 1, 1))]
    spans.append((1, events[5][1], events[5][1] + dt.timedelta(microseconds=1)))
    got = counted_within(spark.createDataFrame(spans, "k int, b timestamp, e timestamp"),
                         spark.createDataFrame(events, "k int, t timestamp"), "k", "b", "e", "t", "n")
    want = {(k, b, e, 0 if None in (k, b, e) else sum(x == k and t is not None and b <= t < e for x, t in events)) for k, b, e in spans}
    assert rows(got) == sorted(want, key=repr)
    none = spark.createDataFrame([], "k int, b timestamp, e timestamp")
    assert counted_within(none, spark.createDataFrame(events, "k int, t timestamp"), "k", "b", "e", "t").count() == 0


def test_one_long_interval_among_short_ones_unfolds_little(spark):
    begin = dt.datetime(2024, 1, 1)
    spans = [(1, begin + dt.timedelta(minutes=i), begin + dt.timedelta(minutes=i, seconds=30)) for i in range(1000)]
    spans.append((1, begin - dt.timedelta(days=3000), begin + dt.timedelta(days=3000)))
    events = spark.range(1000).select(F.lit(1).alias("k"), (F.lit(begin) + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("t"))
    got = rows(counted_within(spark.createDataFrame(spans, "k int, b timestamp, e timestamp"), events, "k", "b", "e", "t"))
    assert sorted(n for *_, n in got) == [1] * 1000 + [1000]


def test_only_counted_rows_are_broadcast(spark, monkeypatch):
    """The many places stay where they are, whatever size a plan takes them to have."""
    from millrace.operators import nearest as module

    plans, keep = [], module.checkpointed
    monkeypatch.setattr(module, "checkpointed", lambda df: (plans.append(df._jdf.queryExecution().sparkPlan().toString()), keep(df))[1])
    places = spark.range(4000).selectExpr("CAST(id AS int) AS place", "17 + id % 61 / 61 AS y", "78 + id % 67 / 67 AS x")
    points = [(17.2 + i / 7, 78.1 + i / 9) for i in range(5)]
    want = plain_nearest(points, [tuple(r) for r in places.collect()])
    df = spark.createDataFrame([(i, *p, "taken") for i, p in enumerate(points)], POINTS).drop("place")
    for limit in (module.BROADCAST_ROWS, 0):
        monkeypatch.setattr(module, "BROADCAST_ROWS", limit)
        plans.clear()
        got = {r["n"]: r["place"] for r in nearest(df, "lat", "lon", places, "place", "y", "x").collect()}
        assert [got[i] for i in range(5)] == want
        met = [p for p in plans if "Join" in p]
        assert met and all(("BroadcastHashJoin" in p) == bool(limit) for p in met)
        # What is repeated for nine cells, and broadcast, are the few positions.
        assert all("_lat" in line and "_id" not in line for p in met for line in p.splitlines() if "Generate" in line)
