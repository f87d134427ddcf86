"""Split windows against a plain computation, with one key holding most rows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from support import rows
from millrace.operators.ordered import numbered, ranked_by_value, running_sum, shifted, split_by_order

random.seed(7)
# (key, amount or null, id): key a is hot, amounts tie often, keys may be null.
DATA = [(random.choice(["a"] * 6 + ["b", "c", None]), random.choice([None, 1, 1, 1, 2, 3, 5, 8]), i)
        for i in range(600)]


def groups():
    out = {}
    for key, amount, i in DATA:
        out.setdefault(key, []).append((amount, i))
    return out


def descending(member):
    amount, i = member
    return (amount is None, -(amount or 0), i)


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(DATA, "k string, amount int, id int").repartition(5)


ORDER = [("amount", True), ("id", False)]


@pytest.mark.parametrize("buckets", [1, 7, 200])
def test_numbers(df, buckets):
    got = rows(numbered(df, ["k"], ORDER, "n", buckets).select("k", "id", "n"))
    want = [(k, i, n + 1) for k, members in groups().items()
            for n, (_, i) in enumerate(sorted(members, key=descending))]
    assert got == sorted(want, key=repr)


def test_numbers_over_the_whole_table(df):
    got = dict(rows(numbered(df, [], [("id", False)], "n", 50).select("id", "n")))
    assert got == {i: i + 1 for _, _, i in DATA}


def test_a_hot_key_lies_in_many_parts(df):
    sizes = rows(split_by_order(df, ["k"], ORDER, {}, 60).groupBy("k", "_part").count().where("k = 'a'"))
    hot = len(groups()["a"])
    assert len(sizes) > 20 and max(n for _, _, n in sizes) < hot / 4


@pytest.mark.parametrize("ahead", [False, True])
def test_neighbours(df, ahead):
    got = rows(shifted(df, ["k"], ORDER, "amount", "v", ahead, 90).select("k", "id", "v"))
    want = []
    for k, members in groups().items():
        ordered = sorted(members, key=descending)
        for n, (_, i) in enumerate(ordered):
            j = n + 1 if ahead else n - 1
            want.append((k, i, ordered[j][0] if 0 <= j < len(ordered) else None))
    assert got == sorted(want, key=repr)


def test_running_sum(df):
    rows_ = df.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    got = rows(running_sum(rows_, ["k"], [("id", False)], "amount", "s", 80).select("k", "id", "s"))
    want = []
    for k, members in groups().items():
        total = None
        for amount, i in sorted(members, key=lambda m: m[1]):
            if amount is not None:
                total = (total or Decimal(0)) + amount
            want.append((k, i, total))
    assert got == sorted(want, key=repr)


def test_ranks_share_ties(df, spark):
    got = {(r["k"], r["id"]): (r["r"], r["d"])
           for r in ranked_by_value(df, ["k"], "amount", True, "r", "d", 30).collect()}
    df.createOrReplaceTempView("ranked_input")
    want = {(r["k"], r["id"]): (r["r"], r["d"]) for r in spark.sql(
        "SELECT k, id, rank() OVER w AS r, dense_rank() OVER w AS d FROM ranked_input "
        "WINDOW w AS (PARTITION BY k ORDER BY amount DESC)").collect()}
    assert got == want


NAN, LOW = float("nan"), -(1 << 31)
HARD = [(random.choice(["a"] * 4 + ["b"]), random.choice([NAN, None, 0.0, -1.5, float("inf"), float("-inf")]),
         random.choice([LOW, 0, 5, None, (1 << 31) - 1]), random.choice(["x", "Y", "", None, "é"]), i) for i in range(300)]


@pytest.fixture(scope="module")
def hard(spark):
    df = spark.createDataFrame(HARD, "k string, d double, n int, t string, id int").repartition(3)
    df.createOrReplaceTempView("hard")
    return df


@pytest.mark.parametrize("parts", [1, 20])
@pytest.mark.parametrize("column, descending", [(c, down) for c in ("d", "n", "t") for down in (False, True)])
def test_any_order_equals_a_plain_window(spark, hard, column, descending, parts):
    """NaN, the lowest int, nulls and text, in both directions."""
    order = [(column, descending), ("id", False)]
    out = numbered(hard, ["k"], order, "number", parts).select("id", "number")
    near = shifted(hard, ["k"], order, "id", "previous", False, parts).select("id", "previous")
    total = running_sum(hard, ["k"], order, "id", "total", parts).select("id", "total")
    ranks = ranked_by_value(hard, ["k"], column, descending, "rank", "dense", parts).select("id", "rank", "dense")
    got = rows(out.join(near, "id").join(total, "id").join(ranks, "id"))
    by = f"PARTITION BY k ORDER BY {column} {'DESC' if descending else 'ASC'}"
    want = rows(spark.sql(
        f"SELECT id, row_number() OVER w, lag(id) OVER w, sum(id) OVER ({by}, id ROWS UNBOUNDED PRECEDING), "
        f"rank() OVER r, dense_rank() OVER r FROM hard WINDOW w AS ({by}, id), r AS ({by})"))
    assert got == want


def test_empty(spark, hard):
    assert rows(numbered(hard.limit(0), ["k"], [("id", False)])) == []
    assert rows(ranked_by_value(hard.limit(0), [], "n")) == []


def test_salary_ties(spark):
    staff = spark.createDataFrame([("Charlie", "IT", 60000), ("Grace", "IT", 60000), ("Alice", "IT", 50000)],
                                  "name string, department string, salary int")
    out = ranked_by_value(staff, ["department"], "salary", True, "rank", "dense")
    assert rows(out.select("name", "rank", "dense")) == [("Alice", 3, 2), ("Charlie", 1, 1), ("Grace", 1, 1)]


def test_a_part_depends_on_the_row_alone(df):
    """However the rows lie when they are read again, no row changes its part; nothing is written to pin it."""
    first = rows(split_by_order(df, ["k"], ORDER, {}, 40).select("id", "_part"))
    assert first == rows(split_by_order(df.repartition(11, "id"), ["k"], ORDER, {}, 40).select("id", "_part"))
    assert len({part for _, part in first}) > 30


def test_cuts_of_every_kind_of_column(spark):
    """Columns whose values must come back exactly from the plan's constant, or rows near a cut would be counted twice."""
    base = spark.range(400).withColumn("id", F.col("id").cast("int")).withColumns({
        "ts": F.timestamp_micros(F.lit(1767225600000000) + F.col("id") % 97), "day": F.date_add(F.lit("2026-01-01"), F.col("id") % 13),
        "local": F.expr("timestamp_ntz'2026-03-29 02:30:00.000001' + make_dt_interval(0, 0, 0, id % 31 / 1000000)"),
        "exact": (F.col("id") % 89 / F.lit(7)).cast("decimal(30,12)"), "real": (F.col("id") % 83 / F.lit(3)).cast("float"),
        "bytes": F.encode(F.concat(F.lit("é\0"), (F.col("id") % 11).cast("string")), "utf-8"), "flag": F.col("id") % 2 == 0,
        "pair": F.struct((F.col("id") % 5).alias("a"), F.when(F.col("id") % 3 > 0, "x\"\n").alias("b"))})
    base.createOrReplaceTempView("kinds")
    for key in ("flag", "pair", "bytes"):
        for column in ("ts", "day", "local", "exact", "real", "bytes", "pair"):
            got = rows(numbered(base, [key], [(column, True), ("id", False)], "n", 25).select("id", "n"))
            want = rows(spark.sql(f"SELECT id, row_number() OVER (PARTITION BY {key} ORDER BY {column} DESC, id) FROM kinds"))
            assert got == want, (key, column)


def test_columns_named_like_a_constants_fields(spark):
    named = spark.createDataFrame([(i % 3, -i, str(i)) for i in range(200)], "c0 int, c1 int, cuts string")
    got = rows(running_sum(named, ["c0"], [("c1", False)], "c1", "s", 9).select("c1", "s"))
    assert got == rows(named.selectExpr("c1", "sum(c1) OVER (PARTITION BY c0 ORDER BY c1)"))
