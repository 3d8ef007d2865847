"""The paths taken at scale, forced on small data, against plain computations."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from zonalis.operators import windows as w
from zonalis.operators.imputation import group_medians
from zonalis.operators.ordering import split_by_day, split_tail, test_days as days_of_test
from zonalis.plans.adapters import telemetry
from zonalis.plans.components import components
from zonalis.plans.numbering import global_index
from zonalis.plans.quantiles import exact_percentiles
from zonalis.plans.skew import lookup_join
from zonalis.plans.slices import Slices


def same(a, b, by):
    left = [tuple(r) for r in a.orderBy(*by).collect()]
    right = [tuple(r) for r in b.orderBy(*by).collect()]
    assert len(left) == len(right)
    for x, y in zip(left, right):
        assert x == pytest.approx(y, nan_ok=True) if all(isinstance(v, (int, float)) for v in [*x, *y]) else x == y


@pytest.fixture(scope="module")
def hot(spark, small):
    """Telemetry with one zone that holds a third of all rows."""
    df = telemetry(spark, small)
    return df.withColumn("square_id", F.when(F.col("event_id") % 3 == 0, "sq_hot").otherwise(F.col("square_id"))).cache()


WIDTH = 86_400 * 2


def test_sliced_lag_equals_window(hot):
    zone = Window.partitionBy("square_id").orderBy("ts", "event_id")
    want = hot.select("event_id", *[F.when(F.col("square_id").isNotNull(), F.lag("svr2", k).over(zone)).alias(f"l{k}") for k in (1, 3, 7)])
    got = Slices(hot, ["square_id"], ["ts", "event_id"], WIDTH).lags({f"l{k}": (F.col("svr2"), k) for k in (1, 3, 7)})
    same(got.select("event_id", "l1", "l3", "l7"), want, ["event_id"])


def test_sliced_lag_over_many_thin_slices(hot):
    everything = Window.orderBy("ts", "event_id")
    want = hot.select("event_id", F.lag("svr1", 5).over(everything).alias("l5"))
    got = Slices(hot, [], ["ts", "event_id"], 1800).lags({"l5": (F.col("svr1"), 5)})
    same(got.select("event_id", "l5"), want, ["event_id"])


def test_sliced_fill_equals_window(hot):
    zone = Window.partitionBy("square_id").orderBy("ts", "event_id")
    keyed = F.col("square_id").isNotNull()
    forward = F.when(keyed, F.last("svr4", ignorenulls=True).over(zone.rowsBetween(Window.unboundedPreceding, 0)))
    back = F.when(keyed, F.first("svr4", ignorenulls=True).over(zone.rowsBetween(0, Window.unboundedFollowing)))
    for ahead, value in ((True, forward), (False, back)):
        got = Slices(hot, ["square_id"], ["ts", "event_id"], WIDTH).fill(["svr4"], ahead)
        same(got.select("event_id", "svr4"), hot.select("event_id", value.alias("svr4")), ["event_id"])


def test_sliced_rolling_and_sequences(hot):
    zone = Window.partitionBy("square_id").orderBy("ts", "event_id").rowsBetween(-4, -1)
    want = hot.select("event_id", F.when(F.col("square_id").isNotNull(), F.round(F.avg("svr2").over(zone), 9)).alias("m"))
    got = w.rolling_mean(hot, ["square_id"], ["ts", "event_id"], "svr2", 4, "m", WIDTH).select("event_id", F.round("m", 9).alias("m"))
    same(got, want, ["event_id"])
    narrow = w.sequence_windows(hot, ["square_id"], ["ts", "event_id"], ["svr1", "hour"], 6, "svr3", WIDTH).select("event_id", "window", "label")
    wide = w.sequence_windows(hot, ["square_id"], ["ts", "event_id"], ["svr1", "hour"], 6, "svr3", 1 << 40).select("event_id", "window", "label")
    same(narrow, wide, ["event_id"])
    assert narrow.count() > 0


def test_sliced_interpolation_and_tail(hot):
    for operator in (
        lambda width: w.interpolate_series(hot.select("event_id", "ts", "svr2"), [], ["ts", "event_id"], "svr2", width).select("event_id", F.round("svr2", 9)),
        lambda width: split_tail(hot.select("event_id", "ts", "square_id"), ["square_id"], ["ts", "event_id"], 0.2, width).select("event_id", "is_tail"),
        lambda width: w.difference_series(hot.select("event_id", "ts", "svr1"), [], ["ts", "event_id"], "svr1", 1, 1, 7, width).select("event_id", F.round("svr1_diff", 9)),
    ):
        same(operator(WIDTH), operator(1 << 40), ["event_id"])


def test_interpolation_against_numpy(spark):
    values = [None, 1.0, None, None, 4.0, float("inf"), 2.0, None]
    df = spark.createDataFrame(list(enumerate(values)), "at long, y double")
    for width in (2, 3, 100):
        got = [r.y for r in w.interpolate_series(df, [], ["at"], "y", width).orderBy("at").collect()]
        assert got == [1.0, 1.0, 2.0, 3.0, 4.0, 3.0, 2.0, 2.0]


def test_narrowing_percentiles_are_exact(hot):
    columns, q = ["svr1", "svr2", "upload_mbps"], [0.0, 0.25, 0.5, 0.9, 1.0]
    for keys in ([], ["square_id"], ["square_id", "day_id"]):
        want = exact_percentiles(hot, keys, columns, q)
        got = exact_percentiles(hot, keys, columns, q, hot_rows=50).select(*want.columns)
        rounding = [F.round(n, 9).alias(n) for n in want.columns if n not in keys]
        same(got.select(*keys, *rounding), want.select(*keys, *rounding), want.columns)


def test_percentile_of_far_apart_values(spark):
    rng = random.Random(3)
    values = [rng.choice([1, -1]) * 10 ** rng.uniform(-12, 12) for _ in range(501)] + [None] * 5
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_percentiles(df, [], ["x"], [0.5], hot_rows=10).first()[0]
    assert got == pytest.approx(float(np.median([v for v in values if v is not None])))


def test_hot_median_levels(hot):
    train, _ = split_by_day(hot)
    plain, narrowed = group_medians(train, ["svr2", "svr4"]), group_medians(train, ["svr2", "svr4"], hot_rows=20)
    for level in plain:
        names = plain[level].columns
        same(narrowed[level].select(*names), plain[level], names)


def test_lookup_join_spreads_hot_keys(spark, hot):
    table = hot.groupBy("square_id").agg(F.count(F.lit(1)).alias("n"))
    want = lookup_join(hot, table, ["square_id"]).select("event_id", "n")
    salted = lookup_join(hot, table, ["square_id"], limit=0, hot_floor=10, row_id="event_id")
    plan = salted._jdf.queryExecution().toString()
    assert "__salt" in plan
    same(salted.select("event_id", "n"), want, ["event_id"])
    assert salted.filter(F.col("n").isNull()).count() == 0
    not_null_safe = lookup_join(hot, table, ["square_id"], null_safe=False, limit=0, hot_floor=10)
    assert not_null_safe.filter(F.col("n").isNull()).count() == hot.filter(F.col("square_id").isNull()).count()


def test_small_lookup_does_not_shuffle_the_facts(hot):
    table = hot.groupBy("square_id").agg(F.count(F.lit(1)).alias("n"))
    plan = lookup_join(hot, table, ["square_id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_global_index(spark):
    df = spark.createDataFrame([(f"v{i:03d}",) for i in random.Random(1).sample(range(200), 200)], "v string").repartition(7)
    rows = global_index(df, ["v"], "at").orderBy("v").collect()
    assert [r["at"] for r in rows] == list(range(200))


def test_components_of_a_path(spark):
    n = 60
    order = random.Random(2).sample(range(n), n)
    nodes = spark.createDataFrame([(g, i) for g in (0, 1) for i in range(n)], "g int, id long")
    edges = [(0, a, b) for a, b in zip(order, order[1:])] + [(1, a, b) for a, b in zip(order[:20], order[1:20])]
    out = components(nodes, spark.createDataFrame(edges, "g int, a long, b long"), ["g"])
    got = {(r.g, r.id): r.component for r in out.collect()}
    assert {got[0, i] for i in range(n)} == {0}
    joined = set(order[:20])
    assert all(got[1, i] == (min(joined) if i in joined else i) for i in range(n))


@pytest.mark.parametrize("days,tests", [(1, 1), (2, 1), (5, 1), (12, 2), (13, 3)])
def test_split_rounds_half_even(spark, days, tests):
    df = spark.createDataFrame([(f"2024-01-{d + 1:02d}",) for d in range(days)] + [(None,)], "day_id string")
    assert len(days_of_test(df, "day_id")) == tests
    train, test = split_by_day(df)
    assert (train.count(), test.count()) == (days - tests + 1, tests)


def test_no_leakage(spark, small):
    """Changing the test days changes nothing that is learned from, or computed for, the training days."""
    from zonalis.operators.joins import attach_zone_stats
    from zonalis.operators.imputation import hierarchical_impute

    train, test = split_by_day(telemetry(spark, small))
    spoiled = test.withColumns({"svr1": F.col("svr1") * 100, "svr2": F.lit(-5.0), "upload_mbps": F.lit(None).cast("double")})
    outputs = []
    for other in (test, spoiled):
        filled, _ = hierarchical_impute(train, other, ["svr2", "upload_mbps"])
        joined, _ = attach_zone_stats(train, other)
        outputs.append((sorted(map(tuple, filled.select("event_id", "svr2", "upload_mbps").collect())),
                        sorted(map(tuple, joined.select("event_id", "zone_avg_latency", "zone_avg_upload").collect()))))
    assert outputs[0] == outputs[1]


def test_imputation_levels(spark):
    rows = [("a", "d1", 1.0), ("a", "d1", None), ("a", "d2", None), ("b", "d2", 9.0), ("c", "d2", None), ("c", "d3", None), (None, "d1", None), (None, "d1", 4.0)]
    train = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, square_id string, day_id string, x double")
    test = spark.createDataFrame([(0, "a", "d9", None), (1, "z", "d9", None), (2, "z", "d2", None)], "i int, square_id string, day_id string, x double")
    from zonalis.operators.imputation import hierarchical_impute

    a, b = hierarchical_impute(train, test, ["x"])
    assert [r.x for r in a.orderBy("i").collect()] == [1.0, 1.0, 1.0, 9.0, 9.0, 4.0, 4.0, 4.0]
    assert [r.x for r in b.orderBy("i").collect()] == [1.0, 4.0, 9.0]


def test_percentiles_of_non_finite_values_agree_on_both_paths(spark):
    inf, nan = float("inf"), float("nan")
    groups = {
        "a": [*range(50), inf, -inf], "b": [*range(50), nan], "c": [-1e308, 1e308, *range(9)], "d": [inf] * 3, "e": [-inf, -inf, 1.0, inf, nan],
        "f": [2.0 ** k for k in range(-1000, 1000, 100)],
    }
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k string, x double")
    q = [0.0, 0.25, 0.5, 0.75, 1.0]
    plain = {r[0]: tuple(r[1:]) for r in exact_percentiles(df, ["k"], ["x"], q).collect()}
    narrowed = {r[0]: tuple(r[1:]) for r in exact_percentiles(df, ["k"], ["x"], q, hot_rows=1).select("k", *[f"x_p{p:g}".replace(".", "_") for p in q]).collect()}
    assert plain.keys() == narrowed.keys()
    for k in groups:
        for x, y in zip(plain[k], narrowed[k], strict=True):
            assert x == y or (x != x and y != y) or abs(x - y) <= 1e-9 * abs(x), (k, plain[k], narrowed[k])
