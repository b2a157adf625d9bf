"""Expressions and operators on small frames, including hot keys."""

import datetime as dt
import glob
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom import functions as fx
from stockloom import operators as op
from stockloom import sources as src
from stockloom.calendar import fiscal_calendar
from stockloom.session import stage_path


def one(df):
    return df.collect()[0]


def test_a_run_drops_its_stages(spark):
    import os

    from stockloom.session import materialise, stage_folder

    with stage_folder(spark) as folder:
        assert materialise(spark.range(3), "numbers").count() == 3
        local = folder.removeprefix("file:")
        assert os.listdir(local)
    assert not os.path.exists(local)


def test_key_with_null_part_is_null(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b").select(fx.build_key(["a", "b"]).alias("k"))
    assert one(df).k is None


def test_strict_comparisons_keep_null(spark):
    df = spark.sql("SELECT 1.0D AS a, CAST(NULL AS DOUBLE) AS b").select(
        fx.strict_greatest("a", "b").alias("g"), fx.strict_least("a", "b").alias("l"),
        fx.clip("b", F.lit(0.0), F.lit(1.0)).alias("c"))
    assert one(df) == (None, None, None)


def test_boundary_differences(spark):
    row = one(spark.sql("""SELECT DATE '2000-01-01' AS sat, DATE '2000-01-02' AS sun, DATE '2000-01-03' AS mon,
        DATE '1999-12-31' AS eve""").select(
        fx.week_boundary_diff("sun", "sat").alias("a"), fx.week_boundary_diff("mon", "sun").alias("b"),
        fx.year_boundary_diff("sat", "eve").alias("c"), fx.shift_date(F.lit(dt.date(2020, 2, 29)), -1, "year").alias("d")))
    assert row == (1, 0, 1, dt.date(2019, 2, 28))


@pytest.mark.parametrize("errors,expected", [
    ((1, 1, 1), "b"), ((1, 1, 2), "b"), ((2, 1, 1), "b"), ((1, 2, 1), "tie"),
    ((1, 2, 3), "a"), ((3, 2, 1), "c"), ((3, 1, 2), "b"), ((None, 1, 2), None),
])
def test_select_by_least(spark, errors, expected):
    lits = [F.lit(e).cast("double") for e in errors]
    df = spark.range(1).select(fx.select_by_least(lits, [F.lit(x) for x in "abc"], F.lit("tie")).alias("v"))
    assert one(df).v == expected


def test_output_transform_order(spark):
    values = [(-2.5,), (2.5,), (None,)]
    df = spark.createDataFrame(values, "x double").select(
        fx.output_transform("x", True, False).alias("r"), fx.output_transform("x", True, True).alias("b"))
    assert [tuple(r) for r in df.collect()] == [(-3.0, 0.0), (3.0, 3.0), (0.0, 0.0)]


def test_fiscal_year_dates(spark):
    cal = fiscal_calendar(spark, dt.date(2018, 1, 1), dt.date(2021, 12, 31))
    year = one(cal.filter("fscl_yr = 2019").agg(F.min("cal_dt").alias("a"), F.max("cal_dt").alias("b")))
    assert year == (dt.date(2019, 2, 4), dt.date(2020, 2, 2))
    assert cal.filter("dayofweek(fscl_wk_end_dt) <> 1 OR fscl_wk_nbr > 53").count() == 0
    ends = cal.groupBy("fscl_yr", "fscl_prd_nbr").agg(
        F.max("cal_dt").alias("m"), F.max("fscl_prd_end_dt").alias("e")).filter("fscl_yr BETWEEN 2018 AND 2020")
    assert ends.filter("m <> e").count() == 0


def test_calendar_must_not_end_before_it_starts(spark):
    with pytest.raises(ValueError):
        fiscal_calendar(spark, dt.date(2000, 1, 2), dt.date(2000, 1, 1))


NULL_KEYS = [(None, None, 3.0), (None, None, 1.0), ("a", None, 2.0), ("a", None, 5.0), ("a", "b", 4.0), (None, "b", None)]


def test_null_keys_are_groups(spark):
    """As in a window, for frames in memory and from files."""
    local = spark.createDataFrame(NULL_KEYS, "k string, l string, x double")
    path = stage_path(spark, "null-keys")
    local.write.parquet(path)
    groups = {}
    for k, l, x in NULL_KEYS:  # noqa: E741
        groups.setdefault((k, l), []).append(x)
    for df in (local, spark.read.parquet(path)):
        rows = lambda d: sorted(((r.k, r.l, r.x, r.v) for r in d.collect()), key=repr)
        want = lambda f: sorted(((k, l, x, f(groups[k, l], x)) for k, l, x in NULL_KEYS), key=repr)
        keys = ["k", "l"]
        assert rows(op.count_over(df, keys, "v")) == want(lambda g, x: len(g))
        assert rows(op.max_over(df, keys, "x", "v")) == want(lambda g, x: max((y for y in g if y is not None), default=None))
        share = lambda g, x: None if x is None else x / sum(g)
        assert rows(op.share_of_total(df, keys, "x", "v")) == want(share)
        rest = lambda g, x: None if x is None or len(g) < 2 else sum(g) - x
        assert rows(op.leave_one_out_mean(df, keys, "x", "v")) == want(rest)
        numbers = lambda g, x: 1 + sum(y < x for y in g) if x is not None else 1
        assert rows(op.row_number_by(df, keys, "x", name="v")) == want(numbers)
        halves = {(r.k, r.l): r.v for r in op.partition_percentile(df, keys, "x", [0.5], ["v"]).collect()}
        assert halves == {g: statistics.median(v) for g, v in groups.items() if v != [None]}
        clipped = {(r.k, r.l, r.x): r.v for r in op.clip_percentile(df, keys, "x", 0.0, 1.0, "v").collect()}
        assert clipped == {(k, l, x): x for k, l, x in NULL_KEYS}


def test_row_numbers_of_dates_texts_and_ties(spark):
    rng = random.Random(6)
    rows = [(None if i % 11 == 0 else "k", rng.choice([None, dt.date(2020, 1, 1), dt.date(2021, 5, 5)]), rng.choice("abé"), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, d date, t string, i long")
    for order, down in (("d", False), ("d", True), ("t", False), ("t", True)):
        place = F.col(order).desc() if down else F.col(order).asc()
        from pyspark.sql import Window
        want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(place, "i")))
        got = op.row_number_by(df, ["k"], order, ties=["i"], descending=down)
        assert sorted(map(repr, got.select("i", "rn").collect())) == sorted(map(repr, want.select("i", "rn").collect()))


def test_rows_alike_in_every_column_are_all_numbered(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), F.lit(1.0).alias("x"))
    assert sorted(r.rn for r in op.row_number_by(df, ["k"], "x").collect()) == list(range(1, 1001))


def test_a_preference_table_is_replaced(spark):
    csv, table = stage_path(spark, "csv"), stage_path(spark, "table")
    old = spark.createDataFrame([("x", 1)], "other string, n int")
    src.write_stage(old, table)
    spark.createDataFrame([("0025", "1.5"), ("0026", None)], "dept string, factor string").write.option("header", True).csv(csv)
    got = src.replace_table(spark, csv, "dept string, factor double", table)
    assert got.dtypes == [("dept", "string"), ("factor", "double")]
    assert sorted(map(tuple, got.collect()), key=repr) == [("0025", 1.5), ("0026", None)]
    with pytest.raises(Exception):
        src.replace_table(spark, csv, "dept int, factor boolean", stage_path(spark, "bad")).collect()


def test_pivot_finds_its_names(spark):
    df = spark.createDataFrame([("1", "b", 2.0), ("1", "a", 1.0), (None, "a", 5.0), ("All", "z", 9.0), ("1", None, 3.0)], "r string, n string, v double")
    assert op.pivot_sum(df, "r", "n", "v").columns == ["r", "a", "b"]
    assert op.pivot_sum(df, "r", "n", "v", drop=None).columns == ["r", "a", "b", "z"]
    with pytest.raises(ValueError):
        op.pivot_sum(df, "r", "n", "v", most_names=1)


def test_local_fallback_folder_is_stable(spark, monkeypatch):
    from stockloom import session

    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: None)
    assert session.shared_dir(spark) == session.shared_dir(spark)


def hot_rows(seed=1, n=3000):
    """A third of all rows on one key, many equal values."""
    rng = random.Random(seed)
    keys = ["hot"] * (n // 3) + [f"k{rng.randrange(40)}" for _ in range(n - n // 3)]
    return [(k, float(rng.randrange(50)) if rng.random() < 0.5 else rng.random() * 100, i) for i, k in enumerate(keys)]


def test_row_number_is_exact_on_a_hot_key(spark):
    rows = hot_rows()
    df = op.row_number_by(spark.createDataFrame(rows, "k string, x double, id long"), ["k"], "x", ties=["id"])
    expected = {}
    for k in {r[0] for r in rows}:
        for i, r in enumerate(sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))):
            expected[r[2]] = i + 1
    assert {r.id: r.rn for r in df.collect()} == expected


def test_percentile_is_exact_on_a_hot_key(spark):
    rows = hot_rows(2)
    ps = [0.0, 0.01, 0.5, 0.9, 1.0]
    df = op.partition_percentile(
        spark.createDataFrame(rows, "k string, x double, id long"), ["k"], "x", ps, ["a", "b", "c", "d", "e"])
    for row in df.collect():
        values = [r[1] for r in rows if r[0] == row.k]
        assert np.allclose([row.a, row.b, row.c, row.d, row.e], np.quantile(values, ps), rtol=0, atol=1e-9)


def test_percentile_of_single_and_null(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", None), ("b", None)], "k string, x double")
    got = op.partition_percentile(df, ["k"], "x", [0.5], ["m"]).collect()
    assert [(r.k, r.m) for r in got] == [("a", 3.0)]


def test_range_join_matches_brute_force(spark):
    rng = random.Random(3)
    left, right = [rng.randrange(-50, 50) for _ in range(80)], [rng.randrange(-50, 50) for _ in range(80)]
    a = spark.createDataFrame([(x,) for x in left], "a int")
    b = spark.createDataFrame([(x,) for x in right], "b int")
    got = sorted(tuple(r) for r in op.range_join(a, b, "a", "b", -3, 7).collect())
    assert got == sorted((x, y) for x in left for y in right if -3 <= y - x <= 7)


def test_contains_any_compares_whole_entries(spark):
    orders = spark.createDataFrame([(1, "12,345"), (2, "1234,5"), (3, "")], "po long, skus string")
    items = spark.createDataFrame([(12,), (34,)], "sku long")
    got = {r.po: r.hit for r in op.contains_any(orders, "skus", items, "sku", ["po"], "hit").collect()}
    assert got == {1: True, 2: False, 3: False}


def test_anti_join_ignores_null_on_the_right(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r.k for r in op.anti_missing(left, right, ["k"]).collect()] == [2]


def test_latest_version_keeps_ties(spark):
    df = spark.createDataFrame([(1, "2020-01-01", "a"), (1, "2020-01-02", "b"), (1, "2020-01-02", "c")], "k int, d string, v string")
    assert sorted(r.v for r in op.latest_version(df, ["k"], "d").collect()) == ["b", "c"]


def test_total_row_is_sum_of_detail(spark):
    df = op.with_total(spark.createDataFrame([("a", 1), ("a", 2), (None, 4)], "k string, x int"), "k", {"s": F.sum("x")})
    got = {r.k: r.s for r in df.collect()}
    assert got == {"a": 3, None: 4, "TOTAL": 7}


def test_weighted_deviation(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 5, 1)], "k int, x int, n int")
    row = one(op.weighted_pop_sd(df, ["k"], "x", "n"))
    assert row["sd"] == pytest.approx(statistics.pstdev([2, 2, 2, 5]))


def test_chunked_export_limits_files(spark):
    path = stage_path(spark, "upload")
    src.export_chunked(spark.createDataFrame([(i, None) for i in range(25)], "a int, b string"), path, rows_per_file=10)
    files = [open(f).read().splitlines() for f in glob.glob(f"{path}/part-*.csv")]
    assert sum(len(f) - 1 for f in files) == 25 and all(len(f) <= 11 for f in files)
    assert all('"' not in line for f in files for line in f)


def test_typed_load_rejects_bad_rows(spark):
    path = stage_path(spark, "bad")
    spark.createDataFrame([("1",), ("x",)], "a string").write.option("header", True).csv(path)
    with pytest.raises(Exception):
        src.load_csv_typed(spark, path, "a INT").collect()


def test_market_overrides_are_those_of_the_whole_grid(spark):
    """Same rows and totals as the override of prices already spread to stores:
    overlapping overrides, own and shared stores, NULLs, repeated rows."""
    rng = random.Random(9)
    some = lambda *v: rng.choice(v)
    prices = [(some(None, 1, 2, 3, 4), some(None, 7, 8, 9), n, some(None, 1.5, 20.0, 40.0)) for n in range(60)]
    prices += prices[:9]
    shops = [(some(7, 8, None), n) for n in range(30)] + [(7, None), (7, 3), (8, 3), (8, 3)]
    day, far = dt.date(2001, 11, 11), dt.date(2001, 12, 1)
    rules = [(sku, shop, kind, 12.0, 18.0, 30.0, day, end) for sku, shop, kind, end in (
        (1, 3, 1, far), (1, 3, 2, far), (1, 4, 3, far), (2, 5, 2, far), (2, None, 3, far), (3, 6, 1, far),
        (4, 7, 1, dt.date(2001, 11, 10)), (None, 8, 1, far))]
    df = spark.createDataFrame(prices, "sku long, mkt int, n int, q double")
    stores = spark.createDataFrame(shops, "mkt int, loc long")
    overrides = spark.createDataFrame(rules, "sku long, str long, ovrd_type int, ovrd_qty double, min_ovrd_qty double, "
                                             "max_ovrd_qty double, beg_dt date, end_dt date")
    names = ["sku", "mkt", "loc", "n", "q"]
    want = op.two_grain_override(df.join(stores, "mkt").select(names), overrides, "sku", "loc", "q", day)
    got = op.market_override(df, stores, overrides, "sku", "mkt", "loc", "q", day)
    rows = lambda d, *c: sorted(map(repr, d.select(*c).collect()))
    assert rows(got, *names) == rows(want, *names)
    totals = want.groupBy("sku", "loc").agg(F.count("*").alias("c"), F.sum("q").alias("t"))
    summed = op.market_override_totals(df, stores, overrides, "sku", "mkt", "loc", "q", day, "c", "t")
    assert rows(summed, "sku", "loc", "c", "t") == rows(totals, "sku", "loc", "c", "t")


def test_market_overrides_are_worked_out_before_the_grid(spark, tmp_path, monkeypatch):
    """Few rows meet the overrides, though every price comes out once a store."""
    from checks import basic_queries
    from checks.inputs import Inputs
    from stockloom.operators import joins

    lines = spark.range(4000).selectExpr(
        "id l_orderkey", "id % 300 l_partkey", "id % 100 l_suppkey", "cast(1 + id % 7 as int) l_linenumber",
        "cast(id % 50 as double) l_quantity", "0.1D l_discount", "timestamp_seconds(900000000 + 86400 * (id % 500)) l_shipdate")
    suppliers = spark.range(100).selectExpr("id s_suppkey", "cast(id % 4 as int) s_nationkey")
    for name, rows in (("lineitem", lines), ("supplier", suppliers), ("part", spark.range(300).selectExpr("id p_partkey", "'n' p_name"))):
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    seen, plain = [], joins.two_grain_override

    def counted(df, *args):
        seen.append(df.count())
        return plain(df, *args)

    monkeypatch.setattr(joins, "two_grain_override", counted)
    monkeypatch.setattr(op, "two_grain_override", counted)
    queries = {q.name: q for q in basic_queries.QUERIES}
    inputs = Inputs(spark, str(tmp_path))
    grid = queries["p7_override_value"].run(inputs).count()
    assert 0 < sum(seen) < grid / 2
    seen.clear()
    totals = queries["j14_two_grain_override"].run(inputs)
    assert totals.agg(F.sum("n")).first()[0] == grid
    assert 0 < sum(seen) < grid / 8


def _grid(spark, markets, prices, shops):
    """Prices by store where two stores have overrides of their own."""
    df = spark.range(prices).selectExpr("id % 50 sku", f"cast(id * 7 % {markets} as int) mkt", "id % 2 tier", "double(id % 40) q")
    stores = spark.range(shops).selectExpr(f"cast(pmod(hash(id), {markets}) as int) mkt", "id loc")
    day = dt.date(2001, 11, 11)
    overrides = spark.createDataFrame([(7, 1, 1, 12.0, 18.0, 30.0, day, day), (9, 3, 2, 12.0, 18.0, 30.0, day, day)],
                                      "sku long, str long, ovrd_type int, ovrd_qty double, min_ovrd_qty double, "
                                      "max_ovrd_qty double, beg_dt date, end_dt date")
    return df, stores, op.market_override(df, stores, overrides, "sku", "mkt", "loc", "q", day)


def test_the_grid_of_market_overrides_takes_little_space(spark, tmp_path):
    """Written, a price's stores are a sequence that repeats: well under a byte a row."""
    df, stores, grid = _grid(spark, 5, 1500, 5000)
    grid.write.parquet(f"{tmp_path}/grid")
    rows = spark.read.parquet(f"{tmp_path}/grid").count()
    assert rows == df.join(stores, "mkt").count() > 1_000_000
    assert sum(p.stat().st_size for p in (tmp_path / "grid").glob("*.parquet")) < 0.7 * rows


def test_the_grid_of_one_market_is_many_tasks_work(spark):
    """Also where its stores are too many to be broadcast."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        grid = _grid(spark, 1, 400, 600)[2]
        tasks = [r["count"] for r in grid.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sum(tasks) == 400 * 600 and max(tasks) < sum(tasks) / 2


def test_a_hot_key_stays_where_its_rows_are(spark, tmp_path):
    """Four keys' limits come to the rows: no task reads a key's rows whole."""
    path = f"{tmp_path}/rows"
    spark.range(4000).selectExpr("nullif(id % 4, 3) k", "id", "double(id % 997) x").write.parquet(path)
    rows = spark.read.parquet(path)
    for done in (op.clip_percentile(rows, ["k"], "x", 0.01, 0.99, "v"), op.share_of_total(rows, ["k"], "x", "v")):
        plan = done._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        assert done.count() == 4000


def test_whole_numbers_are_rounded_like_others(spark):
    from checks.registry import _spark_column

    values = [None, 0.0, -0.0, 3.0, -7.0, 2.5, 0.1234565, -0.0000004, 1e300, 2.0**53 + 2, float("inf"), float("-inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    old = F.when(F.round("x", 6) == 0, F.lit(0.0)).otherwise(F.round("x", 6))
    assert list(map(repr, df.select(_spark_column("x", "f")).collect())) == list(map(repr, df.select(old.alias("x")).collect()))
