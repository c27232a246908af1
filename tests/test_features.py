import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.operators import features as feat
from larder.operators.star import star_join

D0 = dt.date(2024, 1, 1)


def tables(spark, orders, lines, dishes):
    order = spark.createDataFrame(orders, "order_id long, time_date date, quantity long, total_price long")
    order = order.withColumn("time_hour", F.lit(12))
    detail = spark.createDataFrame(lines, "order_id long, dish_id long, quantity long, price long")
    dish = spark.createDataFrame(dishes, "dish_id long, dish_name string, price long")
    return order, detail, dish


def test_fan_out_and_unknown_item(spark):
    orders = [(1, D0, 5, 100)]
    lines = [(1, 10, 1, 30), (1, 10, 2, 60), (1, 99, 2, 10)]  # item 99 is unknown
    order, detail, dish = tables(spark, orders, lines, [(10, "pho bo", 30)])
    star = star_join(order, detail, dish)
    ctx = feat.daily_context(star).first()
    assert (ctx.day_order_count_1d, ctx.day_total_quantity_1d, ctx.day_total_revenue_1d,
            ctx.day_order_variety_1d) == (1, 15, 300, 2)
    items = feat.daily_item(star).collect()
    assert [(r.dish_name, r.y_sales, r.dish_count_in_order_1d, r.dish_revenue_day_1d) for r in items] == [
        ("pho bo", 3, 1, 90)]
    assert star.where(F.col("dish_name").isNull()).count() == 1


def test_strict_rolling_rows_not_calendar(spark):
    # item sells on days 0, 1, 2, 4 (day 3 missing) with quantities 1, 2, 3, 4
    days = [0, 1, 2, 4]
    orders = [(i + 1, D0 + dt.timedelta(days=d), q, 10) for i, (d, q) in enumerate(zip(days, [1, 2, 3, 4]))]
    lines = [(i + 1, 10, q, 10 * q) for i, q in enumerate([1, 2, 3, 4])]
    order, detail, dish = tables(spark, orders, lines, [(10, "a", 10)])
    out = feat.feature_store(star_join(order, detail, dish), horizons=(3,)).orderBy("time_date").collect()
    assert [r.dish_count_in_order_3d for r in out] == [0, 0, 3, 3]
    assert [r.day_total_quantity_3d for r in out] == [0, 0, 6, 9]
    assert [r.dish_sales_ratio_daily_3d for r in out] == [0.0, 0.0, 1.0, 1.0]
    assert [r.time_date for r in out][-1] == D0 + dt.timedelta(days=4)


def test_zero_denominator_ratio_is_zero(spark):
    orders = [(i + 1, D0 + dt.timedelta(days=i), 0, 0) for i in range(3)]
    lines = [(i + 1, 10, 0, 0) for i in range(3)]
    order, detail, dish = tables(spark, orders, lines, [(10, "a", 0)])
    out = feat.feature_store(star_join(order, detail, dish), horizons=(3,)).orderBy("time_date").collect()
    assert out[-1].avg_order_size_3d == 0.0 and out[-1].dish_revenue_ratio_daily_3d == 0.0
    assert out[-1].dish_sales_ratio_daily_1d is None  # 0 / 0 is NULL on the 1-day level


def test_split_sizes(spark):
    rows = [("a", D0 + dt.timedelta(days=i)) for i in range(366)] + [("b", D0)]
    df = spark.createDataFrame(rows, "dish_name string, time_date date")
    counts = {(r.dish_name, r.split): r["count"] for r in feat.chrono_split(df).groupBy("dish_name", "split").count().collect()}
    assert (counts[("a", "train")], counts[("a", "valid")], counts[("a", "test")]) == (219, 73, 74)
    assert counts == {**{k: v for k, v in counts.items() if k[0] == "a"}, ("b", "test"): 1}


def test_lag_days_excludes_current_day(spark):
    orders = [(i + 1, D0 + dt.timedelta(days=i), 1, 1) for i in range(4)]
    lines = [(i + 1, 10, i + 1, 1) for i in range(4)]
    order, detail, dish = tables(spark, orders, lines, [(10, "a", 1)])
    out = feat.feature_store(star_join(order, detail, dish), horizons=(2,), lag_days=1).orderBy("time_date").collect()
    # frame = the two rows before the current one; 1-day features come from the day before
    assert [r.dish_count_in_order_2d for r in out] == [0, 0, 2, 2]
    assert [r.y_sales for r in out] == [1, 2, 3, 4]
    assert [r.dish_total_quantity_1d for r in out] == [None, 1, 2, 3]


def random_star_tables(spark, seed):
    rnd = random.Random(seed)
    n_orders = rnd.randint(1, 40)
    orders = [(o, D0 + dt.timedelta(days=rnd.randint(0, 12)), rnd.randint(0, 9), rnd.randint(0, 500))
              for o in range(1, n_orders + 1)]
    if rnd.random() < 0.3:  # a duplicated order id
        orders.append((1, D0 + dt.timedelta(days=rnd.randint(0, 12)), 3, 7))
    lines = [(rnd.randint(1, n_orders + 2), rnd.randint(1, 6), rnd.randint(0, 5), rnd.randint(0, 90))
             for _ in range(rnd.randint(1, 120))]
    dishes = [(d, rnd.choice(["a", "b", "c"]), rnd.randint(1, 50)) for d in range(1, 6)]  # id 6 unknown
    return tables(spark, orders, lines, dishes)


@settings(max_examples=6, deadline=None)
@given(st.integers(0, 10_000))
def test_single_pass_equals_join_plan(spark, seed):
    order, detail, dish = random_star_tables(spark, seed)
    star = star_join(order, detail, dish)
    a = feat.daily_item_with_context(star)
    b = feat.daily_share(feat.daily_item(star), feat.daily_context(star))
    cols = sorted(a.columns)
    assert sorted(cols) == sorted(b.columns)
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


@settings(max_examples=6, deadline=None)
@given(st.integers(0, 10_000))
def test_rolling_against_plain_python(spark, seed):
    order, detail, dish = random_star_tables(spark, seed)
    share = feat.daily_item_with_context(star_join(order, detail, dish))
    out = feat.rolling_features(share, horizons=(3, 7)).collect()
    by_item = {}
    for r in sorted(share.collect(), key=lambda r: (r.dish_name, r.time_date)):
        by_item.setdefault(r.dish_name, []).append(r)
    expect = {}
    for item, rows in by_item.items():
        for i, r in enumerate(rows):
            for h in (3, 7):
                frame = rows[max(0, i - h + 1): i + 1]
                full = len(frame) == h
                s = lambda c: sum(getattr(x, c) for x in frame)
                expect[(item, r.time_date, h)] = (
                    s("day_order_count_1d") if full else 0,
                    s("dish_count_in_order_1d") if full else 0,
                    (s("dish_total_quantity_1d") / s("day_total_quantity_1d"))
                    if full and s("day_total_quantity_1d") != 0 else 0.0,
                )
    for r in out:
        for h in (3, 7):
            got = (r[f"day_order_count_{h}d"], r[f"dish_count_in_order_{h}d"], r[f"dish_sales_ratio_daily_{h}d"])
            assert got == expect[(r.dish_name, r.time_date, h)]


def test_item_filter_keeps_full_day_context(spark):
    orders = [(1, D0, 4, 40), (2, D0, 6, 60)]
    lines = [(1, 10, 4, 40), (2, 20, 6, 60)]
    order, detail, dish = tables(spark, orders, lines, [(10, "a", 10), (20, "b", 10)])
    star = star_join(order, detail, dish)
    only_a = feat.feature_store(star, horizons=(3,), items=["a"]).collect()
    assert [r.dish_name for r in only_a] == ["a"]
    r = only_a[0]
    assert (r.day_order_count_1d, r.day_total_quantity_1d, r.day_order_variety_1d) == (2, 10, 2)
    assert r.dish_sales_ratio_daily_1d == 0.4
