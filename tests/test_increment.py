"""The store grown by batches of days against the store computed at once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.operators import features as feat
from larder.operators import increment
from larder.operators.star import star_join
from tests.test_features import random_star_tables


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def small_star(spark, seed, n_days):
    star = star_join(*random_star_tables(spark, seed)).cache()
    return star.where(F.col("time_date") <= F.lit(days_of(star)[:n_days][-1]))


def days_of(star):
    return [r[0] for r in star.select("time_date").where("time_date IS NOT NULL").distinct().orderBy("time_date").collect()]


@pytest.mark.parametrize("lag", [0, 2])
def test_every_batching_equals_the_whole_store(spark, tmp_path, lag):
    star = small_star(spark, 5, 4)
    days = days_of(star)
    whole = rows(feat.feature_store(star.where("time_date IS NOT NULL"), horizons=(2, 3), lag_days=lag))
    for name, ends in (("days", days), ("uneven", [days[0], days[len(days) // 2], days[-1] + dt.timedelta(3)])):
        root = str(tmp_path / name)
        for end in ends:
            increment.append_days(star, root, end, horizons=(2, 3), lag_days=lag)
        assert rows(increment.read_store(spark, root, (2, 3), lag)) == whole


def test_batch_without_lines_and_item_that_pauses(spark, tmp_path):
    schema = ("order_id long, dish_id long, dish_name string, time_date date, dish_quantity long, price_one_dish long, "
              "price_total_dish long, order_quantity long, order_total_price long")
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    lines = [(n, 1, "a", day(n), n + 1, 5, 5 * (n + 1), n + 1, 9) for n in (0, 1, 9, 10)] + [(50 + n, 2, "b", day(n), 2, 3, 6, 2, 6) for n in range(11)]
    star = spark.createDataFrame(lines + [(99, 1, "a", None, 7, 7, 7, 7, 7)], schema)
    root = str(tmp_path)
    for end in (day(1), day(4), day(8), day(10), day(30), day(31)):
        increment.append_days(star, root, end, horizons=(3,))
    assert rows(increment.read_store(spark, root, (3,))) == rows(feat.feature_store(star.where("time_date IS NOT NULL"), horizons=(3,)))
    assert increment.stored_days(spark, increment.store_folder(root, (3,)))[-1] == day(31)


def test_lost_batch_is_not_read_and_is_written_anew(spark, tmp_path):
    star = star_join(*random_star_tables(spark, 8)).cache()
    days, root = days_of(star), str(tmp_path)
    middle, end = days[len(days) // 2], days[-1]
    increment.append_days(star, root, middle, horizons=(3,))
    before = rows(increment.read_store(spark, root, (3,)))
    # the driver is lost after some rows of the next batch, before its carry is complete
    folder = increment.store_folder(root, (3,))
    increment.read_store(spark, root, (3,)).limit(1).write.parquet(f"{folder}/rows/upto={end.isoformat()}")
    increment.read_store(spark, root, (3,)).limit(1).write.parquet(f"{folder}/carry/upto={end.isoformat()}")
    (tmp_path / folder.split("/")[-1] / "carry" / f"upto={end.isoformat()}" / "_SUCCESS").unlink()
    assert rows(increment.read_store(spark, root, (3,))) == before
    assert increment.append_days(star, root, end, horizons=(3,)) == middle
    assert rows(increment.read_store(spark, root, (3,))) == rows(feat.feature_store(star, horizons=(3,)))


def test_rewind_takes_late_lines_in(spark, tmp_path):
    star = star_join(*random_star_tables(spark, 11)).cache()
    days, root = days_of(star), str(tmp_path)
    for end in (days[1], days[3], days[-1]):
        increment.append_days(star, root, end, horizons=(2,))
    late = star.unionByName(star.where(F.col("time_date") == F.lit(days[2])).withColumn("order_id", F.col("order_id") + 10_000))
    with pytest.raises(ValueError):
        increment.append_days(late, root, days[3], horizons=(2,))
    assert increment.rewind(spark, root, days[2], (2,)) == days[1]
    increment.append_days(late, root, days[-1], horizons=(2,))
    assert rows(increment.read_store(spark, root, (2,))) == rows(feat.feature_store(late, horizons=(2,)))
    assert increment.rewind(spark, root, None, (2,)) is None
    with pytest.raises(ValueError):
        increment.read_store(spark, root, (2,))


def test_a_batch_reads_its_own_days_and_bounded_carry(spark, tmp_path):
    star = small_star(spark, 3, 4)
    days, root = days_of(star), str(tmp_path)
    for end in days:
        increment.append_days(star, root, end, horizons=(3,))
        carry = spark.read.parquet(f"{increment.store_folder(root, (3,))}/carry/upto={end.isoformat()}")
        assert carry.groupBy("dish_name").count().agg(F.max("count")).first()[0] <= 2
