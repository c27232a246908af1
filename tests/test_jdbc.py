"""The JDBC reader's slicing logic, with a recording stand-in for ``spark.read`` (no database
can be started in this environment)."""

from types import SimpleNamespace

from larder.sources import jdbc


class Recorder:
    def __init__(self, bounds_row):
        self.calls = []
        self.bounds_row = bounds_row

    def jdbc(self, url, table, column=None, lowerBound=None, upperBound=None, numPartitions=None,
             properties=None):
        self.calls.append(dict(url=url, table=table, column=column, lower=lowerBound, upper=upperBound,
                               parts=numPartitions, props=properties))
        return SimpleNamespace(first=lambda: self.bounds_row)


def fake_spark(bounds_row, parallelism=8):
    rec = Recorder(bounds_row)
    return SimpleNamespace(read=rec, sparkContext=SimpleNamespace(defaultParallelism=parallelism)), rec


def test_plain_read_is_one_query():
    spark, rec = fake_spark(None)
    jdbc.read_table(spark, "jdbc:x", "orders", {"user": "u"})
    assert len(rec.calls) == 1 and rec.calls[0]["column"] is None
    assert rec.calls[0]["props"] == {"fetchsize": "10000", "user": "u"}


def test_bounds_fetched_and_split_over_parallelism():
    spark, rec = fake_spark({"lo": 5, "hi": 905}, parallelism=16)
    jdbc.read_table(spark, "jdbc:x", "order_detail", {}, partition_column="id")
    assert "MIN(id)" in rec.calls[0]["table"] and "order_detail" in rec.calls[0]["table"]
    last = rec.calls[-1]
    assert (last["column"], last["lower"], last["upper"], last["parts"]) == ("id", 5, 905, 16)


def test_empty_table_is_read_whole():
    spark, rec = fake_spark({"lo": None, "hi": None})
    jdbc.read_table(spark, "jdbc:x", "t", {}, partition_column="id")
    assert rec.calls[-1]["column"] is None


def test_given_bounds_skip_the_bounds_query():
    spark, rec = fake_spark(None)
    jdbc.read_table(spark, "jdbc:x", "t", {}, partition_column="id", lower_bound=1, upper_bound=10, num_partitions=4)
    assert len(rec.calls) == 1 and (rec.calls[0]["lower"], rec.calls[0]["upper"], rec.calls[0]["parts"]) == (1, 10, 4)
