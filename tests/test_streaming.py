import os

from larder import specs
from larder.streaming import standardize as streams


def test_stream_standardize_orders(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("order_id,time,total_price,quantity\n"
                               "1,2024-01-01 10:00:00,100, 2 \n"
                               "1,2024-01-01 10:00:00,100, 2 \n"
                               "2,bad,x,3\n"
                               "3,2023-12-01 09:00:00,5,1\n")
    stream = streams.read_stream(spark, str(src), specs.ORDER.schema, "csv")
    cleaned = streams.standardize_stream(stream, specs.ORDER)
    out = streams.run_available(cleaned, str(tmp_path / "out"), "orders_test",
                                checkpoint_location=str(tmp_path / "ck"))
    rows = sorted((r.order_id, r.total_price, r.quantity, r.time_hour) for r in out.collect())
    assert rows == [(1, 100, 2, 10), (2, 0, 3, None), (3, 5, 1, 9)]
    # a second run with no new files adds nothing (exactly-once via the checkpoint)
    again = streams.run_available(streams.standardize_stream(
        streams.read_stream(spark, str(src), specs.ORDER.schema, "csv"), specs.ORDER),
        str(tmp_path / "out"), "orders_test2", checkpoint_location=str(tmp_path / "ck"))
    assert again.count() == 3
    assert os.path.isdir(tmp_path / "ck")
