import datetime as dt

from larder import specs
from larder.operators import clean


def test_dedupe_before_cleaning(spark):
    raw = spark.createDataFrame(
        [(1, "Pho Bo", "10"), (1, "Pho Bo", "10"), (2, " Bun Cha", "20"), (2, "Bun Cha", "20")],
        "dish_id long, dish_name string, price string")
    out = clean.standardize(raw, specs.DISH)
    rows = sorted(tuple(r) for r in out.collect())
    # the identical pair collapses; the pair equal only after trimming stays two rows
    assert rows == [(1, "pho bo", 10), (2, "bun cha", 20), (2, "bun cha", 20)]


def test_standardize_item_spec(spark):
    raw = spark.createDataFrame(
        [(1, "  Phở Bò ", "55000"), (2, None, "abc"), (3, "Chả Cá Lã Vọng", None), (4, "   ", " 7 ")],
        "dish_id long, dish_name string, price string")
    got = {r.dish_id: (r.dish_name, r.price) for r in clean.standardize(raw, specs.DISH).collect()}
    assert got == {1: ("pho bo", 55000), 2: ("unknown", 0), 3: ("cha ca la vong", 0), 4: ("unknown", 7)}


def test_recipe_spec_keeps_unit_accents(spark):
    raw = spark.createDataFrame([(1, 1, 9, "Đậu phộng", "2", "Cái")],
                                "id long, dish_id long, ingredient_id long, ingredient_name string, "
                                "quantity string, unit string")
    row = clean.standardize(raw, specs.DISH_DETAIL).first()
    assert (row.ingredient_name, row.quantity, row.unit) == ("au phong", 2, "cái")


def test_order_spec_parses_time(spark):
    raw = spark.createDataFrame([(7, "2024-03-05 19:30:00", "120000", "3"), (8, "oops", "", "x")],
                                "order_id long, time string, total_price string, quantity string")
    got = {r.order_id: r for r in clean.standardize(raw, specs.ORDER).collect()}
    assert (got[7].time, got[7].time_date, got[7].time_hour, got[7].total_price, got[7].quantity) == (
        dt.datetime(2024, 3, 5, 19, 30), dt.date(2024, 3, 5), 19, 120000, 3)
    assert (got[8].time, got[8].time_date, got[8].time_hour, got[8].total_price, got[8].quantity) == (
        None, None, None, 0, 0)


def test_missing_columns_are_skipped(spark):
    raw = spark.createDataFrame([(1, "X")], "dish_id long, dish_name string")
    assert clean.standardize(raw, specs.DISH).columns == ["dish_id", "dish_name"]


def test_normalize_datetime_columns_by_name(spark):
    raw = spark.createDataFrame(
        [(1, "2024/01/02", dt.datetime(2024, 1, 2, 3, 4, 5), "keep me"), (2, "nope", None, "x")],
        "id long, update_time string, created_date timestamp_ntz, note string")
    got = {r.id: tuple(r) for r in clean.normalize_datetime_columns(raw).collect()}
    assert got[1] == (1, "2024-01-02 00:00:00", "2024-01-02 03:04:05", "keep me")
    assert got[2] == (2, None, None, "x")


def test_ingredient_spec(spark):
    raw = spark.createDataFrame([(1, 1, "Giá đỗ"), (2, 2, "  "), (3, 3, "Nước mắm (Phú Quốc)")],
                                "id long, ingredient_id long, ingredient_name string")
    got = {r.id: r.ingredient_name for r in clean.standardize(raw, specs.INGREDIENT).collect()}
    assert got == {1: "gia o", 2: "unknown", 3: "nuoc mam phu quoc"}


def test_order_detail_spec_keeps_ids(spark):
    raw = spark.createDataFrame([(5, 9, 3, " Bún Chả ", "2", "70000"), (6, 9, 4, None, "", "n/a")],
                                "id long, order_id long, dish_id long, dish_name string, quantity string, price string")
    got = sorted(tuple(r) for r in clean.standardize(raw, specs.ORDER_DETAIL).collect())
    assert got == [(5, 9, 3, "bun cha", 2, 70000), (6, 9, 4, "unknown", 0, 0)]


def test_typed_times_keep_their_wall_clock_in_any_zone(spark, tmp_path):
    import datetime as dt

    from pyspark.sql import functions as F

    from larder.operators import clean
    from larder.sources import files

    (tmp_path / "o.csv").write_text("order_id,time\n1,2024-01-01 20:11:12\n")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            inferred = files.read_table(spark, str(tmp_path / "o.csv"), "csv")
            literal = spark.sql("SELECT 1 AS order_id, TIMESTAMP_NTZ'2024-01-01 20:11:12' AS time")
            for df in (inferred, literal):
                row = clean.parse_timestamp_columns(df, ("time",)).head()
                assert (row.time, row.time_date, row.time_hour) == (dt.datetime(2024, 1, 1, 20, 11, 12), dt.date(2024, 1, 1), 20), zone
            day = clean.parse_timestamp_columns(spark.sql("SELECT DATE'2024-01-01' AS time"), ("time",)).head()
            assert (day.time, day.time_hour) == (dt.datetime(2024, 1, 1), 0)
            text = spark.createDataFrame([("2024-01-01 20:11:12",)], "time string")
            assert clean.parse_timestamp_columns(text, ("time",)).select(F.hour("time")).head()[0] == 20
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_lenient_layouts(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from larder.functions.timecols import lenient_timestamp

    day, time = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 10, 11, 12)
    cases = {
        "2024-01-02 10:11:12": time, "2024-01-02 10:11:12.5": time.replace(microsecond=500000), "2024-01-02 10:11:12.123": time.replace(microsecond=123000),
        "2024-01-02 10:11:12.123456789": time.replace(microsecond=123456), "2024-01-02T10:11:12Z": time, "2024-01-02T10:11:12+07:00": time,
        "2024-01-02 10:11": time.replace(second=0), " 2024-01-02 ": day, "2024-1-2": day, "20240102": day, "20240102 10:11:12": time, "01/02/2024": day,
        "2024/01/02": day, "2024-13-02": None, "2024-02-30": None, "soon": None, "": None, None: None, "2024": None, "202401021": None}
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, x string")
    got = [r[0] for r in df.orderBy("i").select(lenient_timestamp(F.col("x"))).collect()]
    assert got == list(cases.values())
