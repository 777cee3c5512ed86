import datetime as dt

from pyspark.sql import functions as F

from claimspark.functions import codes, compat, dates


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def values(spark, items, fn, dtype="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {dtype}")
    return [r["x"] for r in rows.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_codes(spark):
    assert values(spark, ["1", "01", "11", "99", "10", None, "123"], codes.normalize_pos) == ["01", "01", "11", "99", None, None, None]
    assert len(codes.PLACE_CODES) == 49
    assert values(spark, ["Commercial", "MA", "Medicare", "Medicaid", "x", None], codes.lob_code) == ["COM", "ADV", "MCR", "MCD", "UNK", "UNK"]
    assert values(spark, ["1", "0", "-1", None, "9"], codes.paid_status) == ["P", "D", "R", "P", "P"]
    assert values(spark, ["m", "FEMALE", "U", None], codes.gender_code) == ["M", "F", None, None]
    kept = values(spark, ["A?1", "Subscriber7", "00000000X00000000", "A1", None], codes.valid_member)
    assert kept == [False, False, False, True, False]


def test_padding(spark):
    assert values(spark, ["45", "12345", None], lambda c: compat.pad_if(c, 4)) == ["0045", None, None]
    assert values(spark, ["7", "12345", None], lambda c: compat.lpad_code(c, 4)) == ["0007", "1234", None]
    assert values(spark, ["13001_8P15", "plain", None], lambda c: compat.after_first(c, "_")) == ["8P15", "plain", None]
    assert values(spark, ["12.9", "-12.9", "x"], compat.to_id) == ["12", "-12", None]


def test_null_rules(spark):
    assert one(spark, compat.oracle_concat(F.lit("A"), F.lit("~"), compat.typed_null("string"))) == "A~"
    assert values(spark, ["1", None, "2"], lambda c: compat.decode(c, None, "n", "1", "a", "z")) == ["n" if v is None else "a" if v == "1" else "z" for v in ["1", None, "2"]]
    df = compat.empty_to_null(spark.createDataFrame([("", 1), (" ", 2)], "a string, b int"))
    assert [r["a"] for r in df.orderBy("b").collect()] == [None, " "]


def test_intnx(spark):
    day = dates.as_date("2025-05-17")
    assert one(spark, dates.intnx(day, "month", -2, "b")) == dt.date(2025, 3, 1)
    assert one(spark, dates.intnx(day, "month", -2, "e")) == dt.date(2025, 3, 31)
    assert one(spark, dates.intnx(day, "week", 0, "b")) == dt.date(2025, 5, 11)
    assert one(spark, dates.intnx(day, "week", 0, "b", "mon")) == dt.date(2025, 5, 12)
    assert one(spark, dates.intnx(dates.as_date("2024-03-31"), "month", -1, "e")) == dt.date(2024, 2, 29)


def test_text_dates(spark):
    assert values(spark, ["00000000", "20240131", "bad", None], dates.parse_yyyymmdd) == [None, dt.date(2024, 1, 31), None, None]
