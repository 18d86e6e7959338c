"""FIXTURES.md section 7: tiny in-memory edge tables for P4, F1, U1-U4, F7,
F8, T1."""

from pyspark.sql import functions as F

from fundlens.functions.casts import lenient_cast
from fundlens.functions.cleaning import clean_country, clean_currency, recode_status
from fundlens.functions.dates import days_between, epoch_to_string, hours_between
from fundlens.functions.text import regex_tokens, split_blank
from fundlens.operators import prepare as P


def test_integer_cast(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,), ("3.7",)], "v string")
    got = df.select(lenient_cast("v").alias("a"), lenient_cast("v", through_double=True).alias("b")).collect()
    assert [tuple(r) for r in got] == [(12, 12), (None, None), (None, None), (None, 3)]


def test_split_on_blank(spark):
    df = spark.createDataFrame([("a ",), ("  ",), ("",)], "t string")
    got = [r[0] for r in df.select(split_blank("t")).collect()]
    assert got == [["a", ""], ["", "", ""], [""]]


def test_country_currency(spark):
    df = spark.createDataFrame([("False", "US"), ("FR", "EUR"), (None, "EUR"), ("FR", "True"), ("FR", None)],
                               "country string, currency string")
    got = df.select(clean_country("country", "currency"), clean_currency("currency")).collect()
    assert [tuple(r) for r in got] == [("US", None), ("FR", "EUR"), (None, "EUR"), ("FR", None), ("FR", None)]


def test_country_strict_length(spark):
    df = spark.createDataFrame([("False", "USD"), ("FRA", "EUR"), ("DE", "EUR")], "country string, currency string")
    got = [r[0] for r in df.select(clean_country("country", "currency", strict_len=2)).collect()]
    assert got == [None, None, "DE"]


def test_status_recode_and_drop(spark):
    df = spark.createDataFrame([(1,), (0,), (2,), (None,)], "final_status int")
    assert [r[0] for r in df.select(recode_status("final_status")).collect()] == [1, 0, 0, None]
    recoded = sorted(r[0] for r in df.transform(P.clean_status, "recode").collect())
    dropped = sorted(r[0] for r in df.transform(P.clean_status, "drop").collect())
    assert recoded == [0, 0, 1] and dropped == [0, 1]


def test_hours_and_repair(spark):
    df = spark.createDataFrame([(100, 50), (100, 5000), (None, 5)], "created_at int, launched_at int")
    df = df.withColumns({"deadline": F.lit(0), "hours_prepa": hours_between("created_at", "launched_at")})
    assert [r[0] for r in df.select("hours_prepa").collect()] == [-0.013, 1.361, None]
    repaired = df.transform(P.repair_preparation).transform(P.fill_nulls, {"hours_prepa": -1})
    assert [r[0] for r in repaired.select("hours_prepa").collect()] == [0.0, 1.361, -1.0]


def test_extreme_hours_are_null(spark):
    df = spark.createDataFrame([(-2000000000, 2000000000), (0, 3600)], "a int, b int")
    far = df.select(hours_between("a", "b")).collect()
    assert far[0][0] == 1111111.111 and far[1][0] == 1.0


def test_prepare_truncates_decimals_and_drops_negative_preparation(spark):
    row = ("kk1", "n", "d", "2500.5", "k", "False", "C1", "USD", "900", "900", "500", "100", "3", "1")
    names = "project_id name descr goal keywords disable_communication country currency deadline " \
            "state_changed_at created_at launched_at backers_count final_status"
    df = spark.createDataFrame([row], ", ".join(f"{n} string" for n in names.split()))
    assert df.transform(P.prepare).first().goal == -1
    assert df.transform(P.prepare, through_double=True).first().goal == 2500
    assert df.transform(P.prepare, negative_preparation="drop").count() == 0


def test_days_boundary(spark):
    df = spark.createDataFrame([(86399, 86400), (None, 5)], "a int, b int")
    assert [r[0] for r in df.select(days_between("b", "a")).collect()] == [1, None]
    assert df.select(epoch_to_string("b")).first()[0] == "1970-01-02 00:00:00"


def test_days_do_not_depend_on_session_zone(spark):
    df = spark.createDataFrame([(86399, 86400)], "a int, b int")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert df.select(days_between("b", "a")).first()[0] == 1
        assert df.select(epoch_to_string("a")).first()[0] == "1970-01-01 23:59:59"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_tokens_are_ascii_word_split(spark):
    df = spark.createDataFrame([("Ministère des Armées",)], "t string")
    assert df.select(regex_tokens("t")).first()[0] == ["minist", "re", "des", "arm", "es"]


def test_epoch_strings_in_a_daylight_saving_gap(spark):
    # 1997-04-06 02:38:35 UTC is a wall clock that does not exist in New York
    df = spark.createDataFrame([(860294315, 0), (-1, 0)], "a long, b long")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r[0] for r in df.select(epoch_to_string("a")).collect()]
        assert got == ["1997-04-06 02:38:35", "1969-12-31 23:59:59"]
        assert [r[0] for r in df.select(days_between("a", "b")).collect()] == [9957, -1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_message_text_keeps_ntz_wall_clock(spark):
    from fundlens.streaming import message_text
    df = spark.sql("SELECT timestamp_ntz'1996-04-07 02:06:19.123456' AS t")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(message_text("t")).first()[0] == "message ecrit le 02:06:19:123456000"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
