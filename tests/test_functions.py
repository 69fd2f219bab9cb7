"""Scalar cleaners on explicit edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from bikelake.functions.clean import (clean_name, duration_minutes, epoch_to_ts, guarded_pct,
                                      non_blank, normalize_category, normalize_id, round_decimal,
                                      to_type)
from bikelake.operators.silver import flag_to_int

ID_CASES = [
    ("5308.04_", "5308.04"), ("5303.06__", "5303.06"), ("5997.10", "5997.1"), ("5997.100", "5997.1"),
    ("5308.040", "5308.04"), ("5997.00", "5997"), (" 5997.0_ ", "5997"), ("5310", "5310"),
    ("5000", "5000"), ("JC013.0", "JC013"), ("5.100100", "5.1001"), ("12.0010", "12.001"),
    ("0.0", "0"), ("_", ""), ("5308.04 _", "5308.04 "), ("\t5308.10", "\t5308.1"), (None, None),
]

NAME_CASES = [  # (raw, trip cleaning, station cleaning)
    ("W 42 St", "W42 St", "W42 St"),
    ("W 42nd St", "W 42nd St", "W 42nd St"),
    ("E  118 St & N 3 Ave", "E118 St & N3 Ave", "E118 St & N3 Ave"),
    ("w 42", "w 42", "w 42"),
    ("NW 5", "NW 5", "NW 5"),
    ("S 4 St & N\t9", "S4 St & N9", "S4 St & N9"),
    ("  Broadway   &  W 3 St ", "Broadway & W3 St", "Broadway   &  W3 St"),
]


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_normalize_id(spark):
    got = _one(spark, [(a,) for a, _ in ID_CASES], "s string", normalize_id("s"))
    assert got == [b for _, b in ID_CASES]


def test_clean_name_modes(spark):
    rows = [(a,) for a, _, _ in NAME_CASES]
    assert _one(spark, rows, "s string", clean_name("s", True)) == [b for _, b, _ in NAME_CASES]
    assert _one(spark, rows, "s string", clean_name("s", False)) == [c for _, _, c in NAME_CASES]


def test_category_blank_and_casts(spark):
    assert _one(spark, [(" Member ",), ("\tcasual",)], "s string", normalize_category("s")) == \
        ["member", "\tcasual"]  # trim removes blanks only
    assert _one(spark, [("a",), (" ",), (None,), ("",)], "s string", non_blank("s")) == \
        [True, False, False, False]
    assert _one(spark, [("1.5",), ("",), ("x",)], "s string", to_type("s", "double")) == [1.5, None, None]


def test_duration_and_epoch(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:01.1", "2024-01-01 00:00:10.9"),
                                ("2024-01-01 00:00:10", "2024-01-01 00:00:08.5"),
                                ("2024-01-01 00:00:00", "2024-01-01 00:00:00")], "a string, b string")
    got = [r[0] for r in df.select(duration_minutes(F.col("a").cast("timestamp"),
                                                    F.col("b").cast("timestamp"))).collect()]
    assert got == [0.15, -0.03, 0.0]
    ts = spark.createDataFrame([(1704067200,)], "e long").select(epoch_to_ts("e")).first()[0]
    assert ts == dt.datetime(2024, 1, 1, 0, 0)


def test_weekday(spark):
    d = spark.createDataFrame([("2024-01-01 08:00:00",)], "t string") \
        .select(F.date_format(F.col("t").cast("timestamp"), "EEEE")).first()[0]
    assert d == "Monday"


def test_rounding_and_pct(spark):
    # 17.935 is 17.93499.. in binary; decimal rounding gives the HALF_UP result
    assert _one(spark, [(17.935,)], "x double", round_decimal(F.col("x"), 2)) == [17.94]
    df = spark.createDataFrame([(1, 10), (10, 100), (1, 0), (1, None), (3, 7), (1, 800)],
                               "n long, cap long")
    assert [r[0] for r in df.select(guarded_pct("n", "cap")).collect()] == \
        [10.0, 10.0, None, None, 42.86, 0.13]


def test_flags(spark):
    got = _one(spark, [("true",), ("FALSE",), ("1",), ("0",), (None,), ("2",)], "s string",
               flag_to_int("s"))
    assert got == [1, 0, 1, 0, None, 2]


def test_scale_conf():
    from bikelake.session import scale_conf
    c = scale_conf(100 * 10**12)
    assert c["spark.sql.adaptive.enabled"] == "true"
    assert int(c["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 << 20))
    assert scale_conf(10)["spark.sql.shuffle.partitions"] == "200"


def test_normalize_id_property(spark):
    """Random id-like strings: Spark's rules agree with the same rules applied in Python."""
    import re

    from hypothesis import given, settings
    from hypothesis import strategies as st

    from bikelake.functions import clean as C

    def py_normalize(s):
        s = s.strip(" ")
        s = re.sub(C.ID_TRAILING_UNDERSCORES, "", s)
        s = re.sub(C.ID_TRAILING_ZEROS, r"\1", s)
        return re.sub(C.ID_ZERO_FRACTION, "", s)

    ids = st.text(alphabet="0123456789._ AJC", min_size=0, max_size=12)

    @settings(max_examples=5, deadline=None)
    @given(st.lists(ids, min_size=20, max_size=200))
    def check(batch):
        got = _one(spark, [(x,) for x in batch], "s string", normalize_id("s"))
        assert got == [py_normalize(x) for x in batch]

    check()
