from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import dates as D
from tallyframe.functions import numbers as N
from tallyframe.functions import text as X


def one(spark, values, dtype, fn):
    """Apply a column function to each value and return the results in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_phone_classification(spark):
    texts = ["300-123 4567", "(2) 723 45 67", "abc", "", None, "3x1", "723456", "+573001234567"]
    assert one(spark, texts, "string", X.mobile_number) == ["3001234567", None, None, None, None, None, None, None]
    assert one(spark, texts, "string", X.landline_number) == [None, "27234567", None, None, None, None, None, None]


def test_text_cleaning(spark):
    assert one(spark, ["a\tb\nc\rd", None, ""], "string", X.clean_control_chars) == ["a b c d", None, ""]
    assert one(spark, [" x;y|z  w\n "], "string", lambda c: X.clean_address(c, 500)) == ["xyz w"]
    assert one(spark, ["Ñandú ÁÉÍ", "plain", None, "café"], "string", X.fold_accents) == ["Nandu AEI", "plain", None, "cafe"]
    assert one(spark, [" Aé ", None], "string", X.trim_upper) == ["AÉ", None]
    assert one(spark, ["12 x", "\t7 y", "x 1", "", None], "string", X.first_token_int) == [12, 7, None, None, None]
    assert one(spark, ["12.0", "12.50", "x.0", "-3.000", None], "string", X.strip_trailing_zero_decimal) == ["12", "12.50", "x.0", "-3", None]


def test_list_texts(spark):
    texts = ["[]", "[ ]", '["a","b"]', '["a" , 2, null]', "[x,  'y']", " plain , text ", None, ""]
    assert one(spark, texts, "string", X.list_text_normalize) == [None, None, "a, b", "a, 2", "x, y", "plain, text", None, ""]
    first = lambda c: X.list_text_normalize(c, first_only=True)
    assert one(spark, texts[:4], "string", first) == [None, None, "a", "a"]
    assert one(spark, texts[:2] + ["x"], "string", X.blank_empty_list) == ["", "", "x"]


def test_hash_keeps_part_borders(spark):
    df = spark.createDataFrame([("a", "bc", 1), ("ab", "c", 2), ("a", None, 3)], "x string, y string, i int")
    hashes = [r[0] for r in df.orderBy("i").select(X.content_hash(F.col("x"), F.col("y"))).collect()]
    assert len(set(hashes)) == 3


def test_concat_variants(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    got = df.select(X.concat_strict(F.col("x"), F.col("y")), X.concat_blank(F.col("x"), F.col("y"))).first()
    assert tuple(got) == (None, "a")
    assert one(spark, [12345, 7, None], "long", lambda c: X.fixed_width_key([(c, 3)], null_as="0")) == ["123", "007", "000"]


@pytest.mark.parametrize(
    "birth, at, years",
    [("2000-02-29", "2001-02-28", 1), ("2000-02-29", "2004-02-28", 3), ("2000-02-29", "2004-02-29", 4),
     ("1990-06-15", "2020-06-14", 29), ("1990-06-15", "2020-06-15", 30), ("2000-01-31", "2001-01-30", 0)],
)
def test_age(spark, birth, at, years):
    row = spark.range(1).select(D.age_years(F.lit(birth).cast("date"), F.lit(at).cast("date"))).first()
    assert row[0] == years


def test_month_boundaries(spark):
    pairs = [("2000-01-31", "2000-02-01", 1), ("2000-01-01", "2000-01-31", 0), ("2000-03-01", "1999-12-31", -3)]
    for a, b, n in pairs:
        assert spark.range(1).select(D.month_boundaries(F.lit(a).cast("date"), F.lit(b).cast("date"))).first()[0] == n


def test_month_to_date_bounds():
    assert D.month_to_date_bounds("2024-03-01") == (date(2024, 2, 1), date(2024, 2, 29))
    assert D.month_to_date_bounds("2024-03-15") == (date(2024, 3, 1), date(2024, 3, 14))
    assert D.month_to_date_bounds("2024-01-01") == (date(2023, 12, 1), date(2023, 12, 31))


def test_sentinels(spark):
    values = ["1753-01-01", "0001-01-01", "0001-01-01T00:00:00", "2020-02-03", None]
    assert one(spark, values, "string", D.sentinel_to_null) == [None, None, None, "2020-02-03", None]
    days = [date(1753, 1, 1), date(2020, 2, 3), None]
    assert one(spark, days, "date", D.sentinel_to_null) == [None, date(2020, 2, 3), None]
    filled = one(spark, days, "date", lambda c: D.default_date(D.sentinel_to_null(c), "2024-01-16"))
    assert filled == [date(2024, 1, 15), date(2020, 2, 3), date(2024, 1, 15)]


def test_parsing_never_fails(spark):
    assert one(spark, ["2024-01-02", "x", "", None, "2024-13-01"], "string", D.parse_date) == [date(2024, 1, 2), None, None, None, None]
    stamps = one(spark, ["10:20:30", "102030", "259999", "1", None], "string", lambda c: D.assemble_timestamp(F.lit(date(2024, 1, 2)), c))
    assert stamps == [datetime(2024, 1, 2, 10, 20, 30)] * 2 + [None] + [datetime(2024, 1, 2)] * 2


def test_prorated_remaining(spark):
    def rest(start, end, at):
        return spark.range(1).select(D.prorated_remaining(F.lit(start).cast("date"), F.lit(end).cast("date"), at)).first()[0]

    assert rest("2024-01-01", "2024-12-31", "2024-12-31") == 0
    assert rest("2024-01-01", "2025-01-01", "2024-01-01") == 12
    assert rest("2024-01-01", "2025-01-01", "2024-07-02") == 6
    assert rest("2024-05-05", "2024-05-05", "2024-01-01") is None


def test_numbers(spark):
    assert one(spark, ["NaN", "1.5", "x", None, ""], "string", N.nan_to_null) == [None, 1.5, None, None, None]
    assert [str(v) for v in one(spark, ["12345", "x"], "string", N.scaled_decimal)] == ["1.23", "None"]
    assert one(spark, [45, -45, None], "int", lambda c: N.integer_division(c, 30)) == [1, -1, None]
    assert one(spark, [0.0, None, 2.0], "double", lambda c: N.fallback_if_zero(c, F.lit(9.0))) == [9.0, 9.0, 2.0]
    df = spark.createDataFrame([(1, None, 3)], "a int, b int, c int")
    assert df.select(N.null_safe_sum([F.col(c) for c in "abc"])).first()[0] == 4
    assert df.select(N.concat_numeric_code(F.col("a"), F.col("c"))).first()[0] == 13
