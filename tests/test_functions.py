from datetime import date, datetime

from pyspark.sql import functions as F

from cauce.functions import casts, dates, maps, text


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_title_case_after_every_non_letter(spark):
    assert column(spark, ["o'neil mary-ann", "3rd ÁVILA"], text.title_case) == ["O'Neil Mary-Ann", "3Rd Ávila"]


def test_strip_all_takes_tabs_and_newlines(spark):
    assert column(spark, ["\t a b \n", None], text.strip_all) == ["a b", None]


def test_normalize_name(spark):
    assert column(spark, ["  juan \t  PEREZ "], text.normalize_name) == ["Juan Perez"]


def test_safe_int_rounds_half_away_and_forgives(spark):
    values = ["1.0", "2.5", "-2.5", "1.7", "x", "", None, "99999999999"]
    assert column(spark, values, casts.safe_int) == [1, 3, -3, 2, None, None, None, None]


def test_code_between_equals_rounded_code(spark):
    values = ["0.4", "0.5", "0.49999999999999994", "1.0", "6.4", "6.5", "6.49999", "7", "x", None]
    quick = column(spark, values, lambda c: casts.code_between(c, 1, 6))
    rounded = column(spark, values, lambda c: casts.safe_int(c).between(1, 6))
    assert quick == rounded


def test_parse_decimal(spark):
    assert column(spark, ["12,5", "12.5", "abc"], casts.parse_decimal) == [12.5, 12.5, None]


def test_safe_divide(spark):
    assert column(spark, [0.0, 4.0], lambda c: casts.safe_divide(F.lit(8.0), c), "double") == [None, 2.0]


def test_mixed_timestamps(spark):
    values = ["13/02/2024 05:07", "02-13-2024 05:07 PM", " 1/2/2024 5:07 ", "2024-03-04", "never", "", None]
    assert column(spark, values, dates.parse_mixed_timestamp) == [
        datetime(2024, 2, 13, 5, 7), datetime(2024, 2, 13, 17, 7), datetime(2024, 2, 1, 5, 7),
        datetime(2024, 3, 4), None, None, None]


def test_mixed_dates(spark):
    assert column(spark, ["31/12/2023", "2023-12-31", "31/02/2023"], dates.parse_mixed_date) == [
        date(2023, 12, 31), date(2023, 12, 31), None]


def test_elapsed_minutes_truncates(spark):
    rows = [("2024-01-01 00:00:59", "2024-01-01 00:01:00"), ("2024-01-01 00:00:00", "2024-01-01 00:01:59"),
            ("2024-01-01 00:10:00", "2024-01-01 00:00:30")]
    df = spark.createDataFrame(rows, "a string, b string").select(
        dates.elapsed_minutes(F.col("a").cast("timestamp"), F.col("b").cast("timestamp")))
    assert [r[0] for r in df.collect()] == [0, 1, -9]


def test_calendar_parts(spark):
    sunday = [date(2022, 1, 2)]
    assert column(spark, sunday, dates.date_key, "date") == [20220102]
    assert column(spark, sunday, dates.iso_weekday, "date") == [7]
    assert column(spark, sunday, dates.year_weekday, "date") == ["2022-7"]
    assert column(spark, sunday, dates.iso_year_week, "date") == ["2021-52"]
    assert column(spark, sunday, dates.day_name_es, "date") == ["Domingo"]
    assert column(spark, sunday, dates.week_ending_sunday, "date") == [date(2022, 1, 2)]


def test_holiday_rule_gives_the_known_year(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2022-01-01', DATE'2022-12-31')) AS d")
    found = {r.d.isoformat() for r in days.where(dates.is_us_holiday(F.col("d"))).collect()}
    assert found == {"2022-01-01", "2022-01-17", "2022-02-21", "2022-05-30", "2022-06-19", "2022-06-20", "2022-07-04",
                     "2022-09-05", "2022-10-10", "2022-11-11", "2022-11-24", "2022-12-25", "2022-12-26"}


def test_maps(spark):
    genders = {"M": "Male", "OTHER": "Other"}
    assert column(spark, [" M ", "other", "?", None], lambda c: maps.map_value(c, genders, "Unknown")) == [
        "Male", "Other", "Unknown", "Unknown"]
    assert column(spark, [" M", " z "], lambda c: maps.map_or_keep(c, genders)) == ["Male", " z "]


def test_bucketize_and_first_match(spark):
    edges = [(1, "low"), (3, "mid")]
    assert column(spark, [0.5, 1.0, 3.0, None], lambda c: maps.bucketize(c, edges, "top"), "double") == [
        "low", "mid", "top", "top"]
    patterns = [(("%a%", "%b%"), "both"), (("%a%",), "a")]
    assert column(spark, ["xaxb", "xa", "q"], lambda c: maps.first_match(c, patterns)) == ["both", "a", None]
