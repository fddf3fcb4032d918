"""Date parsing, calendar attributes and holidays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cauce.functions.text import strip_all

# Spanish month and weekday names, Monday first.
MONTHS_ES = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
             "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre")
DAYS_ES = ("Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado", "Domingo")

DAY_FIRST = ("d/M/yyyy H:m:s", "d/M/yyyy", "d-M-yyyy H:m", "d-M-yyyy",
             "yyyy-M-d H:m:s", "yyyy-M-d H:m", "yyyy-M-d")


def _first_parse(text: Column, formats: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def parse_mixed_timestamp(text: Column, fallbacks: tuple[str, ...] = DAY_FIRST) -> Column:
    """``DD/MM/YYYY HH:MM`` or, with dashes, ``MM-DD-YYYY hh:mm AM/PM``; else day-first; else NULL."""
    bare = strip_all(text)
    by_separator = F.when(
        bare.contains("-"), F.try_to_timestamp(bare, F.lit("M-d-yyyy h:m a"))
    ).otherwise(F.try_to_timestamp(bare, F.lit("d/M/yyyy H:m")))
    return F.coalesce(by_separator, _first_parse(bare, fallbacks))


def parse_mixed_date(text: Column) -> Column:
    """``DD/MM/YYYY`` where there is a slash, else ``YYYY-MM-DD``; else NULL."""
    bare = strip_all(text)
    return F.when(
        bare.contains("/"), F.try_to_timestamp(bare, F.lit("d/M/yyyy"))
    ).otherwise(F.try_to_timestamp(bare, F.lit("yyyy-M-d"))).cast("date")


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Whole minutes between two timestamps (truncated, not boundary counts)."""
    return (end - start).cast("interval minute").cast("bigint")


def elapsed_millis(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", start, end)


def date_key(day: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def iso_weekday(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(day) + 1


def year_weekday(day: Column) -> Column:
    """``2022-1`` for a Monday of 2022: the year and the ISO weekday, not the week."""
    return F.concat_ws("-", F.date_format(day, "yyyy"), iso_weekday(day).cast("string"))


def iso_year_week(day: Column) -> Column:
    """True ISO week label: the year is the one holding the week's Thursday."""
    thursday = F.date_add(F.trunc(day, "week"), 3)
    return F.concat(F.date_format(thursday, "yyyy"), F.lit("-"),
                    F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def month_name_es(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS_ES]), F.month(day))


def day_name_es(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAYS_ES]), iso_weekday(day))


def week_ending_sunday(day: Column) -> Column:
    return F.date_add(F.trunc(day, "week"), 6)


# The US federal holidays, by date (month-day) or by month, weekday (Sunday is 1) and its count in the month.
_DATED = {"01-01": "new_year", "06-19": "juneteenth", "07-04": "independence", "11-11": "veterans", "12-25": "christmas"}
_NTH = {"1/2/3": "king", "2/2/3": "presidents", "9/2/1": "labor", "10/2/2": "columbus", "11/5/4": "thanksgiving"}


def _listed(values: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


def us_holiday(day: Column) -> Column:
    """Name of the US federal holiday, NULL on other days; a Sunday date is also observed on the Monday after it."""
    monday = F.dayofweek(day) == 2
    nth = F.concat_ws("/", F.month(day), F.dayofweek(day), F.ceil(F.dayofmonth(day) / 7))
    return F.coalesce(
        _listed(_DATED, F.date_format(day, "MM-dd")), F.when(monday, _listed(_DATED, F.date_format(F.date_sub(day, 1), "MM-dd"))),
        _listed(_NTH, nth), F.when(monday & (F.month(day) == 5) & (F.month(F.date_add(day, 7)) == 6), "memorial"))


def is_us_holiday(day: Column) -> Column:
    """Whether the day is a US federal holiday or one observed on Monday."""
    return us_holiday(day).isNotNull()


def near_us_holiday(day: Column) -> Column:
    """The holiday of the day, else that of the next day with ``-1`` or of the day before with ``+1``, else NULL."""
    return F.coalesce(us_holiday(day), F.concat(us_holiday(F.date_add(day, 1)), F.lit("-1")),
                      F.concat(us_holiday(F.date_sub(day, 1)), F.lit("+1")))
