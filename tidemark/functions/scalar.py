"""Scalar functions of identity and visibility, all as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def new_york(utc: Column) -> Column:
    """The wall clock of New York, as timestamp_ntz, at a moment given as UTC without a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), utc.cast("timestamp_ntz"))


def visible_at(et: Column, open_time: str = "09:30:00", close_time: str = "16:00:00") -> Column:
    """When a filing accepted at et, New York wall clock, counts; null stays null.

    At once on a weekday from opening to close, both included; before the opening at that day's
    opening, later or on a weekend at the next weekday's.
    """
    day, time = F.dayofweek(et), F.date_format(et, "HH:mm:ss.SSSSSS")  # 1 is Sunday
    weekday, after = ~day.isin(1, 7), time > f"{close_time}.000000"
    ahead = F.when(day == 7, 2).when(day == 1, 1).when(~after, 0).when(day == 6, 3).otherwise(1)
    opening = F.to_timestamp_ntz(F.concat_ws(" ", F.date_add(et.cast("date"), ahead).cast("string"), F.lit(open_time)))
    return F.when(weekday & ~after & (time >= f"{open_time}.000000"), et).when(et.isNotNull(), opening)


def quarter_end(d: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))


def normal_name(name: Column, suffixes: tuple[str, ...] = ("inc", "corp", "ltd", "llc", "co", "plc")) -> Column:
    """Lower case, punctuation to spaces, trailing company suffixes stripped while a word remains."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), "[.']", ""), "[^a-z0-9]+", " "))
    return F.regexp_replace(plain, rf"(?<=[a-z0-9])(?: (?:{'|'.join(suffixes)}))+$", "")
