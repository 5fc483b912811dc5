"""Epoch seconds, weeks, and the time stamp in file names. The session zone is UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

FILE_STAMP = "yyyy-MM-dd'T'HH_mm_ss"


def week_of(epoch: Column) -> Column:
    """Monday 00:00 of the week an epoch value falls in, as a timestamp."""
    return F.date_trunc("week", epoch.cast("timestamp"))


def as_day(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def iso_utc(epoch: Column) -> Column:
    """ISO-8601 text of an epoch value; NULL for 0 and NULL."""
    moment = epoch.cast("timestamp")
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    has_fraction = F.unix_micros(moment) % 1000000 != 0
    fraction = F.when(has_fraction, F.date_format(moment, ".SSSSSS")).otherwise("")
    text = F.concat(whole, fraction, F.lit("+00:00"))
    return F.when(F.coalesce(epoch, F.lit(0.0)) != 0, text)


def file_stamp(moment: Column) -> Column:
    return F.date_format(moment, FILE_STAMP)


def stamp_of_file(file_name: Column) -> Column:
    """The time written into a snapshot's file name; NULL when there is none."""
    stamp = F.regexp_extract(file_name, r"(\d{4}-\d{2}-\d{2}T\d{2}_\d{2}_\d{2})", 1)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit(FILE_STAMP))


def day(value: dt.date | str | None) -> Column:
    """A fixed day, or today when none is given."""
    return F.current_date() if value is None else F.lit(str(value)).cast("date")
