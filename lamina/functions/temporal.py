"""Dates and times of invoices and of loads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lamina.schemas import LOAD_DATE, LOAD_TIME

# Text forms of the input files and the stored tables.
INVOICE_TIME_FORMAT = "M/d/yyyy H:mm"
TIME_OF_DAY_FORMAT = "HH:mm"


def invoice_time(text: Column) -> Column:
    """Invoice text such as ``12/1/2010 8:26`` as a timestamp, NULL when it is not one."""
    return F.try_to_timestamp(text, F.lit(INVOICE_TIME_FORMAT))


def time_of_day(ts: Column) -> Column:
    return F.date_format(ts, TIME_OF_DAY_FORMAT)


def now(spark: SparkSession) -> datetime:
    """The current time in the session's time zone, to pass as ``load_ts``."""
    return spark.range(1).select(F.localtimestamp()).first()[0]


def load_stamp(load_ts: datetime | None = None) -> dict[str, Column]:
    """Load date and load time. Pass ``load_ts`` to give all tables of a run one stamp."""
    if load_ts is None:
        now = F.current_timestamp()
        return {LOAD_DATE: F.to_date(now), LOAD_TIME: time_of_day(now)}
    return {LOAD_DATE: F.lit(load_ts.date()), LOAD_TIME: F.lit(load_ts.strftime("%H:%M"))}
