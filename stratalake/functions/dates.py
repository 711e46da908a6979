"""Dates of loads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.config import LOAD_ZONE


def load_date_text(utc: Column, zone: str = LOAD_ZONE) -> Column:
    """The load date a UTC time falls on in the lake's time zone."""
    return F.date_format(F.from_utc_timestamp(utc, zone), "yyyyMMdd")


def load_date_of_path(path: Column) -> Column:
    """The dated folder of a stage file, ``…/<table>/<yyyymmdd>/<file>``."""
    return F.regexp_extract(path, r"/(\d{8})/[^/]+$", 1)
