"""Text helpers of log lines and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATE = r"average rate:\s*([0-9.]+)"


def rate_of(line: Column) -> Column:
    """The number after `average rate:`, or null."""
    got = F.regexp_extract(line, RATE, 1)
    return F.when(got != "", got.cast("double"))


def without_suffix(path: Column, suffix: str) -> Column:
    return F.when(path.endswith(suffix), F.regexp_replace(path, suffix.replace(".", r"\.") + "$", "")).otherwise(path)


def without_prefix(arg: Column) -> Column:
    """What follows the first `=`."""
    return F.regexp_replace(arg, "^[^=]*=", "")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(".")


def file_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def human_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
