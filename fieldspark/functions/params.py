"""Parameter maps: command-line text, canonical text, merging and selection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _entries(m: Column) -> Column:
    return F.array_sort(F.map_entries(m))


def to_cli(m: Column) -> Column:
    """`--key value ...`, in key order."""
    return F.array_join(F.transform(_entries(m), lambda e: F.concat(F.lit("--"), e["key"], F.lit(" "), e["value"])), " ")


def from_cli(text: Column) -> Column:
    """The map of `--key value ...`; values may hold spaces, and a key that is repeated takes its last value."""
    parts = F.filter(F.split(F.concat(F.lit(" "), F.trim(text)), " --"), lambda x: F.trim(x) != "")
    pairs = F.transform(parts, lambda x: F.struct(F.substring_index(x, " ", 1).alias("k"), F.when(x.contains(" "), F.trim(F.regexp_replace(x, r"^\S+\s", ""))).otherwise("").alias("v")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + F.lit(2), F.size(pairs)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def canonical(m: Column) -> Column:
    """Key-sorted text; equal maps have equal text."""
    return F.array_join(F.transform(_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")


def merged(base: Column, over: Column) -> Column:
    """Both maps' entries; the right side's value where both have a key."""
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(over), k)), over)


def without(m: Column, keys: list[str]) -> Column:
    return F.map_filter(m, lambda k, _: ~k.isin(keys))


def value(m: Column, key: str, default: str | None = None) -> Column:
    got = F.try_element_at(m, F.lit(key))
    return got if default is None else F.coalesce(got, F.lit(default))


def flag(m: Column, key: str) -> Column:
    """A stringly boolean: only `true`, in any case, is true."""
    return F.coalesce(F.lower(value(m, key)) == "true", F.lit(False))


def stringified(m: Column) -> Column:
    return F.transform_values(m, lambda _, v: v.cast("string"))
