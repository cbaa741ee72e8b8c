"""Configuration trees and system facts, read on the driver."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from fieldspark import schemas


def load_config(*places: str) -> dict:
    """The first YAML file that exists among the places; an empty tree if there is none."""
    import yaml

    for place in places:
        if Path(place).exists():
            return yaml.safe_load(Path(place).read_text(encoding="utf-8")) or {}
    return {}


def config_table(spark: SparkSession, tree: dict) -> DataFrame:
    """section, key, value of a two-level tree."""
    rows = [(s, k, None if v is None else str(v)) for s, own in tree.items() for k, v in (own or {}).items()]
    return spark.createDataFrame(rows, "section string, key string, value string")


def system_info(spark: SparkSession, rmws: list[str] | None = None, xml: str | None = None, usb: str = "Unknown") -> DataFrame:
    """One row of facts about the driver's machine; what can't be read is unknown."""
    try:
        rmem = f"{int(Path('/proc/sys/net/core/rmem_max').read_text()) / 1048576:.1f}MB"
    except (OSError, ValueError):
        rmem = "Unknown"
    return spark.createDataFrame([(rmws or [], rmem, usb, os.cpu_count() or 4, bool(xml and Path(xml).exists()))], schemas.SYSTEM_INFO)


def disk_free(spark: SparkSession, path: str = "/") -> DataFrame:
    s = os.statvfs(path)
    return spark.createDataFrame([(path, s.f_bavail * s.f_frsize // 1048576)], "path string, free_mb bigint")


def capable(command: list[str], word: str, seconds: float = 10.0) -> bool:
    """Whether a command's help text has the word; False if it can't be run."""
    import subprocess

    try:
        got = subprocess.run(command, capture_output=True, text=True, timeout=seconds, check=False)
    except (OSError, subprocess.SubprocessError):
        return False
    return word in got.stdout + got.stderr


def required_file(path: str | None, what: str) -> Path:
    """A stage's input, or an error that names it."""
    if not path or not Path(path).exists():
        raise FileNotFoundError(f"{what} needs a file, and {path or 'none'} isn't there")
    return Path(path)
