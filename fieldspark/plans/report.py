"""Markdown tables of any result, and the reports made of them.

A table's head is its columns' names; how a column is shown is given as a format for each name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLAIN = "%s"


def shown(column: str, how: str = PLAIN) -> Column:
    """The column as text: `%.1f` and the like round by the plain formula first, and null is a dash."""
    c = F.col(column)
    if how.endswith("f") and "." in how:
        digits = int(how.rsplit(".", 1)[1][:-1])
        c = F.floor(c * float(10**digits) + 0.5) / float(10**digits)
    return F.coalesce(F.format_string(how, c if how != PLAIN else c.cast("string")), F.lit("-")) if how != PLAIN else F.coalesce(c.cast("string"), F.lit("-"))


def lines(rows: DataFrame, columns: dict[str, str], order: str) -> DataFrame:
    """The order column, and each row as a line of a Markdown table with the given columns (name to format)."""
    cells = [F.when(F.col(c).isNull(), F.lit("-")).otherwise(shown(c, how)) for c, how in columns.items()]
    return rows.select(order, F.concat(F.lit("|"), F.concat_ws("|", *cells), F.lit("|")).alias("line"))


def head(columns: dict[str, str]) -> list[str]:
    return ["|" + "|".join(columns) + "|", "|" + "|".join("-" for _ in columns) + "|"]


RUN = {"rank": PLAIN, "rmw": PLAIN, "shm": PLAIN, "resolution": PLAIN, "target_fps": PLAIN, "qos": PLAIN, "color_hz": "%.1f", "depth_hz": "%.1f", "drop_pct": "%.1f", "cpu_pct": "%.1f", "ram_mb": "%.1f", "score": "%.1f"}
SENSOR = {"rank": PLAIN, "rmw": PLAIN, "shm_status": PLAIN, "resolution": PLAIN, "target_fps": PLAIN, "qos": PLAIN, "format": PLAIN, "measured_fps": "%.1f", "drop_pct": "%.1f", "cpu_pct": "%.1f", "score": "%.1f"}
SLAM = {"rank": PLAIN, "label": PLAIN, "odom_hz": "%.2f", "map_hz": "%.2f", "slam_ok": PLAIN, "camera_ok": PLAIN, "cpu_cam": "%.1f", "cpu_slam": "%.1f", "db_growth_mb_min": "%.2f", "score": "%.1f"}
DIAGNOSTIC = {"topic": PLAIN, "min_hz": PLAIN, "measured_hz": "%.1f", "status": PLAIN}
INSPECTOR = {"topic": PLAIN, "fps": "%.1f", "status": PLAIN}


def write(path: str, title: str, sections: list[tuple[str, dict[str, str], DataFrame, str]]) -> str:
    """A Markdown file of sections (heading, columns, rows, order column); reports have as many rows as an experiment has runs."""
    out = [f"# {title}"]
    for heading, columns, rows, order in sections:
        out += ["", f"## {heading}", "", *head(columns), *[r["line"] for r in lines(rows, columns, order).orderBy(order).collect()]]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(out) + "\n")
    return path


def status_lines(rows: DataFrame, what: str, band: Column, order: str) -> DataFrame:
    """Console lines: the band in capitals beside what it is about."""
    return rows.select(order, F.concat(F.lit("["), F.rpad(F.upper(band), 8, " "), F.lit("] "), F.col(what)).alias("line"))
