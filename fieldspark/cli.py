"""Command line: gates of a recording's artifacts in a row, and reports of runs.

    python -m fieldspark.cli validate --db map.db --ply cloud.ply --mesh mesh.obj [--force]
    python -m fieldspark.cli report --stage1 stage1.json --out report.md

Meshes are OBJ, PLY or STL files.  The exit code is 0 if no gate failed, or with --force, and 1 otherwise; to validate nothing is an error.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark import schemas
from fieldspark.functions import scores
from fieldspark.operators import gates, ranking, spatial
from fieldspark.plans import report
from fieldspark.sources import config, database, geometry, tables


def verdicts(spark: SparkSession, db: str | None = None, ply: str | None = None, mesh: str | None = None) -> DataFrame:
    """ord, gate, verdict of the artifacts that are named.  What is in a cloud or mesh is only looked at if its file passes."""
    rows: list[tuple[int, str, str]] = []

    def add(gate: str, df: DataFrame, verdict) -> str:
        rows.append((len(rows), gate, df.select(verdict.alias("v")).first()["v"]))
        return rows[-1][2]

    def artifact(path: str) -> DataFrame:
        from pathlib import Path

        found = Path(path).exists()
        return spark.createDataFrame([(found, Path(path).stat().st_size if found else 0)], "exists boolean, length bigint")

    exists, length = F.col("exists"), F.col("length")
    if db:
        at = artifact(db)
        whole = database.integrity(spark.createDataFrame([(db,)], "path string")).first()["integrity"] if at.first()["exists"] else None
        add("database", at, gates.database(exists, length, F.lit(whole)))
    if ply and add("cloud file", artifact(ply), gates.cloud_file(exists, length)) != "fail":
        spark.dataSource.register(geometry.PlySource)
        cloud = geometry.load_cloud(spark, ply)
        box = spatial.bbox(cloud).join(cloud.agg(F.count("r").alias("colored")))
        add("cloud points", box, gates.cloud_count(F.col("n")))
        add("cloud colours", box, gates.cloud_colors(F.col("colored")))
        add("cloud extent", box, gates.cloud_extent(F.col("dx"), F.col("dy"), F.col("dz")))
    if mesh:
        at = artifact(mesh)
        n = [x.count() for x in geometry.read_mesh(spark, mesh)] if at.first()["exists"] else [0, 0]
        add("mesh", at, gates.mesh(exists, length, F.lit(n[0]), F.lit(n[1])))
    return spark.createDataFrame(rows, "ord int, gate string, verdict string")


def validate(spark: SparkSession, args: argparse.Namespace) -> int:
    if not (args.db or args.ply or args.mesh):
        raise ValueError("nothing to validate: name an artifact by --db, --ply or --mesh")
    found = gates.sequence(verdicts(spark, args.db, args.ply, args.mesh), args.force)
    for r in report.status_lines(found, "gate", F.col("outcome"), "ord").orderBy("ord").collect():
        print(r["line"])
    return gates.exit_code(found, args.force)


def write_report(spark: SparkSession, args: argparse.Namespace) -> int:
    path = config.required_file(args.stage1, "the report")
    runs = tables.stage_json(spark, str(path), schemas.STAGE1_RUN).select(F.explode("all").alias("r")).select("r.*")
    ranked = ranking.ranked(runs)
    for r in report.status_lines(ranked, "rmw", scores.drop_band(F.col("drop_pct")), "rank").orderBy("rank").collect():
        print(r["line"])
    report.write(args.out, "Sensor runs", [("Runs", {k: v for k, v in report.RUN.items() if k in ranked.columns}, ranked, "rank")])
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="fieldspark")
    sub = parser.add_subparsers(dest="command", required=True)
    v = sub.add_parser("validate", help="gates of artifacts, in a row")
    for name in ("--db", "--ply", "--mesh"):
        v.add_argument(name)
    v.add_argument("--force", action="store_true", help="go on after a gate that failed")
    v.set_defaults(run=validate)
    r = sub.add_parser("report", help="a Markdown report of a stage document")
    r.add_argument("--stage1", required=True)
    r.add_argument("--out", required=True)
    r.set_defaults(run=write_report)
    args = parser.parse_args(argv)
    try:
        from fieldspark.session import session

        return args.run(spark or session(), args)
    except (FileNotFoundError, ValueError) as e:
        print(e, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
