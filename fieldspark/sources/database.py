"""SQLite files: their integrity, a `sqlite` data source that reads a table in ranges of row ids, and a writer of many files."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from contextlib import closing

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from fieldspark.session import qualified

# SQLite's rules for a declared type, first match first, and the type that holds it
AFFINITIES = [("INT", "bigint"), ("CHAR", "string"), ("CLOB", "string"), ("TEXT", "string"), ("BLOB", "binary"), ("REAL", "double"), ("FLOA", "double"), ("DOUB", "double"), ("BOOL", "bigint")]
ARROW = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
DECLARED = {"bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "tinyint": "INTEGER", "boolean": "INTEGER", "float": "REAL", "double": "REAL", "binary": "BLOB"}


def integrity(paths: DataFrame) -> DataFrame:
    """path and the result of SQLite's integrity check (`ok`, or what is wrong), for a column `path` of local or mounted files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for p in b["path"]:
                try:
                    db = sqlite3.connect(f"file:{p.removeprefix('file:')}?mode=ro", uri=True)
                    try:
                        out.append(db.execute("PRAGMA integrity_check").fetchone()[0])
                    finally:
                        db.close()
                except sqlite3.Error as e:
                    out.append(f"error: {e}")
            yield pd.DataFrame({"path": b["path"], "integrity": out})

    return paths.select("path").mapInPandas(run, "path string, integrity string")


def _open(path: str) -> sqlite3.Connection:
    """A file for reading: where it lies, if it is on a disk or mounted, else as a copy in memory."""
    at = path.removeprefix("file://").removeprefix("file:")
    if "://" not in at:
        db = sqlite3.connect(f"file:{at}?mode=ro", uri=True)
    else:
        from pyarrow import fs

        files, at = fs.FileSystem.from_uri(path)
        db = sqlite3.connect(":memory:")
        with files.open_input_stream(at) as f:
            db.deserialize(f.read())
    db.text_factory = lambda raw: raw.decode("utf-8", "replace")
    return db


def _name(text: str) -> str:
    return '"' + text.replace('"', '""') + '"'


def _type(declared: str) -> str:
    """Numbers of any kind and undeclared columns are read as text, which loses nothing."""
    return next((t for word, t in AFFINITIES if word in declared.upper()), "string")


def _fitted(column: tuple, kind: str) -> list:
    """A column's values as one type.  SQLite lets any value into any column: one of another kind is null, but text columns take numbers as text."""
    if kind == "bigint":
        return [v if isinstance(v, int) else None for v in column]
    if kind == "double":
        return [float(v) if isinstance(v, (int, float)) else None for v in column]
    if kind == "binary":
        return [v if v is None or isinstance(v, bytes) else str(v).encode() for v in column]
    return [v if v is None or isinstance(v, str) else v.decode("utf-8", "replace") if isinstance(v, bytes) else str(v) for v in column]


def _parts(rows: sqlite3.Cursor, most: int = 4096, size: int = 1 << 22) -> Iterator[list[tuple]]:
    """Rows together, until they are many or long; what came before an error comes out before it."""
    part, held = [], 0
    try:
        for row in rows:
            part.append(row)
            held += sum(len(v) for v in row if isinstance(v, (str, bytes)))
            if len(part) >= most or held >= size:
                yield part
                part, held = [], 0
    except sqlite3.Error:
        if part:
            yield part
        raise
    if part:
        yield part


class SqliteSource(DataSource):
    """`spark.read.format("sqlite").option("table", name).load(paths)`: a table of one or more comma-separated SQLite files, with the file's name in front.

    Options: `rows`, the width of a task's range of row ids (100,000; a file makes at most 10,000 ranges, and none for ids that no row has); `damaged`: `fail`, or `row` for a column `damage`, which is null but in the one row
    that stands for a range or file that can't be read (after what could be read of it).  Names and types are those of the first file that has the table, by the declared types'
    affinity.  A column that a file lacks is damage.  Tables without row ids and views are read by one task a file.  An empty table gives no rows.
    """

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def _paths(self) -> list[str]:
        return [p.strip() for p in self.options["path"].split(",") if p.strip()]

    def schema(self) -> str:
        found = "no files"
        for path in self._paths():
            try:
                with closing(_open(path)) as db:
                    columns = db.execute(f"PRAGMA table_info({_name(self.options['table'])})").fetchall()
            except (sqlite3.Error, OSError) as e:
                found = str(e)
                continue
            if columns:
                more = ["damage string"] if self.options.get("damaged") == "row" else []
                return ", ".join(["file string", *[f"`{c[1].replace('`', '``')}` {_type(c[2])}" for c in columns], *more])
            found = "no such table"
        raise ValueError(f"no file has a table {self.options['table']}: {found}")

    def reader(self, schema) -> DataSourceReader:
        columns = [(f.name, f.dataType.simpleString()) for f in schema.fields if f.name not in ("file", "damage")]
        return SqliteReader(self._paths(), self.options["table"], columns, int(self.options.get("rows", 100_000)), self.options.get("damaged") == "row")


class SqliteReader(DataSourceReader):
    def __init__(self, paths: list[str], table: str, columns: list[tuple[str, str]], rows: int, keep: bool):
        self.paths, self.table, self.columns, self.rows, self.keep = paths, table, columns, rows, keep

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in self.paths:
            try:
                with closing(_open(path)) as db:
                    lo, hi = db.execute(f"SELECT min(rowid), max(rowid) FROM {_name(self.table)}").fetchone()
                    if not isinstance(lo, int):  # empty, or a view, whose rows have no ids
                        out.append(InputPartition((path, None, None)))
                        continue
                    width, ranges = max(self.rows, -(-(hi - lo + 1) // 10_000)), []
                    while lo is not None:  # from id to id, so that gaps make no ranges
                        end = min(lo + width - 1, hi)
                        ranges.append(InputPartition((path, lo, end)))
                        lo = db.execute(f"SELECT min(rowid) FROM {_name(self.table)} WHERE rowid > ?", (end,)).fetchone()[0]
                    out += ranges
            except (sqlite3.Error, OSError):  # no row ids, or damage: the task will see
                out.append(InputPartition((path, None, None)))
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path, lo, hi = partition.value
        names = ["file", *[c for c, _ in self.columns], *(["damage"] if self.keep else [])]
        types = [pa.string(), *[ARROW[t] for _, t in self.columns], *([pa.string()] if self.keep else [])]
        schema = pa.schema(list(zip(names, types)))
        try:
            with closing(_open(path)) as db:
                where, given = ("", ()) if lo is None else (" WHERE rowid BETWEEN ? AND ?", (lo, hi))
                # qualified names: an unknown one in quotes alone would be a text
                rows = db.execute(f"SELECT {', '.join(f't.{_name(c)}' for c, _ in self.columns)} FROM {_name(self.table)} t{where}", given)
                for part in _parts(rows):
                    columns = [pa.array(_fitted(c, t), ARROW[t]) for c, (_, t) in zip(zip(*part), self.columns)]
                    more = [pa.nulls(len(part), pa.string())] if self.keep else []
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(part)), *columns, *more], schema=schema)
        except (sqlite3.Error, OSError) as e:
            if not self.keep:
                raise
            yield pa.RecordBatch.from_arrays([pa.array([path]), *[pa.nulls(1, ARROW[t]) for _, t in self.columns], pa.array([f"{type(e).__name__}: {e}"])], schema=schema)


def write_sqlite(df: DataFrame, folder: str, table: str, rows: int = 1_000_000, size: int = 1 << 26) -> list[str]:
    """The table as SQLite files of at most `rows` rows and about `size` bytes below a shared folder, one or more a task; their paths.

    A file is built in memory and written whole under a name of its own for each attempt; only files of attempts that succeeded are returned.  Booleans become 0 and 1, and
    columns that are neither numbers, texts nor bytes become text.  An empty table makes no file.
    """
    root = qualified(df.sparkSession, folder)
    kinds = [DECLARED.get(t, "TEXT") for _, t in df.dtypes]
    columns = ", ".join(f"{_name(c)} {k}" for c, k in zip(df.columns, kinds))
    plain = df.select(*[df[f"`{c.replace('`', '``')}`"].cast("string" if k == "TEXT" else "bigint" if k == "INTEGER" else "double" if k == "REAL" else "binary") for c, k in zip(df.columns, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        context = TaskContext.get()
        files, base = fs.FileSystem.from_uri(root)
        files.create_dir(base, recursive=True)
        db, held, filled, made = None, 0, 0, 0

        def sent() -> pa.RecordBatch:
            nonlocal db, held, filled, made
            db.commit()
            name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{made:03d}.db"
            with files.open_output_stream(f"{base}/{name}") as f:
                f.write(db.serialize())
            db.close()
            db, held, filled, made = None, 0, 0, made + 1
            return pa.RecordBatch.from_arrays([pa.array([f"{root}/{name}"])], ["path"])

        for whole in batches:
            at = 0
            while at < whole.num_rows:
                if db is None:
                    db = sqlite3.connect(":memory:")
                    db.execute(f"CREATE TABLE {_name(table)} ({columns})")
                part = whole.slice(at, min(256, rows - held))
                db.executemany(f"INSERT INTO {_name(table)} VALUES ({', '.join('?' * len(kinds))})", zip(*[c.to_pylist() for c in part.columns]))
                at, held, filled = at + part.num_rows, held + part.num_rows, filled + part.nbytes
                if held >= rows or filled >= size:
                    yield sent()
        if db is not None:
            yield sent()

    return [r["path"] for r in plain.mapInArrow(run, "path string").collect()]
