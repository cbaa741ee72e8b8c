"""A recording played as a stream: messages come when a clock that runs at `rate` times the wall clock reaches their stamps.

    spark.dataSource.register(ReplaySource)
    spark.readStream.format("replay").option("path", folder).option("stamp", "ts").option("rate", 0.5).option("begin", time.time()).load()

The clock stands at the recording's first stamp at `begin` (seconds of the epoch; the start of the query if it isn't given).  An offset is a time of the recording, so a query that is
restarted from its checkpoint, with the same `begin`, takes up where it was and gets what was played meanwhile, each message once.  A trigger's messages are read by
row groups of the Parquet files, each a task, and only groups whose stamps overlap the trigger's stretch.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType


def _files(path: str) -> tuple[fs.FileSystem, list[str]]:
    files, at = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    info = files.get_file_info(at)
    if info.type == fs.FileType.File:
        return files, [at]
    found = files.get_file_info(fs.FileSelector(at, recursive=True))
    return files, sorted(f.path for f in found if f.path.endswith(".parquet") and not f.base_name.startswith(("_", ".")))


def _micros(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Stamps in microseconds; null is the least number, which no stretch holds."""
    us = pc.cast(pc.cast(column, pa.timestamp("us", getattr(column.type, "tz", None)), safe=False), pa.int64())
    return np.asarray(pc.fill_null(us, np.iinfo(np.int64).min))


def _plain(schema: pa.Schema) -> pa.Schema:
    """Nanoseconds, as old files have them, become microseconds; they have no zone and are UTC."""
    return pa.schema([f.with_type(pa.timestamp("us", f.type.tz)) if pa.types.is_timestamp(f.type) else f for f in schema]).remove_metadata()


class ReplaySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "replay"

    def schema(self) -> StructType:
        files, names = _files(self.options["path"])
        if not names:
            raise ValueError(f"{self.options['path']} has no Parquet files")
        return from_arrow_schema(_plain(pq.read_schema(names[0], filesystem=files)))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ReplayReader(self.options["path"], self.options.get("stamp", "stamp"), float(self.options.get("rate", 1.0)), float(self.options.get("begin", time.time())), schema.names)


class Group(InputPartition):
    def __init__(self, file: str, group: int, start: int, end: int):
        self.file, self.group, self.start, self.end = file, group, start, end


class ReplayReader(DataSourceStreamReader):
    def __init__(self, path: str, stamp: str, rate: float, begin: float, columns: list[str]):
        if rate <= 0:
            raise ValueError("the rate of a replay is above 0")
        self.path, self.stamp, self.rate, self.begin, self.columns = path, stamp, rate, begin, columns
        files, names = _files(path)
        self.groups = []  # file, row group, first and last stamp: of metadata where it is there
        for name in names:
            file = pq.ParquetFile(name, filesystem=files)
            place = file.schema_arrow.get_field_index(stamp)
            if place < 0:
                raise ValueError(f"{name} has no column {stamp}")
            for g in range(file.num_row_groups):
                t = _micros(file.read_row_group(g, [stamp]).column(0))
                t = t[t > np.iinfo(np.int64).min]
                if len(t):
                    self.groups.append((name, g, int(t.min()), int(t.max())))
        self.first, self.last = min((g[2] for g in self.groups), default=0), max((g[3] for g in self.groups), default=-1)

    def initialOffset(self) -> dict:
        return {"t": self.first}

    def latestOffset(self) -> dict:
        """What has been played is before this time of the recording."""
        played = self.first + int(max(0.0, time.time() - self.begin) * self.rate * 1e6)
        return {"t": max(self.first, min(played, self.last + 1))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Group(name, g, start["t"], end["t"]) for name, g, low, high in self.groups if low < end["t"] and high >= start["t"]]

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")
        table = pq.ParquetFile(partition.file, filesystem=files).read_row_group(partition.group, self.columns)
        t = _micros(table.column(self.stamp))
        table = table.filter(pa.array((t >= partition.start) & (t < partition.end))).select(self.columns)
        yield from table.cast(_plain(table.schema), safe=False).to_batches(max_chunksize=10_000)
