"""Keyframe selection: a new keyframe only after enough motion since the last one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def moved(now: float, last: float, least: float) -> bool:
    """An unknown value is no motion; a known one after an unknown one is."""
    return now == now and (last != last or abs(now - last) >= least)


def select(poses: DataFrame, linear: float, angular: float, device: str = "device", order: list[str] | None = None) -> DataFrame:
    """Rows (device, stamp in microseconds, id, distance, angle) whose distance or angle differs from the device's last keyframe's by at least the limits.

    A device's first row is a keyframe, and rows without a device are one device.  The choice depends on the rows before, so a device's rows are read
    in order by one task, in batches: only the last keyframe of the current device is held.
    """
    order = order or ["stamp", "id"]
    key = F.coalesce(F.concat(F.lit("d"), F.col(device).cast("string")), F.lit("")).alias("__key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        device_now, d, a = None, 0.0, 0.0
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            number = lambda c: np.asarray(b.column(b.schema.get_field_index(c)).cast(pa.float64()).fill_null(float("nan"))).tolist()  # noqa: B023, E731
            for i, (who, distance, angle) in enumerate(zip(b.column(0).to_pylist(), number("distance"), number("angle"))):
                if who != device_now or moved(distance, d, linear) or moved(angle, a, angular):
                    device_now, d, a = who, distance, angle
                    keep[i] = True
            yield pa.RecordBatch.from_arrays(b.columns[1:], schema=pa.schema(list(b.schema)[1:])).filter(pa.array(keep))

    return poses.select(key, *poses.columns).repartition("__key").sortWithinPartitions("__key", *order).mapInArrow(run, poses.schema)
