"""Payloads of partitions combined a few at a time, level after level, so that no task and not the driver sees them all."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podwatch.llm.scratch import Scratch

FAN_IN = 8
PART = "part long, payload binary"


def one_part(payload: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([payload], pa.binary())], ["part", "payload"]
    )


def combined(parts: DataFrame, join: Callable[[list[bytes]], bytes], scratch: Scratch, name: str) -> bytes | None:
    """The payloads of all parts as one, joined FAN_IN at a time in order of parts; None if there is none."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        part = table.column("part")[0].as_py() // FAN_IN
        return pa.table({"part": pa.array([part], pa.int64()), "payload": pa.array([join(table.column("payload").to_pylist())], pa.binary())})

    level = 0
    parts = scratch.written(parts, f"{name}-0")
    while (top := parts.agg(F.max("part")).first()[0] or 0) > 0:
        level += 1
        # Parts are numbered by partition; numbers of groups are the places of the next level.
        grouped = parts.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(run, PART)
        parts = scratch.written(grouped, f"{name}-{level}")
        if top < FAN_IN:
            break
    found = parts.first()
    return None if found is None else bytes(found["payload"])


def summed(payloads: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(p) for p in payloads], axis=0).tobytes()
