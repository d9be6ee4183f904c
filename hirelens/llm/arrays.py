"""Sum numpy arrays that tasks make, without one task or the driver ever holding more than one sum."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 4096
#: Tasks spread their rows over so many salts.
SALTS = 64
SCHEMA = "name string, block int, salt int, n array<double>"
_ARROW = pa.schema([("name", pa.string()), ("block", pa.int32()), ("salt", pa.int32()), ("n", pa.list_(pa.float64()))])


def blocks(name: str, values: np.ndarray, salt: int = 0) -> Iterator[pa.RecordBatch]:
    """The array in blocks, those of zeros left out, as rows of SCHEMA."""
    flat = np.asarray(values, float).ravel()
    padded = np.concatenate([flat, np.zeros(-len(flat) % BLOCK)]).reshape(-1, BLOCK)
    some = np.flatnonzero(padded.any(axis=1))
    for at in range(0, len(some), 256):
        own = some[at:at + 256]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(own) * BLOCK + 1, BLOCK, dtype=np.int32)), pa.array(padded[own].ravel()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(own)), pa.array(own.astype(np.int32)), pa.array(np.full(len(own), salt, np.int32)), lists], schema=_ARROW)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum each run of rows with the same name, block and salt; one sum is held at a time."""
    key, total = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]], pa.int32()), pa.array([key[2]], pa.int32()), pa.array([total], pa.list_(pa.float64()))], schema=_ARROW)

    for batch in batches:
        numbers = np.asarray(batch.column(3).flatten()).reshape(-1, BLOCK)
        for i, now in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)))):
            if now != key:
                if key is not None:
                    yield row()
                key, total = now, np.zeros(BLOCK)
            total = total + numbers[i]
    if key is not None:
        yield row()


def summed(made: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows of SCHEMA added up by name and block: by salt first, so that thousands of tasks do not meet in one. Few `tasks` need no salt."""
    few = tasks is not None and tasks <= SALTS
    for keys in [["name", "block"]] if few else [["name", "block", "salt"], ["name", "block"]]:
        if "salt" not in keys:
            made = made.withColumn("salt", F.lit(0))
        made = made.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_add, SCHEMA)
    return made


def collected(sums: DataFrame, shapes: dict[str, tuple[int, ...]]) -> dict[str, np.ndarray]:
    """The arrays of the given names and shapes on the driver; their size is fixed by the shapes."""
    out = {name: np.zeros(-(-int(np.prod(shape)) // BLOCK) * BLOCK) for name, shape in shapes.items()}
    for r in sums.toArrow().to_batches():
        for name, block, n in zip(r.column("name").to_pylist(), r.column("block").to_pylist(), r.column("n")):
            out[name][block * BLOCK:(block + 1) * BLOCK] = n.values.to_numpy()
    return {name: out[name][:int(np.prod(shape))].reshape(shape) for name, shape in shapes.items()}
