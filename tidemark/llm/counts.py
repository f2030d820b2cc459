"""Sums of fixed-size numpy tables over all tasks: each task hands on its table in blocks, Spark adds the blocks.

What reaches the driver is as large as the tables, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 4096
COUNTED = "name string, block int, counts binary"


def block_batch(tables: dict[str, np.ndarray]) -> pa.RecordBatch:
    """The blocks of some tables that are not all zero."""
    names, blocks, counts = [], [], []
    for name, table in tables.items():
        for at in range(0, len(table), BLOCK):
            part = table[at : at + BLOCK]
            if part.any():
                names.append(name)
                blocks.append(at // BLOCK)
                counts.append(part.astype("<i8").tobytes())
    arrays = [pa.array(names, pa.string()), pa.array(blocks, pa.int32()), pa.array(counts, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["name", "block", "counts"])


def add_blocks(keys: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of one block: at most one row per task comes in, and they are added as they come."""
    total = None
    for batch in groups:
        for counts in batch.column("counts"):
            part = np.frombuffer(counts.as_py(), "<i8")
            total = part.copy() if total is None else total + part
    name, block = (k.as_py() for k in keys)
    arrays = [pa.array([name]), pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())]
    yield pa.RecordBatch.from_arrays(arrays, ["name", "block", "counts"])


def summed_tables(counted: DataFrame) -> dict[str, dict[int, np.ndarray]]:
    """Per table its blocks by number, from a frame of blocks as the tasks made them."""
    found: dict[str, dict[int, np.ndarray]] = {}
    for row in counted.groupBy("name", "block").applyInArrow(add_blocks, COUNTED).collect():
        found.setdefault(row.name, {})[row.block] = np.frombuffer(row.counts, "<i8")
    return found


def filled(blocks: dict[int, np.ndarray], size: int) -> np.ndarray:
    table = np.zeros(size, np.int64)
    for block, counts in blocks.items():
        table[block * BLOCK : block * BLOCK + len(counts)] = counts
    return table


def bit_filter(rows: DataFrame, hashed: str, bits: int) -> np.ndarray:
    """A table of 2**bits bits with one set per value of a column of hashes, made by Spark and as large at any input."""
    slot = F.col(hashed).bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), slot.bitwiseAND(F.lit(63)).cast("int"))
    words = rows.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return table


def has_bit(table: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    slot = hashes.astype(np.uint64) & np.uint64((1 << bits) - 1)
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
