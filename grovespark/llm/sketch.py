"""Sketches of hashes: made by each partition, merged by Spark, then small enough to broadcast.

A sketch has `depth` rows of 2 ** bits cells, kept as sorted cell numbers in
blocks of 2 ** BLOCK cells. Counts stop at 2, as nothing above matters here.
Sketches are merged FAN_IN at a time, in as many rounds as that takes, so a
group never holds more than FAN_IN blocks, whatever the number of partitions.
What is collected is one bit a cell: depth * 2 ** bits / 8 bytes, whatever the
input. More hashes than cells only make more estimates too high; none is ever
too low.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbatch as tb

BLOCK = 18
FAN_IN = 32


def cells_of(h: np.ndarray, bits: int, row: int) -> np.ndarray:
    return (tb.mixed(h + np.uint64(row * 0x632BE5AB)) >> np.uint64(64 - bits)).astype(np.uint32)


def _twice(cells: np.ndarray) -> np.ndarray:
    """Sorted, with at most two copies of each."""
    cells = np.sort(cells)
    if len(cells) > 2:
        cells = cells[np.append([True, True], cells[2:] != cells[:-2])]
    return cells


def _packed(cells: np.ndarray) -> bytes:
    return np.diff(cells, prepend=np.uint32(0)).astype(np.uint32).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.uint32), dtype=np.uint32)


def partition_sketch(hashes: Iterable[np.ndarray], bits: int, depth: int) -> Iterator[pa.RecordBatch]:
    """Rows (block, cells) of what one partition holds."""
    held: list[list[np.ndarray]] = [[] for _ in range(depth)]
    n = 0
    for h in hashes:
        n += len(h)
        for row in range(depth):
            held[row].append(cells_of(h, bits, row))
        if n > 1 << 22:
            held = [[_twice(np.concatenate(x))] for x in held]
            n = 0
    for row in range(depth):
        cells = _twice(np.concatenate(held[row])) if held[row] else np.zeros(0, np.uint32)
        if len(cells):
            block = cells >> np.uint32(min(BLOCK, bits))
            cut = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            numbers = [int(block[i]) + (row << 24) for i in cut]
            inner = cells & np.uint32((1 << min(BLOCK, bits)) - 1)
            yield pa.RecordBatch.from_pydict({"block": pa.array(numbers, pa.int64()), "cells": pa.array([_packed(x) for x in np.split(inner, cut[1:])], pa.binary())})


def bitmap(parts: DataFrame, bits: int, depth: int, least: int) -> np.ndarray:
    """The merged sketch as bits (depth x 2 ** bits / 8 bytes): set where the count is `least` (1 or 2) or more. parts: (block, cells)."""
    partitions = parts.rdd.getNumPartitions()
    width = 1 << min(BLOCK, bits)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        cells = _twice(np.concatenate([_unpacked(x) for x in group["cells"]]))
        return pd.DataFrame({"block": group["block"].iloc[:1], "cells": [_packed(cells)], "part": group["part"].iloc[:1]})

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        cells = _twice(np.concatenate([_unpacked(x) for x in group["cells"]]))
        if least > 1:
            cells = cells[1:][cells[1:] == cells[:-1]]
        flags = np.zeros(width, bool)
        flags[cells] = True
        return pd.DataFrame({"block": group["block"].iloc[:1], "bits": [np.packbits(flags).tobytes()]})

    rows, n = parts.withColumn("part", F.spark_partition_id()), partitions
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        rows = rows.withColumn("part", F.col("part") % n).groupBy("block", "part").applyInPandas(merge, "block long, cells binary, part int")
    rows = rows.groupBy("block").applyInPandas(finish, "block long, bits binary")
    out = np.zeros((depth, (1 << bits) // 8), np.uint8)
    for block, raw in rows.toLocalIterator():
        at = (block & 0xFFFFFF) * (width // 8)
        out[block >> 24, at : at + width // 8] = np.frombuffer(raw, np.uint8)
    return out


def sketched(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, depth: int, least: int) -> np.ndarray:
    """The bitmap over all hashes that `hashes` takes from the batches of df."""
    def run(batches):
        yield from partition_sketch((h for batch in batches for h in hashes(batch)), bits, depth)

    return bitmap(df.mapInArrow(run, "block long, cells binary"), bits, depth, least)


def present(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Whether every row has h's cell set."""
    out = np.ones(len(h), bool)
    for row, flags in enumerate(bitmap):
        c = cells_of(h, bits, row)
        out &= (flags[c >> np.uint32(3)] >> (np.uint8(7) - (c & np.uint32(7)).astype(np.uint8))) & 1 > 0
    return out
