"""Edges replaced, block by block inside the tasks, by a star for each group that the block's edges connect."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Edges contracted together: a bound of a task's memory, not of the edges.
BLOCK_EDGES = 500_000


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node but the least of its group, and the least one."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[:len(u)], place[len(u):]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root, further := root[root]):
            root = further
    rest = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[rest], nodes[root[rest]]


def contract(edges: DataFrame) -> DataFrame:
    """``u, v`` (long) that connect the same nodes as ``edges`` do, at most one edge for each node of a block; needs no shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        room = 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            room += batch.num_rows
            if room >= BLOCK_EDGES:
                yield _rows(held)
                held, room = [], 0
        if held:
            yield _rows(held)

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def _rows(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    u, v = stars(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
