"""Every two rows of a group meet once, in tasks of bounded size.

Groups of any size, a third of all rows included, are cut into blocks; what a task reads is
bounded by two blocks, and what it emits by the rows it read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS, BLOCK_BYTES = 1024, 4 << 20


def meetings(members: DataFrame, group: str, key: str, volume: str, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows dealt so that every two rows of a group meet in exactly one (group, low, high).

    A group of more than a block is cut into blocks by the keys' hash; a block is repeated
    for every block it meets. ``block`` tells a row's own.
    """
    totals = members.groupBy(group).agg(F.count("*").alias("_n"), F.sum(volume).alias("_v"))
    blocks = F.greatest(F.ceil(F.col("_n") / block_rows), F.ceil(F.col("_v") / block_bytes), F.lit(1)).cast("int")
    return (
        members.join(totals.select(group, blocks.alias("_blocks")), group)
        .withColumn("block", F.pmod(F.xxhash64(key), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("low", F.least("block", "_other")).withColumn("high", F.greatest("block", "_other"))
        .drop("_blocks", "_other")
    )


def clusters(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """The least member of each of ``size`` nodes' cluster, given linked pairs."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def tally(ids: np.ndarray, copies: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    """(class, links, root) of the linked rows: how many copies each links to, and its local cluster."""
    links = np.bincount(left, copies[right], len(ids)) + np.bincount(right, copies[left], len(ids))
    order = np.argsort(ids)  # the least id of a cluster is its root
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    root = order[clusters(place[left], place[right], len(ids))][place]
    some = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(ids[root[some]])], names=["class", "links", "root"]
    )


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows of equal keys as one table, with the values of all keys but the first."""
    held: list[pa.RecordBatch] = []
    now: tuple | None = None

    def group() -> tuple[tuple, pa.Table]:
        return now[1:], pa.Table.from_batches(held)

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[k].to_numpy() for k in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for a, b in zip([0, *change], [*change, batch.num_rows], strict=True):
            here = tuple(c[a].item() for c in columns)
            if here != now and held:
                yield group()
                held = []
            now = here
            held.append(batch.slice(a, b - a))
    if held:
        yield group()
