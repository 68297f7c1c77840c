"""Token sequences of one length out of whole documents, by Karmarkar-Karp differencing.

Every document becomes ids and an end id, cut by its own length alone: as many whole sequences as it
fills, and the rest in pieces of at most ``grain`` ids. So texts never travel: one pass over them
leaves a small row per piece, and only those rows are packed. Groups of pieces (dealt evenly, about
``windows`` sequences each, whatever the size of the table) are packed by largest differencing: the two partial
partitions with the widest spread are merged, fullest windows of one with emptiest of the other,
until one is left, whose windows are almost equal. The least number of windows is tried first; it
rises by one whenever a window exceeds the capacity.

Cases: a null text is its end id alone; repeated rows are packed each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.store import lean, stored
from maskloom.llm.tokens import encoder

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECES}, sequence_id long, offset long"
_SLOT = 33


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, grain: int) -> DataFrame:
    """The pieces of all documents, and ``slot``: a number of its own for each."""
    schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")] + [("slot", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, slot = encoder(tokenizer), TaskContext.get().partitionId() << _SLOT
        end = np.array([end_id], words.dtype).tobytes()
        for batch in batches:
            doc_ids, rows = batch.column(0).to_pylist(), []
            for doc_id, found in zip(doc_ids, words.batch(v.as_py() for v in batch.column(1))):
                ids = np.frombuffer(found + end, words.dtype).astype("<u4")
                full = len(ids) // capacity * capacity
                starts = [*range(0, full, capacity), *range(full, len(ids), grain), len(ids)]
                for a, b in zip(starts, starts[1:]):
                    rows.append((doc_id, a, b - a, zlib.crc32(ids[a:b].tobytes()), len(ids), slot))
                    slot += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 6, schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(cut), f"{PIECES}, slot long")


def difference(lengths: np.ndarray, windows: int) -> np.ndarray:
    """Karmarkar-Karp: a window for each length, their sums as near to equal as differencing gets."""
    n = len(lengths)
    # A window of a partial partition is a tree: numbers below n are pieces, others join two trees.
    left, right = [-1] * n, [-1] * n
    heap = []
    for i in range(n):
        sums = np.zeros(windows, np.int64)
        trees = np.full(windows, -1, np.int64)
        sums[0], trees[0] = lengths[i], i
        heap.append((-int(lengths[i]), i, sums, trees))
    heapq.heapify(heap)
    count = n
    while len(heap) > 1:
        _, _, sums, trees = heapq.heappop(heap)
        _, _, other, others = heap[0]
        # Sums fall along a partition; the other one is laid against it the other way round.
        sums, others = sums + other[::-1], others[::-1]
        both = np.flatnonzero((trees >= 0) & (others >= 0))
        joined = np.where(trees >= 0, trees, others)
        if len(both):
            left.extend(trees[both].tolist())
            right.extend(others[both].tolist())
            joined[both] = np.arange(len(left) - len(both), len(left))
        order = np.argsort(-sums, kind="stable")
        sums, joined = sums[order], joined[order]
        count += 1
        heapq.heapreplace(heap, (int(sums[-1] - sums[0]), count, sums, joined))
    window = np.zeros(n, np.int64)
    if heap:
        for at, tree in enumerate(heap[0][3].tolist()):
            waiting = [tree] if tree >= 0 else []
            while waiting:
                node = waiting.pop()
                if node < n:
                    window[node] = at
                else:
                    waiting += (left[node], right[node])
    return window


def fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Windows for the lengths (each within the capacity), as few as differencing keeps within the capacity."""
    windows = -(-int(lengths.sum()) // capacity)
    while True:
        window = difference(lengths, windows)
        if len(lengths) == 0 or np.bincount(window, lengths).max() <= capacity:
            return window
        windows += 1


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048, grain: int = 512, windows: int = 192
) -> DataFrame:
    """Every piece of every document with its sequence and place in it."""
    pieces = stored(cut_documents(docs, tokenizer, end_id, capacity, grain), "pieces")
    whole = pieces.where(F.col("length") == capacity).select(
        *[c.split()[0] for c in PIECES.split(", ")], (F.col("slot") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = pieces.where(F.col("length") < capacity)
    total = rest.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (capacity * windows)))

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("slot", ignore_index=True)
        group["sequence_id"] = fit(group["length"].to_numpy(), capacity)
        group["offset"] = group.groupby("sequence_id")["length"].cumsum() - group["length"]
        group["sequence_id"] = (group["part"] * 2**20 + group["sequence_id"]) * 2 + 1
        return group[[c.split()[0] for c in PACKED.split(", ")]]

    return whole.unionByName(
        rest.withColumn("part", F.pmod(F.xxhash64("slot"), F.lit(groups))).groupBy("part").applyInPandas(packed, PACKED)
    )
