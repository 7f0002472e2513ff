"""Sum-of-squares packing of token sequences.

Documents become pieces of at most ``capacity`` ids; pieces become full training sequences. A piece is
placed where the sum over gaps g of N(g)^2 becomes smallest, N(g) being the number of open sequences with
g free places: the rule keeps gaps varied, so that later pieces find a perfect fit.

Distribution: pieces are dealt to groups of about ``group_rows`` by a hash of their place, each packed by itself in a task
of bounded size (a row there holds no ids). Sequences that a group leaves with more than ``loose`` free
places are opened again and their pieces packed together in a second round of fewer groups.

Defined cases: a null text counts as empty and has just the end id; a null doc_id is carried like any other;
repeated rows are packed each; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessarea.llm.common import library_encoder, once, slices
from tessarea.session import Scratch

PIECES = "doc_id long, piece int, start long, length long, ids binary"


def encode_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (packed little-endian unsigned 32-bit).

    Only a document of more than ``capacity`` ids, the end id included, is cut."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = once(("library", tokenizer), lambda: library_encoder(tokenizer))
        for rows in slices(batches):
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(rows["doc_id"], rows["text"], strict=True):
                ids = encode(text or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, value in zip(out, (doc_id, piece, at // 4, len(part) // 4, part), strict=True):
                        column.append(value)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, schema.types, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each length in turn: the number of its sequence and its place there.

    Placing a length s in a gap g changes the sum of squares by 2 N(g - s) - 2 N(g) + 2, where a perfect fit
    leaves no gap and adds one less. Of the open sequences with room the one with the smallest change takes
    the piece, ties going to the smallest gap; only if none has room a new sequence is opened. Lengths in
    falling order give the fewest sequences."""
    count = np.zeros(capacity + 1, np.int64)
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i, s in enumerate(lengths.tolist()):
        if s == capacity:
            where[i], offset[i], made = made, 0, made + 1
            continue
        change = 2 * (count[: capacity - s + 1] - count[s:])
        closed = count[s:] == 0
        closed[-1] = False
        change[0] -= 1  # a perfect fit leaves no gap behind
        change[-1] = np.iinfo(np.int64).max - 1  # a new sequence, if all others are closed
        change[closed] = np.iinfo(np.int64).max
        g = s + int(change.argmin())
        if g == capacity:
            b, made = made, made + 1
        else:
            b = open_by_gap[g].pop()
            count[g] -= 1
        where[i], offset[i] = b, capacity - g
        if g > s:
            open_by_gap[g - s].append(b)
            count[g - s] += 1
    return where, offset


def pack_pieces(pieces: DataFrame, capacity: int = 2048, group_rows: int = 40_000, loose: int = 8) -> DataFrame:
    """``pieces`` (any frame with doc_id, piece, length) with sequence_id and offset. Pieces that share a key are told apart by nothing, and need not be."""
    scratch = Scratch(pieces.sparkSession, "packing")
    pieces = scratch.keep(pieces, "pieces")
    first = _round(pieces, capacity, group_rows, 0)
    first = scratch.keep(first, "first")
    closed, again = first.filter(F.col("_gap") <= loose), first.filter(F.col("_gap") > loose)
    second = _round(again.select(*pieces.columns), capacity, group_rows, 1)
    return closed.unionByName(second).drop("_gap")


def _round(pieces: DataFrame, capacity: int, group_rows: int, which: int) -> DataFrame:
    groups = max(1, math.ceil(pieces.count() / group_rows))
    kept = [c for c in pieces.columns]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        where, offset = sum_of_squares(rows["length"].to_numpy(np.int64), capacity)
        used = np.bincount(where, rows["length"].to_numpy(np.float64)).astype(np.int64) if len(rows) else np.empty(0, np.int64)
        base = (np.int64(rows["_group"].iloc[0]) * 2 + which) << np.int64(32)
        return rows[kept].assign(sequence_id=base + where, offset=offset, _gap=capacity - used[where])

    # By the row's place in the written table: rows without doc_id, or with the same, are spread like others.
    keyed = pieces.withColumn("_group", F.pmod(F.xxhash64(F.lit(which), F.monotonically_increasing_id()), F.lit(groups)))
    return keyed.groupBy("_group").applyInPandas(run, f"{fields}, sequence_id long, offset long, _gap long")
