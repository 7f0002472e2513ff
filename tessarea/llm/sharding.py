"""Minimax contiguous partition of documents into shards.

Equal texts are one group and are never parted. Groups lie in the order of a hash of their text. Runs of groups with the
same leading bits are ordered atoms (2^16 by default), of which the driver sees one row each; by binary search it finds the smallest
shard capacity for which a greedy pass over the ordered sizes needs no more shards than there are. The atoms beside the
cuts are then parted by ten more bits, as a rule into their groups, and the search is made once more, so cuts fall between groups.

Among the cuts that keep the capacity those are taken that lie nearest to even shares of what is left. A group larger than an even share
sets the capacity; it has a shard of its own, and what lies before and after it is cut anew into the other shards, each
part into as many as its bytes ask for, unless that would exceed the capacity.

A slot is the number of rows of the shard before the atom plus the rank in it; atoms with many rows are ranked
in parts, each of at most about ``rank_rows`` rows.

Defined cases: a null text has no bytes, the crc of an empty text, and forms a group apart from the empty text; a
null doc_id sorts first; repeated rows each take a slot; an empty table gives no rows; other columns are ignored unless
named in ``keep``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessarea.session import Scratch


def greedy_cuts(sizes: np.ndarray, capacity: int) -> list[int]:
    """Ends of the runs that a greedy pass makes, none above ``capacity``."""
    total, cuts, at = np.concatenate([[0], np.cumsum(sizes)]), [], 0
    while at < len(sizes):
        to = int(np.searchsorted(total, total[at] + capacity, "right")) - 1
        if to <= at:
            raise ValueError("an atom exceeds the capacity")
        cuts.append(to)
        at = to
    return cuts


def minimax_cuts(sizes: np.ndarray, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity with which the ordered sizes fit into ``shards`` runs, and the ends of the runs."""
    if not len(sizes):
        return 0, []
    low, high = max(int(sizes.max()), -(-int(sizes.sum()) // shards)), int(sizes.sum())
    while low < high:
        middle = (low + high) // 2
        if len(greedy_cuts(sizes, middle)) <= shards:
            high = middle
        else:
            low = middle + 1
    return low, greedy_cuts(sizes, low)


def even_cuts(sizes: np.ndarray, shards: int, capacity: int) -> list[int]:
    """Ends of ``shards`` runs within a capacity that can be kept, each as near as may be to an even share of the rest."""
    total, n = np.concatenate([[0], np.cumsum(sizes)]), len(sizes)
    fits = [n]  # from fits[k] on, k runs are enough
    for _ in range(shards):
        fits.append(int(np.searchsorted(total, total[fits[-1]] - capacity, "left")))
    cuts, at = [], 0
    for left in range(shards, 1, -1):
        low, high = max(fits[left - 1], min(at + 1, n)), int(np.searchsorted(total, total[at] + capacity, "right")) - 1
        goal = total[at] + (total[n] - total[at]) / left
        to = int(np.searchsorted(total, goal))
        to = to - 1 if to > n or to > 0 and goal - total[to - 1] <= total[min(to, n)] - goal else to
        at = min(max(to, low), high)
        cuts.append(at)
    return [*cuts, n]


def place_atoms(sizes: np.ndarray, shards: int) -> tuple[int, np.ndarray]:
    """The smallest capacity, and the shard of each atom: contiguous runs that keep it, near equal beside what sets it."""
    if not len(sizes):
        return 0, np.zeros(0, np.int64)
    capacity, _ = minimax_cuts(sizes, shards)
    cuts = _around_large(sizes, shards, capacity) or even_cuts(sizes, shards, capacity)
    return capacity, np.searchsorted(np.array(cuts, np.int64), np.arange(len(sizes)), "right")


def _around_large(sizes: np.ndarray, shards: int, capacity: int) -> list[int] | None:
    """Cuts that give each atom above an even share a shard of its own; None if there is none, or where the rest can't keep the capacity so."""
    large = np.flatnonzero(sizes * shards > sizes.sum()).tolist()
    edges = [-1, *large, len(sizes)]
    parts = [(a + 1, b) for a, b in zip(edges, edges[1:], strict=False) if b > a + 1]
    spare = shards - len(large)
    if not large or len(parts) > spare:
        return None
    given = [1] * len(parts)
    weights = [int(sizes[a:b].sum()) for a, b in parts]
    for _ in range(spare - len(parts) if parts else 0):
        i = max(range(len(parts)), key=lambda i: weights[i] / given[i])
        given[i] += 1
    cuts = [i + 1 for i in large]
    for (a, b), k in zip(parts, given, strict=True):
        own = minimax_cuts(sizes[a:b], k)[0]
        if own > capacity:
            return None
        cuts += [a + c for c in even_cuts(sizes[a:b], k, own)]
    return sorted(cuts)


def assign_shards(docs: DataFrame, shards: int = 24, bits: int = 16, more: int = 10, rank_rows: int = 4_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size (bytes of the text plus 8), text_crc32, shard and slot of every row, and the columns in ``keep``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw) + 8).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64("text", F.col("text").isNull()), 64 - bits - more).cast("int").alias("_fine"),
        F.rand(7).alias("_salt"),
        *[F.col(c).alias(f"_kept_{c}") for c in keep],
    )
    rows = scratch.keep(rows, "rows")
    coarse = F.shiftright("_fine", more)
    counted = lambda df, atom: df.groupBy(atom.alias("_atom")).agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).toPandas().sort_values("_atom", ignore_index=True)
    atoms = counted(rows, coarse)
    _, shard = place_atoms(atoms["bytes"].to_numpy(np.int64), shards)
    # The atoms on both sides of a cut, at most two a cut; what was one row of the driver becomes at most 2^more.
    ends = np.flatnonzero(np.diff(shard))
    beside = sorted({int(a) for a in atoms["_atom"].to_numpy()[np.concatenate([ends, ends + 1])]}) if len(ends) else []
    fine = counted(rows.filter(coarse.isin(beside)), F.col("_fine")) if beside else atoms.iloc[:0]
    others = atoms[~atoms["_atom"].isin(beside)].assign(_atom=lambda x: x["_atom"] * 2**more)
    atoms = pd.concat([others, fine]).sort_values("_atom", ignore_index=True)
    placed = atoms.assign(shard=place_atoms(atoms["bytes"].to_numpy(np.int64), shards)[1], parts=-(-atoms["n"] // rank_rows))
    hot = placed[placed["parts"] > 1]
    parts = spark.createDataFrame([(int(a), int(p)) for a, p in zip(hot["_atom"], hot["parts"], strict=True)], "_atom int, _parts int")
    rows = rows.withColumn("_atom", F.when(coarse.isin(beside), F.col("_fine")).otherwise(F.shiftleft(coarse, more)) if beside else F.shiftleft(coarse, more))
    # Both lists have at most a row for each atom; the offsets, a row for each part, are made and joined in Spark.
    dealt = rows.join(parts, "_atom", "left").withColumn("_part", F.floor(F.col("_salt") * F.coalesce("_parts", F.lit(1))).cast("int"))
    shard_of = spark.createDataFrame([(int(a), int(x)) for a, x in zip(placed["_atom"], placed["shard"], strict=True)], "_atom int, shard int")
    counts = dealt.groupBy("_atom", "_part").agg(F.count("*").alias("n")).join(shard_of, "_atom")
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("_atom", "_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_atom", "_part", "shard", F.coalesce(before, F.lit(0)).cast("long").alias("_first"))
    rank = F.row_number().over(Window.partitionBy("_atom", "_part").orderBy("doc_id", "text_crc32"))
    return (
        dealt.withColumn("_rank", rank)
        .join(offsets, ["_atom", "_part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("_first") + F.col("_rank") - 1).cast("long").alias("slot"), *[F.col(f"_kept_{c}").alias(c) for c in keep])
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24) -> None:
    """The documents themselves, a folder per shard, rows of a folder ordered by slot within each file."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "size", "text_crc32", "shard", "slot"))
    assign_shards(docs, shards, keep=others).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
