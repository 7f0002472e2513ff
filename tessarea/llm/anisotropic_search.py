"""Nearest neighbours by largest cosine: anisotropic product quantisation, four-bit table scans, exact reranking.

Vectors are scaled to length 1 and cut into two-dimensional parts, each coded by one of 16 words. The loss weighs the residual's
part along the vector ``eta`` times, since that part changes inner products with near queries most:
|r|^2 + (eta - 1) <r, x>^2. Codes and words are found by coordinate descent over the parts, words by weighted least
squares; they are fitted on a bounded sample (``SAMPLE`` vectors by a hash), and every vector is coded.

The index is dealt into cells of about ``CELL`` vectors by a hash, the stated queries into blocks of about ``BLOCK``; each pair
of block and cell is a bounded task that makes the tables of ``AT_ONCE`` queries at a time, looks up two four-bit codes at a
time in them and ranks the best ``RERANK`` distinct vectors by exact cosine in double precision. With N vectors and Q queries
N Q / BLOCK vectors and N Q / CELL queries are shuffled. A rough score is off by no more than the length of the vector's residual, so
every other vector whose rough score and residual together reach the nearest found so far is ranked exactly as well: what is
left out can't be among the ``k`` nearest. Copies of a vector are scanned once a cell; the copies with the smallest ids stand
for them. The best of all cells are ranked at the end.

Defined cases: a vector that is null, zero, or holds a null or a non-finite component, or has no id, takes no part, nor does one
that has another length than most (of equally frequent lengths the smallest); ties go to the smaller id; of rows that share a vec_id
each is a vector and, if its id is asked for, a query of its own, whose candidates the others are; vectors of any finite size are compared without overflow; a query has fewer rows where there are fewer candidates; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessarea.llm.common import hash_edge, slices
from tessarea.session import Scratch

SAMPLE, WORDS, CELL, BLOCK, RERANK, AT_ONCE = 16_384, 16, 8_192, 16_384, 96, 256


def eta(dim: int, threshold: float = 0.2) -> float:
    """Weight of the parallel residual for inner products above ``threshold``."""
    return max(1.0, (dim - 1) * threshold**2 / (1 - threshold**2))


def scaled(x: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, so that the largest component lies from 1/2 to 1: cosines stay to the bit, and no square overflows or vanishes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)).astype(np.float32)


def parts_of(x: np.ndarray) -> np.ndarray:
    """(N, D) to (M, N, 2), an odd dimension filled with 0."""
    if x.shape[1] % 2:
        x = np.concatenate([x, np.zeros((len(x), 1), x.dtype)], 1)
    return np.ascontiguousarray(x.reshape(len(x), -1, 2).transpose(1, 0, 2))


def encode(x: np.ndarray, words: np.ndarray, weight: float, rounds: int = 3) -> np.ndarray:
    """Codes (M, N) of unit vectors by coordinate descent on the anisotropic loss; words (M, 16, 2)."""
    p = parts_of(x)
    square = ((p[:, :, None, :] - words[:, None]) ** 2).sum(3) if len(x) <= 4096 else None
    codes = np.empty((len(p), len(x)), np.uint8)
    along = np.zeros((len(p), len(x)), np.float32)  # <r_m, x_m>
    for r in range(rounds + 1):
        total = along.sum(0)
        for m in range(len(p)):
            far = square[m] if square is not None else ((p[m][:, None] - words[m][None]) ** 2).sum(2)
            if r == 0:
                best = far.argmin(1)
                gain = (p[m] * (p[m] - words[m][best])).sum(1)
            else:
                each = (p[m] ** 2).sum(1, keepdims=True) - p[m] @ words[m].T
                rest = (total - along[m])[:, None]
                best = (far + (weight - 1) * (rest + each) ** 2).argmin(1)
                gain = np.take_along_axis(each, best[:, None], 1)[:, 0]
                total = total - along[m] + gain
            codes[m], along[m] = best, gain
    return codes


def train(x: np.ndarray, weight: float, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Words (M, 16, 2) fitted to unit vectors."""
    p = parts_of(x)
    rng = np.random.default_rng(seed)
    pick = rng.choice(len(x), WORDS, replace=len(x) < WORDS)
    words = p[:, pick].copy()
    words += rng.normal(0, 1e-3, words.shape).astype(np.float32)
    for r in range(rounds):
        codes = encode(x, words, weight if r >= 3 else 1.0, 1 if r >= 3 else 0)
        w = (weight if r >= 3 else 1.0) - 1
        chosen = np.take_along_axis(words, codes.astype(np.int64)[:, :, None].repeat(2, 2), 1)
        along = (p * (p - chosen)).sum(2)
        total = along.sum(0)
        for m in range(len(p)):
            rest = total - along[m]
            left = np.zeros((WORDS, 2, 2))
            right = np.zeros((WORDS, 2))
            outer = w * p[m][:, :, None] * p[m][:, None, :] + np.eye(2, dtype=np.float32)
            value = p[m] + w * ((rest + (p[m] ** 2).sum(1))[:, None] * p[m])
            np.add.at(left, codes[m], outer)
            np.add.at(right, codes[m], value)
            full = np.bincount(codes[m], minlength=WORDS) > 0
            words[m][full] = np.linalg.solve(left[full] + 1e-9 * np.eye(2), right[full][:, :, None])[:, :, 0]
    return words


def residuals(x: np.ndarray, codes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Lengths of what the codes (M, N) leave of unit vectors."""
    left = parts_of(x).astype(np.float64) - words[np.arange(len(codes))[:, None], codes]
    return np.sqrt((left**2).sum((0, 2)))


def pack(codes: np.ndarray) -> np.ndarray:
    """Codes (M, N) to bytes (ceil(M / 2), N), two four-bit codes each."""
    if len(codes) % 2:
        codes = np.concatenate([codes, np.zeros((1, codes.shape[1]), np.uint8)])
    return codes[0::2] | codes[1::2] << 4


def tables(q: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For unit queries (Q, D): inner products with the words, summed for each byte of two codes: (Q, ceil(M / 2), 256)."""
    single = np.einsum("mqd,mkd->qmk", parts_of(q), words)
    if single.shape[1] % 2:
        single = np.concatenate([single, np.zeros((len(q), 1, WORDS), single.dtype)], 1)
    return (single[:, 1::2, :, None] + single[:, 0::2, None, :]).reshape(len(q), -1, 256).astype(np.float32)


def best_of(scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` largest, ties at the edge to the earlier places."""
    if len(scores) <= n:
        return np.arange(len(scores))
    edge = np.partition(scores, len(scores) - n)[len(scores) - n]
    above = np.flatnonzero(scores > edge)
    return np.concatenate([above, np.flatnonzero(scores == edge)[: n - len(above)]])


def looked_up(query_ids: np.ndarray, queries: np.ndarray, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, float]]:
    """Each query with its tables and what single precision can lose in a rough score."""
    for at in range(0, len(queries), AT_ONCE):
        some = queries[at : at + AT_ONCE].astype(np.float64)
        look = tables(unit(some), words)
        slack = 1e-6 + 4 * np.finfo(np.float32).eps * look.shape[1] * np.abs(look).max(2).sum(1)
        yield from zip(query_ids[at : at + AT_ONCE].tolist(), some, look, slack.tolist(), strict=True)


def search_cell(query_rows: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, codes: np.ndarray, residual: np.ndarray, words: np.ndarray, k: int, rerank: int) -> list[tuple[int, int, int, float]]:
    """(query's row, id, row, cosine) of each query's ``k`` nearest in a cell. Vectors are ``scaled``."""
    order = np.lexsort((rows, ids))
    ids, rows, vectors, codes, residual = ids[order], rows[order], vectors[order], codes[:, order], residual[order]
    whole = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.shape[1] * vectors.itemsize))).ravel()
    _, first, group = np.unique(whole, return_index=True, return_inverse=True)
    group = group.ravel()
    by_group = np.argsort(group, kind="stable")  # within a group by id
    start = np.searchsorted(group[by_group], np.arange(len(first) + 1))
    exact = vectors[first].astype(np.float64)
    norms = np.linalg.norm(exact, axis=1)
    scan, residual = codes[:, first], residual[first]
    out = []
    for own, q, table, lost in looked_up(query_rows, queries, words):
        rough = table[0][scan[0]]
        for j in range(1, len(scan)):
            rough += table[j][scan[j]]
        near = best_of(rough, max(rerank, k + 1))
        length = math.sqrt(float((q * q).sum()))
        cosine = (exact[near] * q).sum(1) / (norms[near] * length)
        if len(near) < len(rough):
            # One of the first k + 1 distinct vectors may stand for the query alone.
            reach = rough + residual + lost >= np.partition(cosine, len(cosine) - k - 1)[len(cosine) - k - 1]
            reach[near] = False
            more = np.flatnonzero(reach)
            near = np.concatenate([near, more])
            cosine = np.concatenate([cosine, (exact[more] * q).sum(1) / (norms[more] * length)])
        if len(cosine) > k + 1:
            stays = cosine >= np.partition(cosine, len(cosine) - k - 1)[len(cosine) - k - 1]
            near, cosine = near[stays], cosine[stays]
        found: list[tuple[float, int, int]] = []
        for g, c in zip(near.tolist(), cosine.tolist(), strict=True):
            members = by_group[start[g] : min(int(start[g + 1]), int(start[g]) + k + 1)]
            found += [(-c, int(ids[i]), int(rows[i])) for i in members if rows[i] != own]
        out += [(own, i, row, -c) for c, i, row in sorted(found)[:k]]
    return out


def usable(vector: str = "embedding") -> Column:
    x = F.col(vector)
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0)


def build(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE) -> tuple[DataFrame, np.ndarray]:
    """The index, a row (row, vec_id, raw, codes, residual) for every vector that takes part, and the words. ``row`` tells rows apart, whatever their ids."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter(F.col("vec_id").isNotNull() & usable("v"))
    lengths = sorted(rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect())
    rows = rows.filter(F.size("v") == (lengths[0]["size"] if lengths else 0))
    n = lengths[0]["count"] if lengths else 0
    chosen = rows.withColumn("h", F.xxhash64("vec_id")).filter(F.col("h") <= hash_edge(min(1.0, sample / max(1, n)))).limit(2 * sample).withColumn("one", F.lit(1))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        x = unit(scaled(np.stack(part.sort_values("h")["v"].to_numpy())))
        return pd.DataFrame({"words": [pickle.dumps(train(x, eta(x.shape[1])))]})

    made = chosen.groupBy("one").applyInPandas(fit, "words binary").collect()
    words = pickle.loads(bytes(made[0]["words"])) if made else np.zeros((1, WORDS, 2), np.float32)
    schema = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("raw", pa.binary()), ("codes", pa.binary()), ("residual", pa.float64())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        next_row = TaskContext.get().partitionId() << 40
        for part in slices(batches, 4096):
            x = scaled(np.array(part["v"], np.float64))
            rows_ = np.arange(next_row, next_row + len(x))
            next_row += len(x)
            codes = encode(unit(x), words, eta(x.shape[1]))
            left = residuals(unit(x), codes, words)
            yield pa.record_batch([pa.array(rows_), pa.array(part["vec_id"], pa.int64()), pa.array([v.tobytes() for v in x], pa.binary()), pa.array([c.tobytes() for c in pack(codes).T], pa.binary()), pa.array(left, pa.float64())], schema=schema)

    return Scratch(vectors.sparkSession, "vectors").keep(rows.mapInArrow(code, "row long, vec_id long, raw binary, codes binary, residual double"), "index"), words


def search(index: DataFrame, words: np.ndarray, is_query: Column, k: int = 5, rerank: int = RERANK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` nearest other rows of the index. Rows are dealt by themselves, not by their ids."""
    queries = index.filter(is_query)
    cells, blocks = max(1, math.ceil(index.count() / CELL)), max(1, math.ceil(queries.count() / BLOCK))
    right = index.withColumns({"cell": F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(cells)).cast("int"), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    # Both sides come from one table, so the columns of one get names (and ids) of their own.
    named = queries.select(F.col("row").alias("own"), F.col("vec_id").alias("query_id"), F.col("raw").alias("query"))
    left = named.withColumns({"of": F.pmod(F.xxhash64(F.lit(2), "own"), F.lit(blocks)).cast("int"), "at": F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))})

    def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int, float]] = []
        if len(q) and len(c):
            wide = lambda s: np.frombuffer(b"".join(s), np.float64).reshape(len(s), -1)
            codes = np.frombuffer(b"".join(c["codes"]), np.uint8).reshape(len(c), -1).T
            found = search_cell(q["own"].to_numpy(), wide(q["query"]), c["vec_id"].to_numpy(), c["row"].to_numpy(), wide(c["raw"]), np.ascontiguousarray(codes), c["residual"].to_numpy(), words, k, rerank)
        out = pd.DataFrame(found, columns=["own", "vec_id", "row", "score"]).astype({"own": "int64", "vec_id": "int64", "row": "int64", "score": "float64"})
        return out.assign(query_id=out["own"].map(dict(zip(q["own"], q["query_id"], strict=True))).astype("int64"))

    met = left.groupBy("of", "at").cogroup(right.groupBy("block", "cell")).applyInPandas(meet, "own long, vec_id long, row long, score double, query_id long")
    rank = F.row_number().over(Window.partitionBy("own").orderBy(F.desc("score"), "vec_id", "row"))
    return met.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
