"""Language of a text by a bidirectional gated recurrent network over its bytes, in numpy.

A text's bytes are cut into segments of ``SEGMENT``, each a row of a block of rows of falling length; one network reads
each row forwards, one backwards, and together they give every byte a label distribution. A document's distribution
is the mean over all its bytes. Weights are found by backpropagation through time on a bounded sample, fitted in one task:
about ``SAMPLE`` different labelled documents by a hash, the same number for each language that has so many and one at least, and of each text
``DRAWS`` segments of ``TRAIN`` bytes, which lie anywhere in it (by the hash; texts of up to that length go in whole). Every
byte of every text is read for a prediction.

Defined cases: a null text, and one without a letter, is ``und`` with score 0; rows without a lang teach nothing; with no
labelled row at all every document is ``und``; a null doc_id is carried and held out; repeated rows are predicted alike; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessarea.llm.common import slices
from tessarea.session import Scratch

SAMPLE, SEGMENT, HIDDEN, ROWS = 3_000, 256, 8, 1024
TRAIN, DRAWS = 96, 2  # bytes of a training segment, and how many are drawn from a text


@dataclass
class Network:
    """Per direction: input weights (3H, 256), recurrent (3H, H), bias of the candidate's recurrent part (H, 1); then output (C, H) each and bias (C, 1). Gates in order: update, reset, candidate."""

    langs: list[str]
    w: list[np.ndarray]
    u: list[np.ndarray]
    c: list[np.ndarray]
    v: list[np.ndarray]
    b: np.ndarray

    @classmethod
    def new(cls, langs: list[str], hidden: int = HIDDEN, seed: int = 0) -> Network:
        r = np.random.default_rng(seed)
        draw = lambda *shape, by=1.0: (r.standard_normal(shape) * by).astype(np.float32)
        return cls(
            langs,
            [draw(3 * hidden, 256, by=0.3) for _ in range(2)],
            [draw(3 * hidden, hidden, by=hidden**-0.5) for _ in range(2)],
            [np.zeros((hidden, 1), np.float32) for _ in range(2)],
            [draw(len(langs), hidden, by=0.3) for _ in range(2)],
            np.zeros((len(langs), 1), np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [*self.w, *self.u, *self.c, *self.v, self.b]


def step(net: Network, d: int, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One step of direction ``d``: bytes (N,) and state (H, N) to the new state, the gates, the candidate and its recurrent part."""
    k = len(h)
    a = net.w[d][:, x]
    r = net.u[d] @ h
    gates = a[: 2 * k] + r[: 2 * k]
    gates *= 0.5
    np.tanh(gates, out=gates)
    gates *= 0.5
    gates += 0.5
    rec = r[2 * k :] + net.c[d]
    n = a[2 * k :] + gates[k:] * rec
    np.tanh(n, out=n)
    return n + gates[:k] * (h - n), gates, n, rec


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(0))
    return z / z.sum(0)


def predict_block(net: Network, block: np.ndarray, lengths: np.ndarray, every: bool = False) -> np.ndarray:
    """Rows (N, T) of bytes with falling lengths to the sums of label chances (N, C), or with ``every`` to all of them (N, T, C)."""
    n, t = block.shape
    c, k = len(net.langs), net.u[0].shape[1]
    x = np.ascontiguousarray(block.T)
    active = np.searchsorted(-lengths, -np.arange(t), "left")  # rows longer than each place
    first = np.zeros((t, c, n), np.float32)
    h = np.zeros((k, n), np.float32)
    for i in range(t):
        m = active[i]
        h = step(net, 0, x[i, :m], h[:, :m])[0]
        first[i, :, :m] = net.v[0] @ h
    sums, all_ = np.zeros((c, n), np.float64), np.zeros((n, t, c), np.float32) if every else None
    h = np.zeros((k, 0), np.float32)
    for i in range(t - 1, -1, -1):
        m = active[i]
        if h.shape[1] < m:
            h = np.concatenate([h, np.zeros((k, m - h.shape[1]), np.float32)], 1)
        h = step(net, 1, x[i, :m], h)[0]
        p = softmax(first[i, :, :m] + net.v[1] @ h + net.b)
        sums[:, :m] += p
        if every:
            all_[:m, i] = p.T
    return all_ if every else sums.T


def segments(raw: list[bytes], size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """(document, start) and length of every segment, in falling order of length."""
    rows = [(d, at, min(size, len(x) - at)) for d, x in enumerate(raw) for at in range(0, len(x), size)]
    table = np.array(rows, np.int64).reshape(-1, 3)
    table = table[np.argsort(-table[:, 2], kind="stable")]
    return table[:, :2], table[:, 2]


def predict(net: Network, raw: list[bytes], rows: int = ROWS) -> np.ndarray:
    """Mean label chances of each text's bytes."""
    where, lengths = segments(raw)
    total = np.zeros((len(raw), len(net.langs)))
    for at in range(0, len(lengths), rows):
        part, n = where[at : at + rows], lengths[at : at + rows]
        block = np.zeros((len(n), int(n[0])), np.uint8)
        for i, (d, start) in enumerate(part):
            block[i, : n[i]] = np.frombuffer(raw[d], np.uint8, n[i], start)
        np.add.at(total, part[:, 0], predict_block(net, block, n))
    return total / np.maximum([[len(x)] for x in raw], 1).reshape(-1, 1)


def gradients(net: Network, block: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Loss and gradients by backpropagation through time of rows of equal length: cross-entropy at every byte."""
    n, t = block.shape
    k, c = net.u[0].shape[1], len(net.langs)
    x = np.ascontiguousarray(block.T)
    kept: list[list] = [[], []]
    for d, order in ((0, range(t)), (1, range(t - 1, -1, -1))):
        h = np.zeros((k, n), np.float32)
        for i in order:
            new, gates, cand, rec = step(net, d, x[i], h)
            kept[d].append((i, h, gates, cand, rec, new))
            h = new
    states = [np.empty((t, k, n), np.float32) for _ in range(2)]
    for d in range(2):
        for i, *_, new in kept[d]:
            states[d][i] = new
    logits = np.einsum("ck,tkn->tcn", net.v[0], states[0]) + np.einsum("ck,tkn->tcn", net.v[1], states[1]) + net.b
    logits -= logits.max(1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(1, keepdims=True)
    scale = (weight / (weight.sum() * t)).astype(np.float32)
    loss = -float((np.log(p[:, target, np.arange(n)] + 1e-9) * scale).sum())
    p[:, target, np.arange(n)] -= 1
    p *= scale
    dw, du, dc = [np.zeros_like(a) for a in net.w], [np.zeros_like(a) for a in net.u], [np.zeros_like(a) for a in net.c]
    dv = [np.einsum("tcn,tkn->ck", p, states[d]) for d in range(2)]
    for d in range(2):
        dh = np.zeros((k, n), np.float32)
        for i, h, gates, cand, rec, _ in reversed(kept[d]):
            dh = dh + net.v[d].T @ p[i]
            z, r = gates[:k], gates[k:]
            da = np.empty((3 * k, n), np.float32)
            da[2 * k :] = dh * (1 - z) * (1 - cand * cand)
            da[:k] = dh * (h - cand) * z * (1 - z)
            da[k : 2 * k] = da[2 * k :] * rec * r * (1 - r)
            back = da.copy()
            back[2 * k :] *= r
            du[d] += back @ h.T
            dc[d] += back[2 * k :].sum(1, keepdims=True)
            np.add.at(dw[d].T, x[i], da.T)
            dh = dh * z + net.u[d].T @ back
    return loss, [*dw, *du, *dc, *dv, p.sum((0, 2)).reshape(c, 1)]


def drawn(raw: bytes, seed: int, size: int = TRAIN, draws: int = DRAWS) -> list[bytes]:
    """Segments from all over a text: one from each of ``draws`` equal stretches of it, at a place that the seed tells."""
    room = max(0, len(raw) - size)
    places = {(k * room + (seed >> 16 * k) % (room + 1)) // draws for k in range(draws)}
    return [raw[at : at + size] for at in sorted(places)]


def train(raw: list[bytes], lang: list[str], epochs: int = 6, size: int = TRAIN, batch: int = 256, rate: float = 0.02) -> Network:
    """A network fitted to segments; languages weigh the same. The order is fixed, so are the weights."""
    langs = sorted(set(lang))
    net, rng = Network.new(langs), np.random.default_rng(1)
    cuts = [(i, x) for i, x in enumerate(raw) if len(x) >= 1]
    block = np.full((len(cuts), size), 32, np.uint8)
    for row, (_, part) in enumerate(cuts):
        whole = part * (size // len(part) + 1)  # a short text is repeated
        block[row] = np.frombuffer(whole[:size], np.uint8)
    target = np.array([langs.index(lang[i]) for i, _ in cuts], np.int64)
    weight = (1 / np.maximum(np.bincount(target, minlength=len(langs)), 1))[target] if len(cuts) else np.empty(0)
    params = net.parameters()
    mean, square, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    steps = max(1, epochs * -(-len(cuts) // batch))
    for _ in range(epochs if len(langs) > 1 else 0):
        perm = rng.permutation(len(cuts))
        for at in range(0, len(perm), batch):
            part = perm[at : at + batch]
            _, grads = gradients(net, block[part], target[part], weight[part])
            norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
            t += 1
            now = rate * (1 - t / (steps + 1))
            for p, g, m, s in zip(params, grads, mean, square, strict=True):
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                p -= (now * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
    return net


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """Fitted on about ``sample`` labelled documents that are not held out, those with the smallest hashes of each language.

    Of a language with fewer than its share all go in, and of every language one at least, however many there are. Equal documents count
    as one, and of their segments one goes to the fitting task, so what it gets is bounded however often a row is repeated."""
    labelled = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    labelled = labelled.filter(~held_out() & F.col("lang").isNotNull() & (F.length("text") > 0)).withColumn("h", F.xxhash64("doc_id", "text"))
    scratch = Scratch(docs.sparkSession, "languages")
    counts = scratch.keep(labelled.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"), F.min("h").alias("least")), "counts")
    known = max(1, counts.count())
    # The share of a language's hashes; as a double it is compared with the hash as a double, off by a few in 2^53.
    edges = counts.select("lang", "least", F.least(F.lit(1.0), F.lit(sample / known) / F.col("n")).alias("share"))
    # A written table of a row a language: Spark knows its size, and sends it to the texts where it is small.
    chosen = labelled.join(edges, "lang").filter((F.col("h") == F.col("least")) | (F.col("h").cast("double") <= F.col("share") * 2.0**64 - 2.0**63))
    schema = pa.schema([("h", pa.int64()), ("lang", pa.string()), ("segment", pa.binary())])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            made = [(h, lang, x) for h, lang, t in zip(rows["h"], rows["lang"], rows["text"], strict=True) for x in drawn(t.encode("utf-8", "surrogatepass"), h & 2**63 - 1)]
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*made, strict=True) if made else ([], [], []), schema.types, strict=True)], schema=schema)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "segment"])
        net = train(rows["segment"].tolist(), rows["lang"].tolist())
        return pd.DataFrame({"net": [pickle.dumps(net)]})

    segments_drawn = chosen.select("h", "lang", "text").mapInArrow(draw, "h long, lang string, segment binary").dropDuplicates().withColumn("one", F.lit(1))
    made = segments_drawn.groupBy("one").applyInPandas(run, "net binary").collect()
    return pickle.loads(bytes(made[0]["net"])) if made else None


def identify(docs: DataFrame, net: Network | None, rows_held: int = 512) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, from its text alone."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, rows_held):
            texts = [t if t and net and any(map(str.isalpha, t)) else "" for t in rows["text"]]
            raw = [t.encode("utf-8", "surrogatepass") for t in texts]
            chance = predict(net, raw) if net else np.zeros((len(raw), 1))
            best = chance.argmax(1)
            langs = [net.langs[b] if x else "und" for b, x in zip(best, raw, strict=True)]
            scores = [float(min(1.0, p[b])) if x else 0.0 for p, b, x in zip(chance, best, raw, strict=True)]
            columns = (rows["doc_id"], rows["held"], langs, scores)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out().alias("held"))
    return picked.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
