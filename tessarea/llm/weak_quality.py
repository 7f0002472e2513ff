"""Weak labels for quality, and a hashed linear scorer trained on them.

Heuristic labellers each vote good (2), bad (1) or abstain (0) on a whole text. The votes of all documents are
counted by pattern in Spark (at most 3^L rows, whatever the input); expectation-maximisation over the patterns
estimates each labeller's vote probabilities for good and for bad documents, and so the posterior of any
pattern. Posteriors are the soft labels of a logistic scorer over hashed features: runs of three bytes by share of
the text, and binned statistics. The scorer is fitted on a bounded sample, ``SAMPLE`` documents by a hash, in one task;
every document is scored.

Defined cases: a null text counts as empty; an empty text has no features but the bins and is rejected; a null doc_id is
carried; repeated rows are scored alike; an empty table gives no rows; ``accept`` keeps the input's columns
whatever their names.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessarea.llm.common import hash_edge, slices

SAMPLE, BUCKETS, BINS = 6_000, 1 << 16, 4096
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#$%&*|<>")] = True

RUN, STOPS = re.compile(r"([^\w\s])\1\1"), re.compile(r"[.,;:!?\"'()]+(?=\s|$)")

# Per labeller: statistic, good where it lies in the first range, bad where it lies in the second, else abstain.
LABELLERS = (
    ("symbols", (0.0, 0.005), (0.04, 9.0)),
    ("bars", (0.0, 0.01), (0.15, 9.0)),
    ("capitals", (0.0, 0.15), (0.4, 9.0)),
    ("runs", (0.0, 0.01), (0.1, 9.0)),
    ("plain", (0.9, 9.0), (0.0, 0.7)),
    ("marks", (0.0, 0.02), (0.08, 9.0)),
    ("distinct", (0.4, 9.0), (0.0, 0.15)),
    ("top", (0.0, 0.15), (0.4, 9.0)),
    ("same_next", (0.0, 0.03), (0.25, 9.0)),
    ("word_length", (3.0, 9.0), (14.0, 1e9)),
    ("same_lines", (0.0, 0.05), (0.3, 9.0)),
)
NAMES = tuple(x[0] for x in LABELLERS)


def statistics(text: str) -> list[float]:
    """The labellers' statistics of a whole text; those that need words are of few of them neutral."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    count = np.bincount(raw, minlength=256)
    words = text.split()
    n, filled = max(1, len(words)), max(1, len(raw) - int(count[9:14].sum() + count[32]))
    capitals, small = int(count[65:91].sum()), int(count[97:123].sum())
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    few = len(words) < 20
    return [
        float(count[SYMBOLS].sum()) / filled,
        float(count[124]) / n,
        capitals / max(1, capitals + small) if capitals + small >= 20 else 0.2,
        len(RUN.findall(text)) / n,
        0.8 if few else sum(map(str.isalpha, STOPS.sub("", text).split())) / n,
        float(count[33] + count[63]) / filled,
        0.3 if few else len(set(words)) / min(n, 200 + n // 4),
        0.2 if few else Counter(words).most_common(1)[0][1] / n,
        0.1 if few else sum(map(str.__eq__, words, words[1:])) / n,
        filled / n,
        0.1 if len(lines) < 5 else 1 - len(set(lines)) / len(lines),
    ]


def vote(values: list[float]) -> list[int]:
    return [2 if g[0] <= v <= g[1] else 1 if b[0] <= v <= b[1] else 0 for v, (_, g, b) in zip(values, LABELLERS, strict=True)]


def pattern(values: list[float]) -> int:
    return int(sum(v * 3**j for j, v in enumerate(vote(values))))


def label(docs: DataFrame) -> DataFrame:
    """doc_id and the pattern of votes (base 3, the first labeller lowest)."""
    schema = pa.schema([("doc_id", pa.int64()), ("pattern", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            made = [pattern(statistics(t or "")) for t in rows["text"]]
            yield pa.record_batch([pa.array(rows["doc_id"], pa.int64()), pa.array(made, pa.int64())], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, pattern long")


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """From distinct patterns and their counts: the log ratios (labeller, vote) of good over bad, prior last, and each labeller's accuracy.

    Each labeller looks for a fault of its own, so the first guess is that a text with a bad vote is probably bad."""
    votes = (patterns[:, None] // 3 ** np.arange(len(LABELLERS))) % 3
    good = np.where((votes == 1).any(1), 0.2 ** (votes == 1).sum(1), 0.95)
    seen = np.stack([votes == v for v in range(3)], 2).astype(float)  # pattern, labeller, vote
    ratios = np.zeros((len(LABELLERS) + 1, 3))
    for _ in range(rounds):
        if not len(patterns):
            break
        of_good = np.einsum("p,pjv->jv", counts * good, seen) + 1.0
        of_bad = np.einsum("p,pjv->jv", counts * (1 - good), seen) + 1.0
        of_good[:, 0] = of_bad[:, 0] = 1e-9  # an abstention is no evidence
        ratios[:-1, 1:] = np.log(of_good / of_good.sum(1, keepdims=True))[:, 1:] - np.log(of_bad / of_bad.sum(1, keepdims=True))[:, 1:]
        ratios[-1] = np.log(((counts * good).sum() + 1) / ((counts * (1 - good)).sum() + 1))
        new = posterior(ratios, votes)
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    right = np.einsum("p,pj->j", counts * good, seen[:, :, 2]) + np.einsum("p,pj->j", counts * (1 - good), seen[:, :, 1])
    given = np.einsum("p,pj->j", counts.astype(float), seen[:, :, 1] + seen[:, :, 2])
    return ratios, right / np.maximum(given, 1)


def posterior(ratios: np.ndarray, votes: np.ndarray) -> np.ndarray:
    """An abstention says nothing: where a text is too short for a labeller, that is no sign of either kind."""
    logit = ratios[-1, 0] + sum(np.where(votes[:, j] > 0, ratios[j, votes[:, j]], 0.0) for j in range(len(LABELLERS)))
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def features(text: str, values: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features: runs of three bytes, weighted by three times the root of their bucket's share, and the statistics' bins."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    n = np.bincount((raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]) * np.uint32(2654435769) >> np.uint32(16), minlength=BUCKETS) if len(raw) > 2 else np.zeros(BUCKETS, np.int64)
    pairs = np.flatnonzero(n)
    n = n[pairs]
    bins = BUCKETS + np.array([(j * 521 + int(np.digitize(v, EDGES[j]))) % BINS for j, v in enumerate(values)], np.int64)
    return np.concatenate([pairs, bins]), np.concatenate([3 * np.sqrt(n / max(1, n.sum())), np.ones(len(bins))]).astype(np.float32)


EDGES = [np.unique(np.concatenate([np.linspace(0, min(2.0, b[0] * 2 or 1), 9), np.array(b[:1])])) if name != "word_length" else np.array([2, 3, 4, 6, 8, 10, 14, 20, 40]) for name, _, b in LABELLERS]


@dataclass
class Model:
    ratios: np.ndarray
    accuracy: dict[str, float]
    weights: np.ndarray  # BUCKETS + BINS, the intercept last

    def score(self, text: str) -> tuple[float, float]:
        """Posterior of the votes, and the scorer's probability that the text is good."""
        values = statistics(text)
        p = float(posterior(self.ratios, np.array([vote(values)]))[0])
        at, x = features(text, values)
        return p, float(1 / (1 + np.exp(-np.clip((self.weights[at] * x).sum() + self.weights[-1], -30, 30))))


def fit_scorer(made: list[tuple[np.ndarray, np.ndarray]], soft: np.ndarray, epochs: int = 8, batch: int = 128, rate: float = 0.3, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression of soft labels on features by adaptive gradient steps; the order is fixed, so are the weights."""
    w, seen = np.zeros(BUCKETS + BINS + 1), np.full(BUCKETS + BINS + 1, 1e-3)
    order = np.random.default_rng(0)
    for _ in range(epochs if made else 0):
        perm = order.permutation(len(made))
        for at in range(0, len(perm), batch):
            part = perm[at : at + batch]
            idx = np.concatenate([made[i][0] for i in part])
            x = np.concatenate([made[i][1] for i in part])
            row = np.repeat(np.arange(len(part)), [len(made[i][0]) for i in part])
            z = np.bincount(row, w[idx] * x, len(part)) + w[-1]
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - soft[part]) / len(part)
            slope = np.bincount(idx, g[row] * x, len(w)) + decay * w
            slope[-1] = g.sum()
            seen += slope * slope
            w -= rate * slope / np.sqrt(seen)
    return w


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Votes of all documents, the labellers' accuracies, and the scorer on about ``sample`` documents with the smallest hashes, twice as many at most."""
    counted = label(docs).groupBy("pattern").count().toPandas()
    ratios, accuracy = expectation_maximisation(counted["pattern"].to_numpy(np.int64), counted["count"].to_numpy(np.float64))
    share = min(1.0, sample / max(1, int(counted["count"].sum())))
    chosen = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("h")).filter(F.col("h") <= hash_edge(share))
    schema = pa.schema([("h", pa.int64()), ("soft", pa.float64()), ("at", pa.binary()), ("x", pa.binary())])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            values = [statistics(t) for t in rows["text"]]
            soft = posterior(ratios, np.array([vote(v) for v in values]).reshape(-1, len(LABELLERS)))
            made = [features(t, v) for t, v in zip(rows["text"], values, strict=True)]
            packed = [[at.astype(np.int32).tobytes() for at, _ in made], [x.tobytes() for _, x in made]]
            yield pa.record_batch([pa.array(rows["h"], pa.int64()), pa.array(soft, pa.float64()), *[pa.array(c, pa.binary()) for c in packed]], schema=schema)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "at"])
        made = [(np.frombuffer(at, np.int32), np.frombuffer(x, np.float32)) for at, x in zip(rows["at"], rows["x"], strict=True)]
        return pd.DataFrame({"weights": [pickle.dumps(fit_scorer(made, rows["soft"].to_numpy()).astype(np.float32))]})

    # Features, of which a text has BUCKETS at most, go to the fitting task, and of copies of a text only those with different ids.
    reduced = chosen.dropDuplicates(["h"]).mapInArrow(reduce, "h long, soft double, at binary, x binary").limit(2 * sample).withColumn("one", F.lit(1))
    made = reduced.groupBy("one").applyInPandas(run, "weights binary").collect()
    weights = pickle.loads(bytes(made[0]["weights"])) if made else np.zeros(BUCKETS + BINS + 1, np.float32)
    return Model(ratios, dict(zip(NAMES, accuracy.tolist(), strict=True)), weights)


def score(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """doc_id, p_good (posterior of the votes), score (of the linear scorer) and kept, for every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("p_good", pa.float64()), ("score", pa.float64()), ("kept", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            made = [model.score(t or "") for t in rows["text"]]
            kept = [bool(t) and s >= least for t, (_, s) in zip(rows["text"], made, strict=True)]
            yield pa.record_batch([pa.array(rows["doc_id"], pa.int64()), pa.array([p for p, _ in made], pa.float64()), pa.array([s for _, s in made], pa.float64()), pa.array(kept, pa.bool_())], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, p_good double, score double, kept boolean")


def accept(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents that the scorer keeps, with all their columns."""
    where = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                yield part.filter(pa.array([bool(t) and model.score(t)[1] >= least for t in part.column(where).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
