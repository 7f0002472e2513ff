"""Secrets in texts: base patterns, and runs that look random to character Markov models.

Two first-order Markov models, of random strings and of ordinary identifiers, words and numbers, are counted, the second from the words of all documents;
a run of 12 or more letters, digits and ``+/_=-`` is a span of kind ``random`` if its log-likelihood ratio reaches the
threshold of its length. Pairs that ordinary samples lack get a share (``BACK``) of the chance of their classes, so words of other
languages are no surprise by themselves. Thresholds are learned: for each range of lengths what all but ``WRONG`` of the ordinary samples stay below, and
``LEAST`` nats at any rate. No other rule stands before the models. Base spans are cut out of the runs first, and what is left
of a run on either side of them is tried as a run of its own. The counts are one Spark aggregation to at most
(97 * 97) rows a class, the thresholds one to a row for each range of lengths and ratio above ``LEAST``, in 64ths of a nat.

Defined cases: a null text counts as empty and has no spans; a null doc_id is carried; repeated rows are scanned
each; an empty table gives no rows (and a model from numbers alone); other columns of the input are ignored by
``scan`` and carried by ``redact``.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessarea.llm.common import slices

BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(?ai)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")
RUN = re.compile("[A-Za-z0-9+/_=-]{12,}")
SPANS = "array<struct<kind: string, start: int, end: int>>"

SAMPLE_STRINGS, DOCUMENTS_EACH = 20_000, 2_000  # made strings; documents for which made numbers count once
LEAST, WRONG, BACK, PARTS = 12.0, 0.0005, 0.2, 64
BETWEEN, DIGITS = re.compile(r"[ \t\n\x0b\f\r.,;:=\"'()]+"), re.compile("[0-9].*[0-9].*[0-9]")
LENGTHS = (12, 14, 16, 18, 20, 24, 28, 32, 40, 48, 64)  # where ranges of lengths begin


@dataclass
class Model:
    """Log-likelihood ratios of pairs of characters, random over ordinary, and the least ratio of a span by range of lengths."""

    pairs: np.ndarray
    least: np.ndarray

    def random(self, run: str) -> bool:
        return len(run) >= LENGTHS[0] and ratio(self.pairs, run) >= self.least[bisect_right(LENGTHS, len(run)) - 1]


def random_strings(spark: SparkSession, n: int = SAMPLE_STRINGS) -> DataFrame:
    """Samples of the random class: by a hash of the row's number, hexadecimal and base-64 strings of 40 characters, and letters alone of such."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    wide = F.regexp_replace(F.base64(F.unhex(digest)), "=", "")
    text = F.when(F.col("id") % 3 == 0, F.substring(digest, 1, 40)).when(F.col("id") % 3 == 1, F.substring(wide, 1, 40)).otherwise(F.substring(F.regexp_replace(wide, "[^A-Za-z]", ""), 1, 30))
    return spark.range(n).select(text.alias("text"))


def ordinary_words(texts: list[str | None]) -> list[str]:
    """Samples of the ordinary class: words of texts, alone and joined to identifiers, but for long ones with three digits or more."""
    out = []
    for text in texts:
        words = [w for w in BETWEEN.split(text or "") if len(w) >= 3 and not (len(w) >= 12 and DIGITS.search(w))]
        out += words
        # Prose has few identifiers, so its words are also joined to such, four at a time, with a number behind.
        out += ["_-/"[i // 4 % 3].join(words[i : i + 4]).lower() + str((i + 1) % 100) for i in range(0, len(words), 4)]
    return out


def ordinary_numbers(spark: SparkSession, n: int = SAMPLE_STRINGS // 4) -> DataFrame:
    """Samples of the ordinary class: numbers of 12 to 20 digits, counters, dates and times, by a hash of the row's number."""
    digits = F.substring(F.regexp_replace(F.sha2(F.col("id").cast("string"), 512), "[a-f]", ""), 1, 40)
    number = F.substring(digits, F.lit(1), (F.col("id") / 4 % 9 + 12).cast("int"))
    moment = F.date_format(F.timestamp_seconds(F.col("id") * 86_413 * 7), "yyyy-MM-dd/HH-mm")
    counter = F.lpad((F.col("id") * 37).cast("string"), 16, "0")
    text = F.when(F.col("id") % 4 < 2, number).when(F.col("id") % 4 == 2, moment).otherwise(counter)
    return spark.range(n).select(text.alias("text"))


def _tally(texts: DataFrame, samples: Callable[[list], list[str]], keys: Callable[[list[str]], np.ndarray], weight: int = 1) -> DataFrame:
    """(key, n): how often the samples of all texts have each key. A task sends each of its keys once."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for rows in slices(batches, 32):
            found, n = np.unique(keys(samples(rows["text"])), return_counts=True)
            counts.update(dict(zip(found.tolist(), (n * weight).tolist(), strict=True)))
        yield pa.record_batch([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    return texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def codes_of(samples: list[str]) -> np.ndarray:
    """The samples' characters, a 1 before each sample: 2 to 95 are the printable ones of ASCII, 0 is any other."""
    points = np.frombuffer("".join(f"\n{x}" for x in samples).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where((points >= 33) & (points <= 126), points - 31, points == 10)


def pair_keys(samples: list[str]) -> np.ndarray:
    """Each pair of neighbours as a number. Index 0 is any character beyond ASCII, 1 a string's start."""
    codes = codes_of(samples)
    return (codes[:-1] * 97 + codes[1:])[codes[1:] != 1]


def fit(random: DataFrame, ordinary: Callable[[Callable], DataFrame]) -> np.ndarray:
    """Log-likelihood ratio of each pair of characters, random over ordinary."""
    counts = np.full((2, 97 * 97), 0.05)
    for label, rows in ((1, _tally(random, list, pair_keys)), (0, ordinary(pair_keys))):
        for r in rows.collect():
            counts[label, r["key"]] += r["n"]
    counts = counts.reshape(2, 97, 97)
    chance = counts / counts.sum(2, keepdims=True)
    return np.log(chance[1]) - np.log((1 - BACK) * chance[0] + BACK * _by_class(counts[0]))


def _by_class(counts: np.ndarray) -> np.ndarray:
    """The chance of a character by the class of the one before: lower case, upper case and digits are classes, other characters one each."""
    kind = np.arange(97)
    for first, last, of in (("a", "z", 97), ("A", "Z", 98), ("0", "9", 99)):
        kind[ord(first) - 31 : ord(last) - 30] = of
    _, kind = np.unique(kind, return_inverse=True)
    member = np.eye(kind.max() + 1)[kind]
    between = member.T @ counts @ member
    between /= between.sum(1, keepdims=True)
    return (between / member.sum(0))[np.ix_(kind, kind)]


def thresholds(ordinary: Callable[[Callable], DataFrame], pairs: np.ndarray) -> np.ndarray:
    """By range of lengths the ratio, to 1 / PARTS of a nat, that all but WRONG of the ordinary samples (runs of the characters that are scanned) stay below; where there are few, that of the range before."""

    def keys(samples: list[str]) -> np.ndarray:
        known = [x for x in samples if RUN.fullmatch(x)]
        if not known:
            return np.empty(0, np.int64)
        codes = codes_of(known)
        starts = np.flatnonzero(codes == 1)
        # What is no sample's pair counts nothing; all ratios below LEAST are one.
        scores = np.add.reduceat(np.where(codes == 1, 0, pairs[np.append(1, codes[:-1]), codes]), starts)
        place = np.searchsorted(LENGTHS, np.diff(np.append(starts, len(codes))) - 1, "right") - 1
        return place << 32 | np.floor(np.maximum(scores, LEAST) * PARTS).astype(np.int64)

    rows = sorted((r["key"] >> 32, r["key"] & 0xFFFFFFFF, r["n"]) for r in ordinary(keys).collect())
    out = np.full(len(LENGTHS), LEAST)
    for place in range(len(LENGTHS)):
        edges, n = (np.array([r[k] for r in rows if r[0] == place], np.int64) for k in (1, 2))
        if n.sum() >= 1 / WRONG:
            out[place] = max(LEAST, edges[np.searchsorted(np.cumsum(n), (1 - WRONG) * n.sum())] / PARTS)
    return np.maximum.accumulate(out)


def fit_on_documents(docs: DataFrame) -> Model:
    """The model as the query uses it: from the words of all documents, beside made strings and numbers. Numbers keep their share, however many documents there are."""
    spark = docs.sparkSession
    texts, weight = docs.select(F.col("text").cast("string").alias("text")), max(1, docs.count() // DOCUMENTS_EACH)

    def ordinary(keys: Callable[[list[str]], np.ndarray]) -> DataFrame:
        both = _tally(texts, ordinary_words, keys).unionByName(_tally(ordinary_numbers(spark), list, keys, weight))
        return both.groupBy("key").agg(F.sum("n").alias("n"))

    pairs = fit(random_strings(spark), ordinary)
    return Model(pairs, thresholds(ordinary, pairs))


def ratio(pairs: np.ndarray, run: str) -> float:
    codes = np.frombuffer(run.encode("ascii"), np.uint8).astype(np.int64) - 31
    return float(pairs[np.concatenate([[1], codes[:-1]]), codes].sum())


def outside(start: int, end: int, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The parts of start to end where no span lies; spans in order of start."""
    parts = []
    for _, a, b in spans:
        if a < end and start < b:
            parts.append((start, a))
            start = b
    return [(a, b) for a, b in [*parts, (start, end)] if a < b]


def spans_of(text: str, model: Model | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in order of start, then of kind as listed, ``random`` last."""
    found, lower = [], text.lower()
    if any(k in lower for k in KEYS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    runs = [(m.start(), m[0]) for m in RUN.finditer(text)]
    for at, run in runs:
        if "AKIA" in run:
            found += [("access", at + m.start(), at + m.end()) for m in ACCESS.finditer(run) if len(m[0]) >= 16]
        if len(run) >= 32:
            found += [("hex", at + m.start(), at + m.end()) for m in HEX.finditer(run) if len(m[0]) >= 32]
    if model is not None:
        base = sorted(found, key=lambda x: x[1])
        for at, run in runs:
            found += [("random", start, end) for start, end in outside(at, at + len(run), base) if model.random(text[start:end])]
    order = (*BASE_KINDS, "random")
    return sorted(found, key=lambda x: (x[1], order.index(x[0])))


def scan(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and spans (array of kind, start, end in code points, the end exclusive) of every whole text."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema([("doc_id", pa.int64()), ("spans", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t or "", model)] for t in rows["text"]]
            yield pa.record_batch([pa.array(rows["doc_id"], pa.int64()), pa.array(spans, kind)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, f"doc_id long, spans {SPANS}")


def redact(docs: DataFrame, model: Model | None, mask: str = "[secret]") -> DataFrame:
    """The documents with each secret replaced by ``mask``; spans that overlap are replaced as one. ``n_chars``, where there is one, is brought up to date."""

    def masked(text: str) -> str:
        out, at = [], 0
        for _, start, end in spans_of(text, model):
            if start >= at:
                out += [text[at:start], mask]
            at = max(at, end)
        return "".join([*out, text[at:]])

    where, schema = docs.columns.index("text"), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [None if t is None else masked(t) for t in part.column(where).to_pylist()]
                part = part.set_column(where, part.schema.field(where), pa.array(texts, part.schema.field(where).type))
                yield part

    out = docs.mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
