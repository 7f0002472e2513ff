"""SimHash near-duplicates by an inverted index over byte positions, with count filtering.

1. A fingerprint bit is 1 if over half of a text's 3-word shingles, repeats included, have it in their XXH64. Equal
   fingerprints form a class; later steps see each fingerprint once.
2. Fingerprints that differ in at most 3 of 64 bits share at least 5 of their 8 positional bytes. A posting list of the
   index holds the fingerprints that have given bytes at the four positions of a block. The 14 blocks are the sets of four of
   the positions 0 to 7 whose numbers have no bit in odd number (the Steiner system S(3,4,8)): any three positions lie in
   exactly one block, and what a block leaves is a block, so two fingerprints that differ in at most three bytes meet in a list.
   With four bytes a list is about a 2^32nd of random fingerprints, where one byte would leave a 256th.
3. In a list the shared positional bytes of each pair are tallied, pairs that reach five are retained, and their bits compared.
   A list is read as one run of a sorted stream; it gives the stars of what its links join, not all links, so its output is
   no longer than the list.
4. A list of more than ``most`` fingerprints (a large family of near copies) is not compared as it is: by the same count
   filter its members go to the lists of five positions instead, where the three bytes left can hold 2^24 fingerprints at
   most. A list with more than ``most`` even there is joined by neighbours: each fingerprint looks up in a table of the list
   what differs from it in up to three bits, 2,324 places, so the work grows with the list and not with its square.
5. Stars give components (alternating stars); a class gets the smallest doc_id of its component, and its documents get it by one join.

Defined cases: a null text, or one without words, has fingerprint zero and links like any other; with fewer than three words the whole
sequence is one shingle; a document without doc_id links others, but isn't a component's id unless all of it lack one; repeated rows are
documents of their own; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessarea.llm.common import release, slices
from tessarea.llm.graph import components
from tessarea.session import Scratch

MOST, SHINGLES, PIECE = 4_096, 1 << 15, 1 << 20  # fingerprints of a list compared pair by pair; shingles hashed and bytes of a text cut at once
BLOCKS = [set_ for set_ in combinations(range(8), 4) if not set_[0] ^ set_[1] ^ set_[2] ^ set_[3]]
FIVES = list(combinations(range(8), 5))
LOWEST = np.uint64(0x0101010101010101)  # the lowest bit of each byte
SPACE = re.compile(rb"[ \t-\r]")


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lower case (A-Z only), by pieces that end between words."""
    at = 0
    while at < len(text):
        space = SPACE.search(text, at + PIECE)
        end = space.start() if space else len(text)
        yield text[at:end].lower().split()
        at = end


def fingerprint(text: bytes, size: int = 3) -> int:
    """The 64 majority bits of a text's shingles, strictly over half; 0 without words."""
    ones, n, tail = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest

    def add(words: list[bytes]) -> None:
        nonlocal n
        line, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - size + 1].tolist()
        ends = ends[size - 1 :].tolist()
        for i in range(0, len(starts), SHINGLES):
            h = np.fromiter((digest(line[a:b], 42) for a, b in zip(starts[i : i + SHINGLES], ends[i : i + SHINGLES], strict=True)), np.uint64)
            ones[:] += _ones(h)
            n += len(h)

    for words in words_of(text):
        tail += words
        if len(tail) >= size:
            add(tail)
            tail = tail[len(tail) - size + 1 :]
    if not n and tail:
        ones[:], n = _ones(np.array([digest(b" ".join(tail), 42)], np.uint64)), 1
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def _ones(h: np.ndarray) -> np.ndarray:
    """How often each bit is set, the lowest first. Bytes are counted by value, which has few more steps than there are bytes."""
    out = np.empty(64, np.int64)
    for i, column in enumerate(h.astype("<u8").view(np.uint8).reshape(-1, 8).T):
        out[8 * i : 8 * i + 8] = np.bincount(column, minlength=256) @ BITS
    return out


BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id and fp (signed 64 bits) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for rows in slices(batches, 64):
            fps = np.array([fingerprint(x, size) for x in rows["text"]], np.uint64).view(np.int64)
            yield pa.record_batch([pa.array(rows["doc_id"], pa.int64()), pa.array(fps)], schema=schema)

    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).mapInArrow(run, "doc_id long, fp long")


def postings(fps: DataFrame, sets: list[tuple[int, ...]]) -> DataFrame:
    """positions (as bits), bytes and fp: each fingerprint once for every set of positions."""
    masks = [sum(0xFF << 8 * i for i in s) for s in sets]
    lists = [F.struct(F.lit(sum(1 << i for i in s)).alias("positions"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("bytes")) for s, m in zip(sets, masks, strict=True)]
    return fps.select("fp", F.explode(F.array(*lists)).alias("x")).select("x.positions", "x.bytes", "fp")


def stars(fps: np.ndarray, bits: int, most: int = MOST) -> Iterator[tuple[int, int]]:
    """(fingerprint, smallest that it is joined to in this list) of those that links join to a smaller one. Memory grows with the list, however many its links are."""
    fps = np.unique(fps)
    root = _by_pairs(fps, bits) if len(fps) <= most else _by_neighbours(fps, bits)
    for i in np.flatnonzero(root != np.arange(len(fps))).tolist():
        yield int(fps[i]), int(fps[root[i]])


def _by_pairs(fps: np.ndarray, bits: int) -> np.ndarray:
    """The smallest place that links join to each; what a place links with is joined at once, and no links are kept."""
    root = np.arange(len(fps))
    for i in range(len(fps) - 1):
        x = fps[i + 1 :] ^ fps[i]
        y = x | x >> np.uint64(4)
        y |= y >> np.uint64(2)
        y |= y >> np.uint64(1)
        shared = 8 - np.bitwise_count(y & LOWEST)  # the tally: bytes in which the two are alike
        near = np.flatnonzero(shared >= 8 - bits)
        near = near[np.bitwise_count(x[near]) <= bits]
        if len(near):
            joined_ = np.unique(np.append(root[i + 1 + near], root[i])).tolist()
            for other in joined_[1:]:
                root[root == other] = joined_[0]
    return root


def _by_neighbours(fps: np.ndarray, bits: int) -> np.ndarray:
    """The same for a long list: each place looks up what differs from it in few bits, and takes the smallest root, until none changes."""
    free = int(np.bitwise_or.reduce(fps ^ fps[0]))
    places = [1 << i for i in range(64) if free >> i & 1]
    flips = [np.uint64(sum(c)) for k in range(1, bits + 1) for c in combinations(places, k)]
    root = np.arange(len(fps))
    while True:
        low = root.copy()
        for flip in flips:
            other = fps ^ flip
            at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
            hit = np.flatnonzero((fps[at] == other) & (fps < other))
            np.minimum.at(low, hit, low[at[hit]])
            np.minimum.at(low, at[hit], low[hit])
        while (low != low[low]).any():
            low = low[low]
        if (low == root).all():
            return root
        root = low


def joined(lists: DataFrame, bits: int, most: int) -> DataFrame:
    """a, b: stars of the links of each list. A partition is a sorted stream of which one list is held."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        key, held = None, []

        def give(found: list[tuple[int, int]]) -> pa.RecordBatch:
            both = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.record_batch([pa.array(both[:, 0]), pa.array(both[:, 1])], schema=schema)

        for batch in batches:
            positions, values, fps = (np.asarray(batch.column(c)) for c in ("positions", "bytes", "fp"))
            cuts = np.flatnonzero((np.diff(positions) != 0) | (np.diff(values) != 0)) + 1
            found: list[tuple[int, int]] = []
            edges = [0, *cuts.tolist(), len(fps)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if hi == lo:
                    continue
                here = (int(positions[lo]), int(values[lo]))
                if here != key:
                    if sum(map(len, held)) > 1:
                        found += stars(np.concatenate(held), bits, most)
                    key, held = here, []
                held.append(fps[lo:hi].view(np.uint64))
            if found:
                yield give(found)
        if sum(map(len, held)) > 1:
            yield give(list(stars(np.concatenate(held), bits, most)))

    return lists.repartition("positions", "bytes").sortWithinPartitions("positions", "bytes").mapInArrow(run, "a long, b long")


def near_fingerprints(docs: DataFrame, size: int = 3, bits: int = 3, most: int = MOST) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id and class_size (documents with an equal fingerprint) of every row.

    ``most`` parts lists compared pair by pair from longer ones; it changes the work, not the result."""
    if bits > 3:
        raise ValueError("blocks of four positions find pairs that differ in up to three bits")
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    members = scratch.keep(fingerprints(docs, size), "members")
    classes = scratch.keep(members.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("class_size")), "classes")
    lists = postings(classes.select("fp"), BLOCKS)
    lengths = scratch.keep(lists.groupBy("positions", "bytes").count().filter("count > 1"), "lengths")
    light = lengths.filter(F.col("count") <= most).drop("count")
    links = joined(lists.join(light, ["positions", "bytes"], "left_semi"), bits, most)
    heavy = lengths.filter(F.col("count") > most).drop("count")
    if not heavy.isEmpty():
        crowded = lists.join(heavy, ["positions", "bytes"], "left_semi").select("fp").distinct()
        links = links.unionByName(joined(postings(crowded, FIVES), bits, most))
    links = scratch.keep(links.distinct(), "links")
    roots = components(links, scratch)
    placed = scratch.keep(classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", "class_size", F.coalesce("root", "fp").alias("root")), "placed")
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(ids, "root").select("fp", "class_size", "component_id")
    return members.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "class_size")
