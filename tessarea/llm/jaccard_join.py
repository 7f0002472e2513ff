"""N-gram Jaccard self-join by prefixes and a trie.

1. Every text becomes its set of distinct word shingles, each a 64-bit hash of which 48 bits are kept. Copies (equal
   sets) form classes, and only one set of a class goes on. Sets lie in chunks, a table bucketed by chunk; what later
   steps learn of a chunk comes to it, and the sets are never shuffled as a whole.
2. Global order of shingles: by the number of sets that have them, rarest first, then by hash. Counts are made in ranges
   of hashes, each chunk sending each shingle once, and go back to the chunks as a byte a shingle; nothing of it is
   collected or broadcast.
3. Two sets with similarity t or more share a shingle of their first n - ceil(t n) + 1 in that order. Shingles in one set
   alone lead to nothing. Lists of sets by a light shingle (fewer than ``heavy`` sets have it) give pairs directly, less
   those that sizes and places rule out. Lists by a heavy shingle arise for sets that consist of shared shingles almost
   wholly, that is for large families of near copies. There each set is paired with three hubs of its list; once what
   the links join is known, only sets outside their list's main component are paired with the members of other
   components, nearest first in rounds, and each pair in the first list that it has in common. So no link between
   components is missed, and no pairs within a component as known by the round are listed.
4. Pairs pass a bound first: each set has a parity bitmap (bit i is the number of its hashes that are i modulo the width,
   modulo 2); two bitmaps differ in at most as many bits as their sets have shingles in but one of them.
5. What is left is joined exactly. The candidates of a set form a trie in the global order, most frequent first, each
   edge a run of shingles. The set traverses it once, so runs that candidates share are intersected once, and a subtree is left
   when what the path has in common, and the shorter of both remainders, can't reach the overlap that the
   smallest set below needs.
6. Links give components (alternating stars).

Chance: two shingles of a pair of sets with x and y of them are taken for one with x y 2^-48, and classes are told apart by
64 bits of a digest of the full hashes.

Defined cases: a text without words, or null, has an empty set and links with nothing; one with fewer words than a shingle is
one shingle; a document without doc_id links others like any document, but can't be a component's id unless all of it lack one;
repeated rows are copies; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessarea.llm.common import release, slices
from tessarea.llm.graph import components
from tessarea.session import Scratch

HEAVY, BITS, CHUNK, GROUP = 64, 48, 400_000, 500_000  # sets; bits; shingles a chunk; shingles a group of a shuffle
BLOCK, FIRSTS = 512, 64  # sets of a heavy list that a task compares with as many; heavy shingles by which a pair's lists are told apart
NEAREST = (0, 4, 64, 1 << 60)  # of a set's candidates in a block, nearest first, those of each round
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, size: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles. A-Z count as lower case; words lie between ASCII spaces."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        out = (out ^ h[i : i + len(out)]) * MIX
        out ^= out >> np.uint64(29)
    out *= MIX
    return np.unique(out ^ out >> np.uint64(32))


def ceil_div(a, b):
    return -(-a // b)


def planes(x: np.ndarray, width: int = BITS // 8) -> bytes:
    """Numbers byte by byte in planes: high planes are nearly all zero, which compresses."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplane(data: bytes, width: int = BITS // 8) -> np.ndarray:
    n = len(data) // width
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def steps(x: np.ndarray) -> bytes:
    """Ascending numbers, as planes of their differences."""
    return planes(np.diff(x, prepend=np.uint64(0)))


def unstep(data: bytes) -> np.ndarray:
    return np.cumsum(unplane(data), dtype=np.uint64)


def batch(schema: pa.Schema, *columns: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def code_of(counts: np.ndarray) -> np.ndarray:
    """Counts as a byte: themselves up to 200, then by power of two."""
    return np.where(counts <= 200, counts, np.minimum(201 + np.log2(np.maximum(counts, 200) / 200), 255)).astype(np.uint8)


def range_edges(parts: int) -> np.ndarray:
    return (np.arange(1, parts, dtype=object) * (1 << BITS) // parts).astype(np.uint64)


class Chunk:
    """Distinct sets in one row: hashes in ascending order, and of each the number of its set."""

    SCHEMA = "chunk long, sid long, n long, doc_id long, key long, sids binary, sizes binary, hashes binary, owners binary"
    ARROW = pa.schema([(c.split()[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in SCHEMA.split(", ")])

    def __init__(self, sids: bytes, sizes: bytes, hashes: bytes, owners: bytes):
        self.sids, self.sizes = np.frombuffer(sids, np.int64), np.frombuffer(sizes, np.int32)
        self.hashes, self.owner = unstep(hashes), unplane(owners, 2).astype(np.int64)

    @staticmethod
    def row(chunk: int, sids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        h = np.concatenate(sets)
        at = np.argsort(h, kind="stable")
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[at]
        packed = (np.array(sids, np.int64).tobytes(), np.array([len(s) for s in sets], np.int32).tobytes(), steps(h[at]), planes(owner, 2))
        return batch(Chunk.ARROW, [chunk], [None], [None], [None], [None], *[[x] for x in packed])

    def only(self, sids: np.ndarray) -> None:
        """Forgets the other sets."""
        stays = np.isin(self.sids, sids)
        place = np.cumsum(stays) - 1
        kept = stays[self.owner]
        self.hashes, self.owner = self.hashes[kept], place[self.owner[kept]]
        self.sids, self.sizes = self.sids[stays], self.sizes[stays]

    def distinct(self) -> np.ndarray:
        """Where each distinct hash is first."""
        return np.flatnonzero(np.diff(self.hashes, prepend=~self.hashes[:1]))

    def ordered(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(sid, hashes, codes) of each set in the global order, from the codes of the distinct hashes."""
        code = np.repeat(codes, np.diff(np.append(self.distinct(), len(self.hashes))))
        at = np.argsort(self.owner << 8 | code, kind="stable")
        ends = np.cumsum(np.bincount(self.owner, minlength=len(self.sids))).tolist()
        hashes, code, start = self.hashes[at], code[at], 0
        for sid, end in zip(self.sids.tolist(), ends, strict=True):
            yield sid, hashes[start:end], code[start:end]
            start = end


def _chunks(docs: DataFrame, size: int) -> DataFrame:
    """A row (chunk, sid, n, doc_id, key) for every document, sid null if its set is empty, and a row with the sets for every chunk.

    A chunk holds each set once; documents name the chunk that has theirs. ``key`` stands for doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        release()
        chunk = TaskContext.get().partitionId() << 32
        sids: dict[int, None] = {}
        sets: list[np.ndarray] = []
        total = 0
        for rows in slices(batches):
            out: list[list] = [[] for _ in range(5)]
            for doc_id, key, text in zip(rows["doc_id"], rows["key"], rows["text"], strict=True):
                h, sid = shingles(text or "", size), None
                if len(h):
                    if total >= CHUNK or len(sets) == 1 << 16:
                        yield Chunk.row(chunk, list(sids), sets)
                        chunk, sids, sets, total = chunk + 1, {}, [], 0
                    sid = int(np.frombuffer(xxhash.xxh3_64_digest(h.tobytes()), "<i8")[0])
                    if sid not in sids:
                        sids[sid] = None
                        sets.append(h >> np.uint64(64 - BITS))
                        total += len(h)
                for column, value in zip(out, (chunk, sid, len(h), doc_id, key), strict=True):
                    column.append(value)
            yield batch(Chunk.ARROW, *out, *[[None] * len(out[0])] * 4)
        if sets:
            yield Chunk.row(chunk, list(sids), sets)

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("key"), text.alias("text")).mapInArrow(run, Chunk.SCHEMA)


def _at_chunks(chunks: DataFrame, told: DataFrame, run: Callable[[Chunk, dict], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``run`` on every chunk for which ``told`` has a row. Only ``told`` is shuffled: the chunks are bucketed."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for part in batches:
            for i in range(part.num_rows):
                row = part.slice(i, 1).to_pylist()[0]
                chunk = Chunk(*[row.pop(c) for c in ("sids", "sizes", "hashes", "owners")])
                chunk.only(np.array(row["owned"], np.int64))
                yield from run(chunk, row)

    return chunks.join(told.hint("shuffle_hash"), "chunk").mapInArrow(each, schema)


def _codes(chunks: DataFrame, owned: DataFrame, parts: int) -> DataFrame:
    """(chunk, owned, codes): of every chunk the sets it answers for, and the codes of their distinct shingles, in order."""
    edges = range_edges(parts)
    schema = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("data", pa.binary()), ("times", pa.binary())])

    def send(chunk: Chunk, row: dict) -> Iterator[pa.RecordBatch]:
        at = chunk.distinct()
        h, times = chunk.hashes[at], np.diff(np.append(at, len(chunk.hashes)))
        cuts = np.searchsorted(h, edges)
        runs = [(p, steps(x), planes(k, 3)) for p, (x, k) in enumerate(zip(np.split(h, cuts), np.split(times, cuts), strict=True)) if len(x)]
        yield batch(schema, [row["chunk"]] * len(runs), *[list(c) for c in zip(*runs, strict=True)])

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        runs = [unstep(x) for x in rows["data"]]
        h, inverse = np.unique(np.concatenate(runs), return_inverse=True)
        counts = np.bincount(inverse, np.concatenate([unplane(x, 3) for x in rows["times"]]), len(h))
        codes = np.split(code_of(counts)[inverse], np.cumsum([len(x) for x in runs])[:-1])
        return pd.DataFrame({"chunk": rows["chunk"], "part": rows["part"], "codes": [x.tobytes() for x in codes]})

    sent = _at_chunks(chunks, owned, send, "chunk long, part int, data binary, times binary")
    counted = sent.groupBy("part").applyInPandas(count, "chunk long, part int, codes binary")
    # A chunk has few runs, and their codes are together no more than a byte for each of its shingles.
    runs = counted.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("part", "codes"))).alias("runs"))
    return runs.join(owned, "chunk").select("chunk", "owned", F.transform("runs", lambda x: x["codes"]).alias("codes"))


def _prefixes(chunks: DataFrame, told: DataFrame, num: int, den: int, heavy: int) -> DataFrame:
    """sid, n, bits, light with place, and hot (packed): the shingles of a set's prefix that other sets have too; firsts are the smallest of hot, ascending. Sets without any are left out."""
    schema = pa.schema([("sid", pa.int64()), ("n", pa.int64()), *[(c, pa.binary()) for c in ("bits", "light", "place", "hot", "firsts")]])

    def run(chunk: Chunk, row: dict) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in schema]
        for sid, h, code in chunk.ordered(np.frombuffer(b"".join(row["codes"]), np.uint8)):
            n = len(h)
            first = code[: n - ceil_div(num * n, den) + 1]
            if first[-1] < 2:
                continue
            light, hot = np.flatnonzero((first > 1) & (first < heavy)), np.flatnonzero(first >= heavy)
            for column, value in zip(out, (sid, n, bitmap(h), h[light].tobytes(), light.astype(np.int32).tobytes(), h[hot].tobytes(), np.sort(h[hot])[:FIRSTS].tobytes()), strict=True):
                column.append(value)
        yield batch(schema, *out)

    return _at_chunks(chunks, told, run, "sid long, n long, bits binary, light binary, place binary, hot binary, firsts binary")


def bitmap(hashes: np.ndarray) -> bytes:
    width = 256
    while width < 4 * len(hashes) and width < 16_384:
        width *= 2
    return np.packbits(np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width).astype(np.uint8) & 1).tobytes()


ONES = np.array([bin(i).count("1") for i in range(256)], np.uint16)


def differ(a: bytes, b: bytes) -> int:
    """At least so many shingles are in one set alone. The wider bitmap is folded to the other's width."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(ONES[x ^ y].sum())


def needed(x, y, num: int, den: int):
    """The smallest overlap with which sets of x and y shingles have a similarity of num / den."""
    return ceil_div(num * (x + y), num + den)


class Trie:
    """Sets as rows of ascending ranks, in lexicographic order; a node is a range of rows with a common start."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        self.sizes = np.array([len(sets[i]) for i in self.order], np.int64)
        self.rows = np.full((len(sets), int(self.sizes.max(initial=0)) + 1), np.iinfo(np.int32).max, np.int32)
        for r, i in enumerate(self.order):
            self.rows[r, : len(sets[i])] = sets[i]

    def search(self, probe: np.ndarray, ranks: int, num: int, den: int) -> list[int]:
        """Places (in the list given) of the sets whose similarity with ``probe`` (ascending ranks) is num / den or more."""
        inside = np.zeros(ranks + 1, bool)
        inside[probe] = True
        n, found = len(probe), []
        stack = [(0, len(self.rows), 0, 0)] if len(self.rows) else []
        while stack:
            lo, hi, depth, common = stack.pop()
            first, last = self.rows[lo], self.rows[hi - 1]
            unequal = np.flatnonzero(first[depth:] != last[depth:])
            end = min(depth + int(unequal[0]) if len(unequal) else len(first), int(self.sizes[lo]))
            common += int(inside[first[depth:end]].sum())
            sizes = self.sizes[lo:hi]
            low, high = int(sizes.min()), int(sizes.max())
            left = n - int(np.searchsorted(probe, first[end - 1], "right")) if end else n
            if common + min(left, high - end) < needed(n, low, num, den):
                continue
            if low == high == end:  # no shingle is left: the rows are equal
                found += [self.order[r] for r in range(lo, hi) if den * common >= num * (n + end - common)]
                continue
            column = self.rows[lo:hi, end]
            cuts = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), hi - lo]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if column[a] == np.iinfo(np.int32).max:  # sets that end here
                    found += [self.order[lo + r] for r in range(a, b) if den * common >= num * (n + end - common)]
                else:
                    stack.append((lo + a, lo + b, end, common))
        return found


def _light_pairs(prefixes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of sets with a common light shingle in their prefixes, less those that sizes and places rule out. Lists are bounded by the definition of light.

    If a pair's first common shingle stands at places i and j, all it has in common lies from there on."""
    total = prefixes.agg(F.sum(F.octet_length("light") / 8)).first()[0] or 0
    parts = max(2 * int(prefixes.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / (GROUP / 2)))
    edges = range_edges(parts)
    schema = pa.schema([("part", pa.int32()), *[(c, pa.binary()) for c in ("data", "sids", "sizes", "places")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            h = np.concatenate([x for x, *_ in held])
            at = np.argsort(h, kind="stable")
            columns = [h[at], *[np.concatenate([x[k] for x in held])[at] for k in (1, 2, 3)]]
            held.clear()
            cuts = np.searchsorted(columns[0], edges)
            split = [np.split(c, cuts) for c in columns]
            runs = [(p, steps(x), s.tobytes(), planes(n, 4), planes(i, 4)) for p, (x, s, n, i) in enumerate(zip(*split, strict=True)) if len(x)]
            return batch(schema, *[list(c) for c in zip(*runs, strict=True)])

        total = 0
        for rows in slices(batches, 2048):
            for sid, n, light, place in zip(rows["sid"], rows["n"], rows["light"], rows["place"], strict=True):
                h = np.frombuffer(light, np.uint64)
                held.append((h, np.full(len(h), sid), np.full(len(h), n), np.frombuffer(place, np.int32)))
                total += len(h)
                if total >= GROUP:
                    yield flush()
                    total = 0
        if total:
            yield flush()

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([unstep(x) for x in rows["data"]])
        sid, n, place = np.frombuffer(b"".join(rows["sids"]), np.int64), *(np.concatenate([unplane(x, 4) for x in rows[c]]).astype(np.int64) for c in ("sizes", "places"))
        at = np.lexsort((sid, h))
        h, sid, n, left = h[at], sid[at], n[at], (n - place)[at]
        pairs: list[np.ndarray] = []
        gap = 1
        while gap < len(h):  # neighbours at each distance within a list
            x = np.flatnonzero(h[gap:] == h[:-gap])
            if not len(x):
                break
            y = x + gap
            least = needed(n[x], n[y], num, den)
            stays = (sid[x] != sid[y]) & (np.minimum(left[x], left[y]) >= least) & (np.minimum(n[x], n[y]) >= least)
            pairs.append(np.stack([sid[x[stays]], sid[y[stays]]], 1))
            gap += 1
        found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.empty((0, 2), np.int64)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    dealt = prefixes.filter(F.octet_length("light") > 0).select("sid", "n", "light", "place").mapInArrow(run, "part int, data binary, sids binary, sizes binary, places binary")
    return dealt.groupBy("part").applyInPandas(reduce, "a long, b long")


def _hot_rows(prefixes: DataFrame) -> DataFrame:
    """(token, sid) of the prefixes' heavy shingles."""
    schema = pa.schema([("token", pa.int64()), ("sid", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 1024):
            parts = [np.frombuffer(x, np.int64) for x in rows["hot"]]
            if sum(map(len, parts)):
                yield pa.record_batch([pa.array(np.concatenate(parts)), pa.array(np.repeat(np.array(rows["sid"], np.int64), [len(x) for x in parts]))], schema=schema)

    return prefixes.filter(F.octet_length("hot") > 0).select("sid", "hot").mapInArrow(run, "token long, sid long")


def _bounded(pairs: DataFrame, uniq: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that sizes and bitmaps can't rule out."""
    side = lambda x: uniq.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    wide = pairs.join(side("a"), "a").join(side("b"), "b").filter((den * F.col("n_a") >= num * F.col("n_b")) & (den * F.col("n_b") >= num * F.col("n_a")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = batch.to_pydict()
            stays = [differ(p, q) <= x + y - 2 * needed(x, y, num, den) for p, q, x, y in zip(c["bits_a"], c["bits_b"], c["n_a"], c["n_b"], strict=True)]
            yield batch.select(["a", "b", "n_b"]).filter(pa.array(stays, pa.bool_()))

    return wide.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long, n_b long")


def _across(placed: DataFrame, uniq: DataFrame, roots: DataFrame, num: int, den: int, since: int, until: int, block: int = BLOCK) -> DataFrame:
    """Of the heavy lists (token, sid, root) that have several roots: the pairs of different roots that sizes and bitmaps can't rule out, as (a, b, n_b), and a row of zeros where some are left.

    Sets outside their list's main component meet all sets of the list in blocks; a task compares two blocks' bitmaps and lists what is left alone.
    A pair belongs to the first list that has both its sets (as far as their ``firsts`` tell), and there to one set, which lists of its
    candidates in a block, nearest first, those from ``since`` to ``until``. ``placed`` fixes whose a pair is and stays the same from call to
    call; ``roots`` (node, root) is what links join by now, and pairs within a root of that are not listed."""
    sizes = placed.groupBy("token", "root").agg(F.count("*").alias("c"))
    lists = sizes.groupBy("token").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.max("c").alias("most"), F.sum("c").alias("all"), F.count("*").alias("roots"))
    lists = lists.filter("roots > 1").select("token", "main", F.ceil((F.col("all") - F.col("most")) / block).alias("ki"), F.ceil(F.col("all") / block).alias("kj"))
    now = roots.select(F.col("node").alias("sid"), F.col("root").alias("now"))
    rows = placed.join(lists, "token").join(uniq.select("sid", "n", "bits", "firsts"), "sid").join(now, "sid", "left").withColumns({"outer": F.col("root") != F.col("main"), "now": F.coalesce("now", "sid")})
    deal = lambda k: F.pmod(F.xxhash64("sid"), F.col(k))
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.col(k) - 1))
    columns = ("sid", "root", "now", "n", "outer", "firsts", "bits")
    outside = rows.filter("outer").select("token", deal("ki").alias("i"), every("kj").alias("j"), *columns)
    # Both sides come from one frame, so the columns of one get names (and ids) of their own.
    whole = rows.select(F.col("token").alias("t"), every("ki").alias("p"), deal("kj").alias("q"), *[F.col(c).alias(f"{c}_2") for c in columns])

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found, more = [], False
        if len(left) and len(right):
            token = left["token"].iloc[0]
            right = _by_width(right.rename(columns=lambda c: c.removesuffix("_2")), token)
            for x in _by_width(left, token):
                folded = [(_folded(y[0], min(x[0].shape[1], y[0].shape[1])), y) for y in right]
                for k, (sid, root, now, n, before) in enumerate(zip(*x[1:5], x[6], strict=True)):
                    near = []
                    for bits, (_, sids, roots, nows, sizes, outer, befores) in folded:
                        apart = np.bitwise_count(bits ^ _folded(x[0][k : k + 1], bits.shape[1])).sum(1, dtype=np.int64)
                        # A pair of two outside sets is listed by the smaller one.
                        stays = (roots != root) & (~outer | (sids > sid)) & (apart <= n + sizes - 2 * needed(n, sizes, num, den)) & (den * n >= num * sizes) & (den * sizes >= num * n)
                        at = [i for i in np.flatnonzero(stays) if not np.isin(befores[i], before).any()]
                        near += zip(*(c[at].tolist() for c in (apart, sids, nows, sizes)), strict=True)
                    near.sort()
                    more |= any(o != now for *_, o, _ in near[until:])
                    found += [(min(int(sid), y), max(int(sid), y), max(int(n), m)) for _, y, o, m in near[since:until] if o != now]
        return pd.DataFrame([*found, *[(0, 0, 0)] * more], columns=["a", "b", "n_b"]).astype("int64")

    met = outside.groupBy("token", "i", "j").cogroup(whole.groupBy("t", "p", "q")).applyInPandas(meet, "a long, b long, n_b long")
    return met.groupBy("a", "b").agg(F.max("n_b").alias("n_b"))


def _by_width(rows: pd.DataFrame, token: int) -> list[tuple]:
    """Bitmaps (rows of 64-bit words), sids, roots before and now, sizes, whether outside, and the firsts below ``token``, by the bitmaps' width."""
    out = []
    for _, part in rows.groupby(rows["bits"].map(len)):
        firsts = [x[x < token] for x in (np.frombuffer(x, np.int64) for x in part["firsts"])]
        out.append((np.frombuffer(b"".join(part["bits"]), np.uint64).reshape(len(part), -1), *(part[c].to_numpy() for c in ("sid", "root", "now", "n", "outer")), firsts))
    return out


def _folded(bits: np.ndarray, narrow: int) -> np.ndarray:
    while bits.shape[1] > narrow:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _verified(pairs: DataFrame, chunks: DataFrame, told: DataFrame, homes: DataFrame, num: int, den: int, scratch: Scratch, unit: int = 400_000, rows: int = 256) -> DataFrame:
    """The pairs that are links. Sets come from their chunks and are sent once a unit: a set and at most about ``rows`` candidates, of together about ``unit`` shingles."""
    asked = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
    asked = asked.join(homes, "sid").groupBy("chunk").agg(F.collect_list("sid").alias("asked"))
    schema = pa.schema([("sid", pa.int64()), ("hashes", pa.binary()), ("codes", pa.binary())])

    def give(chunk: Chunk, row: dict) -> Iterator[pa.RecordBatch]:
        wanted = set(row["asked"])
        found = [(sid, planes(h), code.tobytes()) for sid, h, code in chunk.ordered(np.frombuffer(b"".join(row["codes"]), np.uint8)) if sid in wanted]
        for at in range(0, len(found), 512):
            yield batch(schema, *[list(c) for c in zip(*found[at : at + 512], strict=True)])

    sets = scratch.keep(_at_chunks(chunks, told.join(asked, "chunk"), give, "sid long, hashes binary, codes binary"), "asked-sets")
    weight = pairs.groupBy("a").agg(F.ceil(F.greatest(F.sum("n_b") / unit, F.count("*") / rows)).cast("int").alias("salts"))
    units = scratch.keep(pairs.join(weight, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int")).select("a", "salt", "b"), "units")
    right = units.join(sets.select(F.col("sid").alias("b"), F.col("hashes").alias("other"), F.col("codes").alias("scale")), "b").select(F.col("a").alias("of"), F.col("salt").alias("part"), "b", "other", "scale")
    left = units.select("a", "salt").distinct().join(sets.select(F.col("sid").alias("a"), "hashes", "codes"), "a").select("a", "salt", "hashes", "codes")

    def meet(probe: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        if len(probe) and len(candidates):
            sets = [unplane(x) for x in [*probe["hashes"], *candidates["other"]]]
            code = np.frombuffer(b"".join([*probe["codes"], *candidates["scale"]]), np.uint8)
            known, first, inverse = np.unique(np.concatenate(sets), return_index=True, return_inverse=True)
            rank = np.empty(len(known), np.int32)
            rank[np.lexsort((known, code[first]))[::-1]] = np.arange(len(known), dtype=np.int32)  # the most frequent first
            mine, *others = (np.sort(x) for x in np.split(rank[inverse], np.cumsum([len(x) for x in sets])[:-1]))
            out = [(int(probe["a"].iloc[0]), int(candidates["b"].iloc[i])) for i in Trie(others).search(mine, len(known), num, den)]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    links = left.groupBy("a", "salt").cogroup(right.groupBy("of", "part")).applyInPandas(meet, "a long, b long")
    out = scratch.keep(links, "links")
    scratch.drop(sets, units)
    return out


def classed(docs: DataFrame, size: int, num: int, den: int, heavy: int, out: Scratch) -> DataFrame:
    """doc_id, key (of doc_id and text), n, sid, root (of the component) and class_size of every document; sid and root are null for empty sets."""
    spark = docs.sparkSession
    deal = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with Scratch(spark, "jaccard") as scratch:
        made = scratch.bucketed(_chunks(docs, size), "chunk", deal, "chunks", compression="zstd", **{"parquet.block.size": str(32 << 20)})
        chunks = made.filter("sids IS NOT NULL").select("chunk", "sids", "sizes", "hashes", "owners")
        members = scratch.keep(made.filter("key IS NOT NULL").select("doc_id", "key", "n", "sid", "chunk"), "members")
        homes = scratch.keep(members.filter("sid IS NOT NULL").groupBy("sid").agg(F.min("chunk").alias("chunk"), F.first("n").alias("n"), F.count("*").alias("class_size")), "homes")
        total = homes.agg(F.sum("n")).first()[0] or 0
        owned = homes.groupBy("chunk").agg(F.collect_list("sid").alias("owned"))
        told = scratch.keep(_codes(chunks, owned, max(2 * deal, math.ceil(total / GROUP))), "codes")
        prefixes = scratch.keep(_prefixes(chunks, told, num, den, heavy), "prefixes")
        light = _light_pairs(prefixes, num, den)
        hot = _hot_rows(prefixes)
        several = hot.groupBy("token").agg(F.min("sid").alias("h1"), F.max("sid").alias("h2"), F.min_by("sid", F.xxhash64("sid", "token")).alias("h3"), F.count("*").alias("c")).filter("c > 1")
        hot = scratch.keep(hot.join(several, "token"), "hot")
        star = hot.select("sid", F.explode(F.array("h1", "h2", "h3")).alias("hub")).filter("sid <> hub").select(F.col("hub").alias("a"), F.col("sid").alias("b"))
        first = scratch.keep(_bounded(light.unionByName(star).distinct(), prefixes, num, den), "first")
        links = _verified(first, chunks, told, homes.select("sid", "chunk"), num, den, scratch)
        roots = scratch.keep(components(links, scratch), "roots")
        # Heavy lists whose members are in several components still. The nearest candidates come first: what they join needs no others.
        placed = hot.select("token", "sid").join(roots, F.col("sid") == F.col("node"), "left").select("token", "sid", F.coalesce("root", "sid").alias("root"))
        placed = scratch.keep(placed, "placed")
        for since, until in pairwise(NEAREST):
            met = scratch.keep(_across(placed, prefixes, roots, num, den, since, until), "second")
            second = met.filter("n_b > 0")
            if not second.isEmpty():
                links = scratch.keep(links.unionByName(_verified(second, chunks, told, homes.select("sid", "chunk"), num, den, scratch)), "links")
                roots = scratch.keep(components(links, scratch), "roots")
            if met.filter("n_b = 0").isEmpty():
                break
        table = homes.join(roots, F.col("sid") == F.col("node"), "left").select("sid", "class_size", F.coalesce("root", "sid").alias("root"))
        return out.keep(members.join(table, "sid", "left").select("doc_id", "key", "n", "sid", "root", "class_size"), "classed")


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 4, den: int = 5, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_shingles, component_id, class_size (documents with an equal set) of every document, for a similarity of num / den or more.

    ``heavy``, at most 200, parts light from heavy shingles; it changes the work, not the result."""
    scratch = Scratch(docs.sparkSession, "components")
    members = classed(docs, size, num, den, min(heavy, 200), scratch)
    ids = members.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    empty: Column = F.col("sid").isNull()
    return members.join(ids, "root", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, F.lit(1).cast("long")).otherwise(F.col("class_size")).alias("class_size"),
    )


def first_of_each(docs: DataFrame, size: int = 5, num: int = 4, den: int = 5, heavy: int = HEAVY) -> DataFrame:
    """The documents less all but one of each component: the one with the smallest doc_id stays, then the smallest hash of its text.

    A document without doc_id stays only where no other of its component has one. Rows equal in doc_id and text are one document, of
    which one row stays. Documents with an empty set all stay but for such rows."""
    scratch = Scratch(docs.sparkSession, "deduplicated")
    members = classed(docs.select("doc_id", "text"), size, num, den, min(heavy, 200), scratch)
    key = "_" * (1 + max(map(len, docs.columns)))  # no column's name
    best = members.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "key")).alias("best"))
    goes = members.join(best, "root").filter(F.col("key") != F.col("best.key")).select(F.col("key").alias(key)).distinct()
    repeated = members.groupBy("key").count().filter("count > 1").select(F.col("key").alias(key))
    left = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))).join(goes, key, "left_anti")
    again = left.join(repeated, key, "left_semi").dropDuplicates([key])
    return left.join(repeated, key, "left_anti").unionByName(again).select(*docs.columns)
