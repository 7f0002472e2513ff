"""A trie of conversation prefixes, from partial tries that merge.

1. A turn goes on as a digest of its role and text (128 bits of SHA-256) and its number of words; texts are never shuffled.
   Turns are dealt by the conversation whose head others take over, and sorted, so a task reads each conversation as a stream
   and holds the head alone.
2. A node's key is a digest of its parent's key and its last turn's digest. Each task combines the nodes of its
   conversations (members, smallest member) and lets them go whenever it holds ``HELD``. Equal prefixes have equal keys
   wherever they come from, so the partial tries merge by key: in rounds, each merging tables of up to ``FAN`` tasks,
   until there is one.
3. Conversations that end in a node make its end list. Lists are sorted by ranges of (node, conversation), packed into
   blocks, and a node's digest reads its blocks in order; a list is never held whole, however many copies a conversation has.
4. Rollup. A node is named by its smallest member, and the nodes with one name are a path: the smallest member of a node
   is the smallest of the child that has it. So the trie is a tree of paths, each hung on a node of a path with
   a smaller name. Sums of subtrees of paths are made from below by doubling: after k rounds a path has the
   sum of all within 2^k steps below, and a path then names its ancestor 2^k above. The sum of a node is that of its path
   from it on, with what hangs there: a running sum along the path. Rounds grow with the logarithm of the depth.

Defined cases: rows without conv_id belong to no conversation; turns with equal numbers are ordered by the digest of role and text;
repeated rows are turns of their own; a null role or text is empty; conv_id - conv_id % 20 truncates to zero, as SQL has it; a
conversation without turns ends in the root; an empty table gives no rows, not even a root; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessarea.llm.common import release
from tessarea.session import Scratch

HELD, FAN, BLOCK = 100_000, 32, 1 << 16  # nodes of a partial trie; tables a merge; ids of a block
ROOT = bytes(16)
NODE = pa.schema([("key", pa.binary()), ("parent", pa.binary()), ("part", pa.int32()), ("depth", pa.int64()), ("words", pa.int64()), ("n", pa.int64()), ("conv_id", pa.int64()), ("ends", pa.bool_())])


def turns(conversations: DataFrame, every: int) -> DataFrame:
    """conv_id, base (whose head it takes over), turn, digest and words of each row."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    both = F.concat(F.length(said("role")).cast("string"), F.lit(":"), said("role"), said("text"))
    conv = F.col("conv_id").cast("long")
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        conv.alias("conv_id"),
        (conv - conv % every).alias("base"),
        F.col("turn").cast("long").alias("turn"),
        F.substring(F.unhex(F.sha2(both, 256)), 1, 16).alias("digest"),
        F.regexp_count(said("text"), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )


class Partial:
    """The nodes of a task's conversations so far."""

    def __init__(self, part: int):
        self.part, self.nodes, self.ended = part, {}, []

    def visit(self, key: bytes, parent: bytes | None, depth: int, words: int, conv: int) -> None:
        node = self.nodes.get(key)
        if node is None:
            self.nodes[key] = [parent, depth, words, 1, conv]
        else:
            node[3] += 1
            node[4] = min(node[4], conv)

    def full(self) -> bool:
        return len(self.nodes) + len(self.ended) >= HELD

    def emit(self) -> Iterator[pa.RecordBatch]:
        """Nodes, then (node, conversation) of the ends."""
        if self.nodes:
            parent, depth, words, n, conv = (list(c) for c in zip(*self.nodes.values(), strict=True))
            m = len(self.nodes)
            yield _batch(list(self.nodes), parent, [self.part] * m, depth, words, n, conv, [False] * m)
        if self.ended:
            keys, convs = (list(c) for c in zip(*self.ended, strict=True))
            m = len(keys)
            yield _batch(keys, [None] * m, [self.part] * m, [None] * m, [None] * m, [None] * m, convs, [True] * m)
        self.nodes, self.ended = {}, []


def _batch(*columns: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, NODE.types, strict=True)], schema=NODE)


def head_length(conv: int) -> int:
    return zlib.crc32(str(conv).encode()) % 4


def partial_tries(rows: DataFrame) -> DataFrame:
    """The node tables of all tasks, and the ends. Turns of a base come first, then those of each conversation, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        release()
        trie = Partial(TaskContext.get().partitionId())
        base, head = None, []  # the current base's first turns
        conv, key, depth, own, take = None, ROOT, 0, 0, 0

        def step(digest: bytes, words: int) -> None:
            nonlocal key, depth
            parent, key, depth = key, blake2b(key + digest, digest_size=16).digest(), depth + 1
            trie.visit(key, parent, depth, words, conv)

        for batch in batches:
            c = batch.to_pydict()
            for b, of, digest, words in zip(c["base"], c["conv_id"], c["digest"], c["words"], strict=True):
                if of != conv or b != base:
                    if conv is not None:
                        trie.ended.append((key, conv))
                    if trie.full():
                        yield from trie.emit()
                    if b != base:
                        base, head = b, []
                    conv, key, depth, own, take = of, ROOT, 0, 0, head_length(of)
                    trie.visit(ROOT, None, 0, 0, conv)
                    if conv != base:
                        for turn in head[:take]:
                            step(*turn)
                if conv == base and len(head) < 3:
                    head.append((digest, words))
                if conv == base or own >= take:
                    step(digest, words)
                    if trie.full():
                        yield from trie.emit()
                own += 1
        if conv is not None:
            trie.ended.append((key, conv))
        yield from trie.emit()

    first = F.col("conv_id") != F.col("base")
    dealt = rows.repartition("base").sortWithinPartitions("base", first, "conv_id", F.asc_nulls_first("turn"), "digest")
    return dealt.select("base", "conv_id", "digest", "words").mapInArrow(run, "key binary, parent binary, part int, depth long, words long, n long, conv_id long, ends boolean")


def merged(nodes: DataFrame, parts: int, scratch: Scratch) -> DataFrame:
    """key, parent, depth, words, n, conv_id: one trie of the partial ones, by rounds of up to FAN tables a key."""
    while True:
        parts = math.ceil(parts / FAN)
        near = F.floor(F.col("part") / FAN).cast("int").alias("part")
        same = [F.first(c).alias(c) for c in ("parent", "depth", "words")]
        nodes = nodes.groupBy("key", near).agg(*same, F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"))
        if parts <= 1:
            return scratch.keep(nodes.drop("part"), "nodes")


def end_digests(ends: DataFrame) -> DataFrame:
    """key, ends_sha256: of each node's ends in ascending order, as decimal numbers between commas."""
    block = pa.schema([("key", pa.binary()), ("at", pa.int64()), ("ids", pa.binary())])
    out = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            keys = batch.column("key")
            ids = np.asarray(batch.column("conv_id"))
            names = keys.to_pylist()
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            runs = [(lo + k, min(hi, lo + k + BLOCK)) for lo, hi in zip(cuts, cuts[1:], strict=False) for k in range(0, hi - lo, BLOCK)]
            yield pa.record_batch([pa.array([names[a] for a, _ in runs], pa.binary()), pa.array([int(ids[a]) for a, _ in runs], pa.int64()), pa.array([ids[a:b].tobytes() for a, b in runs], pa.binary())], schema=block)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, found = None, sha256(), []
        for batch in batches:
            for name, ids in zip(batch.column("key").to_pylist(), batch.column("ids"), strict=True):
                text = ",".join(map(str, np.frombuffer(ids.as_buffer(), np.int64).tolist())).encode()
                if name == key:
                    state.update(b"," + text)
                    continue
                if key is not None:
                    found.append((key, state.hexdigest()))
                key, state = name, sha256(text)
            if found:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found, strict=True), out.types, strict=True)], schema=out)
                found = []
        if key is not None:
            yield pa.record_batch([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], schema=out)

    # A long list lies in several ranges, each of which packs its part.
    blocks = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(pack, "key binary, at long, ids binary")
    return blocks.repartition("key").sortWithinPartitions("key", "at").mapInArrow(digest, "key binary, ends_sha256 string")


def rolled_up(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """key, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens of every node."""
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    own = nodes.join(children, "key", "left").join(above, "parent", "left").select(
        "key",
        "conv_id",
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaf"),
        ((F.col("n") - 1) * F.col("words")).alias("saved"),
    )
    own = scratch.keep(own, "own")
    sums = own.groupBy("conv_id").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"), F.min("depth").alias("top"), F.max(F.when(~F.col("parent_conv_id").eqNullSafe(F.col("conv_id")), F.col("parent_conv_id"))).alias("up"))
    paths = scratch.keep(sums.withColumn("hung", F.col("up")), "paths")
    while not paths.filter("up IS NOT NULL").isEmpty():
        below = paths.filter("up IS NOT NULL").groupBy(F.col("up").alias("conv_id")).agg(F.sum("leaf").alias("leaf_2"), F.sum("saved").alias("saved_2"))
        next_up = paths.select(F.col("conv_id").alias("up"), F.col("up").alias("up_2"))
        more = lambda c: (F.col(c) + F.coalesce(f"{c}_2", F.lit(0))).alias(c)
        moved = paths.join(below, "conv_id", "left").join(next_up, "up", "left").select("conv_id", more("leaf"), more("saved"), "top", F.col("up_2").alias("up"), "hung")
        new = scratch.keep(moved, "paths")
        scratch.drop(paths)
        paths = new
    hung = paths.filter("hung IS NOT NULL").groupBy(F.col("hung").alias("conv_id"), (F.col("top") - 1).alias("depth")).agg(F.sum("leaf").alias("leaf_2"), F.sum("saved").alias("saved_2"))
    along = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = lambda c: F.sum(F.col(c) + F.coalesce(f"{c}_2", F.lit(0))).over(along)
    return own.join(hung, ["conv_id", "depth"], "left").select(
        "key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", total("leaf").alias("n_leaves"), total("saved").alias("saved_tokens")
    )


def prefix_trie(conversations: DataFrame, every: int = 20) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    Each conversation is taken with its first turns (none to three, by a checksum of its id) from that whose id is the
    multiple of ``every`` at or below its own."""
    scratch = Scratch(conversations.sparkSession, "trie")
    tries = scratch.keep(partial_tries(turns(conversations, every)), "partial")
    nodes = tries.filter("NOT ends").drop("ends")
    parts = (nodes.agg(F.max("part")).first()[0] or 0) + 1
    rolled = rolled_up(merged(nodes, parts, scratch), scratch)
    digests = end_digests(tries.filter("ends").select("key", "conv_id"))
    none = sha256(b"").hexdigest()
    return rolled.join(digests, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")
    )
