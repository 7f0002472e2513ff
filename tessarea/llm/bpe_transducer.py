"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

Why a left-to-right machine is possible: a sequence of tokens is the encoding of its bytes just if each two
neighbours, taken alone, are the encoding of theirs. So each prefix of a word has one last token, and what the
future can still change is only where the running token began. A state of the subset construction is the set of
such hypotheses: (token before, place in the trie of tokens). Each byte's arc tells the last token of the bytes so far, by
which the tokens of every hypothesis can be followed back; those on which all agree are emitted. No hypothesis is older
than the longest token, which bounds the lookahead. States and arcs are made when a text first needs them, and shared by
all words.

Whether two tokens may stand side by side is found by undoing their joinings, the latest first, down to the bytes at
the seam, without encoding anything.

Decoding joins the tokens' bytes and passes them on up to the last complete UTF-8 sequence, which a state
machine carried from block to block finds.

Defined cases: a null text counts as empty and has no ids; a null doc_id is carried; repeated rows are encoded
each; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessarea.llm.common import ChunkedEncoder, once, slices


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge_by_rank(word: bytes, ranks: dict[bytes, int], below: int = 1 << 61) -> list[int]:
    """The definition: of neighbours whose joint bytes are a token, the pair with the lowest rank is joined first, the leftmost on ties. Ranks from ``below`` on count for nothing."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 62))
        if ranks.get(parts[best] + parts[best + 1], 1 << 62) >= below:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


class _State(dict):
    """A set of hypotheses; byte to (state, last token of the bytes so far), made when first asked for."""

    __slots__ = ("hypotheses", "machine")

    def __init__(self, machine: Transducer, hypotheses: tuple[int, ...]):
        super().__init__()
        self.machine, self.hypotheses = machine, hypotheses

    def __missing__(self, byte: int) -> tuple[_State, int]:
        """An arc is kept when it is asked for again, so words that occur once take no room for long."""
        machine = self.machine
        found = machine._arc(self.hypotheses, byte)
        mark = hash(self.hypotheses) + byte * 1_000_003 & 0x1FFFFF
        if machine.asked[mark]:
            self[byte] = found = (machine.states.setdefault(found[0].hypotheses, found[0]), found[1])
        machine.asked[mark] = 1
        return found


class Transducer:
    """Words to packed ids. ``most_states`` bounds its memory: beyond it the lazily made part is dropped and made anew."""

    PLACES = 24  # bits for a place in the trie of tokens, below those for the token before it
    FEW = 0  # tokens below a place for which it is tried whether any may follow the token before
    BLOCK = 256  # bytes between emissions within a long word

    def __init__(self, ranks: dict[bytes, int], most_states: int = 100_000):
        self.ranks, self.most_states = ranks, most_states
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.lengths = {i: len(t) for t, i in ranks.items()}
        self.child: dict[int, int] = {}  # place << 8 | byte to place
        self.token_at, self.depth_at = [-1], [0]
        for token, i in ranks.items():
            at = 0
            for b in token:
                to = self.child.setdefault(at << 8 | b, len(self.token_at))
                if to == len(self.token_at):
                    self.token_at.append(-1)
                    self.depth_at.append(self.depth_at[at] + 1)
                at = to
            self.token_at[at] = i
        self.inner = bytearray(len(self.token_at))
        for key in self.child:
            self.inner[key >> 8] = 1
        self.sorted = [i for _, i in sorted(ranks.items())]  # the tokens below a place are a range of them
        self.first, self.end = [0] * len(self.token_at), [0] * len(self.token_at)
        for k, i in enumerate(self.sorted):
            at = 0
            for b in self.bytes_of[i]:
                at = self.child[at << 8 | b]
                if not self.end[at]:
                    self.first[at] = k + (self.token_at[at] >= 0)  # a token there lies behind, not below
                self.end[at] = k + 1
        if len(self.token_at) >> self.PLACES:
            raise ValueError("too many tokens")
        self.start = max(self.bytes_of) + 1  # stands for the token before the first
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.fits: dict[int, bool] = {}
        self.alive: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        first = (self.start << self.PLACES,)
        self.root = _State(self, first)
        self.states = {first: self.root}
        self.asked = bytearray(1 << 21)

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose joining makes ``token``; None for a single byte and for a token that no joining makes."""
        if token not in self.halves:
            parts = merge_by_rank(self.bytes_of[token], self.ranks, token)
            self.halves[token] = (parts[0], parts[1]) if len(parts) == 2 and self.ranks[self.bytes_of[token]] == token else None
        return self.halves[token]

    def _made(self, token: int) -> bool:
        return len(self.bytes_of[token]) == 1 or self._halves(token) is not None

    def _apart(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are.

        Their last joinings are undone, the later first. At each step the pieces at the seam stood side by side
        until a joining of rank ``until``; had they a joint token of a lower rank, they would have been joined before."""
        ranks, bytes_of, until = self.ranks, self.bytes_of, 1 << 62
        while True:
            if ranks.get(bytes_of[left] + bytes_of[right], 1 << 62) < until:
                return False
            of_left, of_right = self._halves(left), self._halves(right)
            if of_left and (not of_right or left > right):
                until, left = left, of_left[1]
            elif of_right:  # of equal ranks the leftmost is joined first, and the seam lies to the left of this one
                until, right = right + 1, of_right[0]
            else:
                return True

    def _fits(self, before: int, token: int) -> bool:
        key = before << 32 | token
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) > 4 * self.most_states:
                self.fits.clear()
            found = self.fits[key] = self._made(token) and (before == self.start or self._apart(before, token))
        return found

    def _lives(self, hypothesis: int) -> bool:
        """Whether any of the few tokens below its place may follow its token."""
        if len(self.alive) > 4 * self.most_states:
            self.alive.clear()
        before, place = hypothesis >> 24, hypothesis & 0xFFFFFF
        found = self.alive[hypothesis] = any(self._fits(before, t) for t in self.sorted[self.first[place] : self.end[place]])
        return found

    def _arc(self, hypotheses: tuple[int, ...], byte: int) -> tuple[_State, int]:
        running, done, child, inner, token_at = [], -1, self.child, self.inner, self.token_at
        first, end, alive = self.first, self.end, self.alive
        for hypothesis in hypotheses:
            to = child.get((hypothesis & 0xFFFFFF) << 8 | byte)
            if to is not None:
                if done < 0 and token_at[to] >= 0 and self._fits(hypothesis >> 24, token_at[to]):
                    done = token_at[to]
                if inner[to]:
                    going = hypothesis >> 24 << 24 | to
                    if end[to] - first[to] > self.FEW or (self._lives(going) if (lives := alive.get(going)) is None else lives):
                        running.append(going)
        if done < 0:
            raise ValueError("the vocabulary lacks a byte")
        running.append(done << 24)
        key = tuple(running)
        found = self.states.get(key)
        return (_State(self, key) if found is None else found), done

    def _path(self, last: list[int], end: int) -> list[int]:
        """The tokens of the first ``end`` of the bytes whose last tokens are ``last``, the latest token first."""
        out, lengths = [], self.lengths
        while end > 0:
            token = last[end - 1]
            out.append(token)
            end -= lengths[token]
        return out

    def _settled(self, last: list[int], state: _State) -> list[int]:
        """The tokens on which all running hypotheses agree: a hypothesis begins where its place in the trie is deep."""
        depths = [self.depth_at[h & 0xFFFFFF] for h in state.hypotheses]
        paths = [self._path(last, len(last) - d)[::-1] for d in depths]
        shared = 0
        for tokens in zip(*paths, strict=False):
            if len(set(tokens)) > 1:
                break
            shared += 1
        return paths[0][:shared]

    def __call__(self, word: bytes) -> bytes:
        if (whole := self.ranks.get(word)) is not None:  # as the library does, even for a token that no merges reach
            return struct.pack("<I", whole)
        if len(self.states) > self.most_states:
            self._reset()
        at, last, out = self.root, [], []
        for start in range(0, len(word), self.BLOCK):
            for b in word[start : start + self.BLOCK]:
                at, token = at[b]
                last.append(token)
            if len(last) > self.BLOCK:
                done = self._settled(last, at)
                out += done
                del last[: sum(self.lengths[t] for t in done)]
        out += self._path(last, len(last))[::-1]
        return struct.pack(f"<{len(out)}I", *out)


def rank_encoder(path: str, pattern: str) -> ChunkedEncoder:
    """Texts to packed ids: each match of ``pattern`` goes through the transducer by itself."""
    import regex

    machine, cut = Transducer(read_ranks(path)), regex.compile(pattern)

    def word(part: str) -> bytes:
        return machine(part.encode("utf-8", "surrogatepass"))

    return ChunkedEncoder("byte" if pattern == BYTE_PATTERN else "whole", word, lambda text: b"".join(map(word, cut.findall(text))))


# Fixed value: the pattern for which chunks between spaces can be encoded by themselves.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def utf8_table() -> list[dict[int, int]]:
    """States: 0 between characters; 1, 2, 3 so many bytes to come; 4 to 7 the second byte after E0, ED, F0, F4 is limited. A missing arc is an error."""
    tail = range(0x80, 0xC0)
    table: list[dict[int, int]] = [{b: 0 for b in range(0x80)}, dict.fromkeys(tail, 0), dict.fromkeys(tail, 1), dict.fromkeys(tail, 2)]
    table[0] |= dict.fromkeys(range(0xC2, 0xE0), 1) | dict.fromkeys(range(0xE1, 0xF0), 2) | dict.fromkeys(range(0xF1, 0xF4), 3)
    table[0] |= {0xE0: 4, 0xED: 5, 0xF0: 6, 0xF4: 7}
    table += [dict.fromkeys(range(0xA0, 0xC0), 1), dict.fromkeys(range(0x80, 0xA0), 1), dict.fromkeys(range(0x90, 0xC0), 2), dict.fromkeys(range(0x80, 0x90), 2)]
    return table


class StreamDecoder:
    """Ids in blocks to bytes in runs of whole characters. Bytes that can't begin or continue a character are passed on as they are.

    The machine's state goes from block to block with the bytes of the character that it stands in. Within a block only the
    bytes up to the first, and from the last, start of a character matter to it."""

    TABLE = utf8_table()

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of, self.held, self.state = bytes_of, b"", 0

    def push(self, ids: tuple[int, ...] | list[int]) -> bytes:
        data, at, done = b"".join(map(self.bytes_of.__getitem__, ids)), 0, b""
        while self.state and at < len(data):
            self.state, at = self.TABLE[self.state].get(data[at], -1), at + 1
        if self.state == -1:  # the byte that breaks a character off may begin another
            self.state, at = 0, at - 1
        if self.state:
            self.held += data
            return b""
        done, self.held, cut = self.held, b"", len(data)
        for start in range(cut - 1, max(at, cut - 3) - 1, -1):
            if data[start] < 0x80:
                break
            if data[start] >= 0xC0:
                state = 0
                for b in data[start:]:
                    state = self.TABLE[state].get(b, -1)
                    if state <= 0:
                        break
                if state > 0:
                    self.state, self.held, cut = state, data[start:], start
                break
        return done + data[:cut]

    def end(self) -> bytes:
        rest, self.held, self.state = self.held, b"", 0
        return rest


def encode_texts(docs: DataFrame, ranks: str, pattern: str, decode: bool = False, block: int = 8192) -> DataFrame:
    """doc_id and ids (packed) of every whole text; with ``decode`` also decoded, the bytes that a stream of the ids gives."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())] + [("decoded", pa.binary())] * decode)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = once(("ranks", ranks, pattern), lambda: rank_encoder(ranks, pattern))
        for rows in slices(batches, 128):
            ids = [encode(t or "") for t in rows["text"]]
            made = [pa.array(rows["doc_id"], pa.int64()), pa.array(ids, pa.binary())]
            if decode:
                made.append(pa.array(streamed(ids, ranks, block), pa.binary()))
            yield pa.record_batch(made, schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary" + ", decoded binary" * decode)


def streamed(packed: list[bytes | None], ranks: str, block: int) -> list[bytes]:
    """Each row's ids decoded in blocks, as from a stream."""
    bytes_of, out = once(("bytes", ranks), lambda: {i: t for t, i in read_ranks(ranks).items()}), []
    for ids in packed:
        decoder, values = StreamDecoder(bytes_of), memoryview(ids or b"").cast("I")
        out.append(b"".join([*(decoder.push(values[at : at + block].tolist()) for at in range(0, len(values), block)), decoder.end()]))
    return out


def decode_ids(encoded: DataFrame, ranks: str, block: int = 8192) -> DataFrame:
    """doc_id, ids and decoded (bytes) of rows with packed ids. Null ids count as none."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 128):
            yield pa.record_batch([pa.array(rows["doc_id"], pa.int64()), pa.array(rows["ids"], pa.binary()), pa.array(streamed(rows["ids"], ranks, block), pa.binary())], schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
