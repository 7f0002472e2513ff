"""What several operators share: texts by Arrow batch, and token ids through a bounded word cache."""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa

ROWS = 256


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[dict[str, list]]:
    """The columns of each run of at most ``rows`` rows as Python lists, so few texts are held at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows).to_pydict()


class _Words(dict):
    """Word to packed ids; an unseen word is encoded once. When about ``most`` bytes are held they become the older
    generation and those of the generation before are forgotten, so frequent words stay."""

    EACH = 200  # bytes of two objects and their place in a table, beside their contents

    def __init__(self, encode: Callable[[str], bytes], most: int):
        super().__init__()
        self.encode, self.most, self.older, self.held = encode, most, {}, 0

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.encode(word)
        self.held += self.EACH + len(word) + len(found)
        if self.held > self.most:
            self.older, self.held = dict(self), 0
            self.clear()
        self[word] = found
        return found


# White space other than the blank and the line feed, as Python or the tokenizers libraries know it.
ODD_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -​    ⁠　﻿]")


def spaced_chunks(text: str) -> list[str] | None:
    """The text cut before each blank and line feed, the blank or feed kept at the front of its chunk.

    None where two spaces meet, the text ends in a space or has other white space: there a pattern of
    pre-tokenization may join what stands on both sides of a cut.
    """
    if not text or ODD_SPACE.search(text):
        return None
    parts = text.replace("\n", " \n").split(" ")
    return None if "" in parts[1:] or "\n" in parts else parts


LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
# Chunks of these characters alone are cut here by the pattern of the tokenizer file: letters are LATIN, numbers 0-9.
EASY = re.compile(rf"[ \n]?[!-~{LATIN}]+")
# The patterns of the two kinds of tokenizer files, for EASY chunks.
WORD_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN}]+|[0-9]|[^\s{LATIN}0-9]+")
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN}]+| ?[0-9]+| ?[^\s{LATIN}0-9]+|\s+(?!\S)|\s+")


def byte_letters() -> str:
    """The letter that byte-level tokenizer files write for each byte: itself if printable, else the next from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return "".join(chr(b if b in shown else next(spare)) for b in range(256))


class ChunkedEncoder:
    """Ids of texts as packed little-endian unsigned 32-bit integers, through a cache of at most about twice ``most`` bytes.

    The cache holds chunks between spaces and the words of chunks that end in a stop. Where a pre-tokenizer could look across a
    chunk's edge, ``whole`` sees the whole text. Kinds: a split into words that drops white space ("word"), one that keeps one
    blank before a word ("byte"), any other ("whole").
    """

    def __init__(self, kind: str, word: Callable[[str], bytes], whole: Callable[[str], bytes], lower: bool = False, most: int = 64 << 20):
        self.kind, self.word, self.whole, self.lower = kind, word, whole, lower
        self.parts = WORD_PARTS if kind == "word" else BYTE_PARTS
        self.plain = _Words(self._chunk, most if kind == "word" else most // 12)
        self.spaced = _Words(self._spaced, most)

    def _spaced(self, chunk: str) -> bytes:
        """A chunk behind a blank, or behind the line feed that it begins with."""
        if chunk.isalpha():
            return self.word(f" {chunk}")
        if chunk[-1] in ".,!?" and chunk[:-1].isalpha():
            return self.spaced[chunk[:-1]] + self.plain[chunk[-1]]
        return self._cut(chunk if chunk[0] == "\n" else f" {chunk}")

    def _chunk(self, chunk: str) -> bytes:
        if self.kind == "word":
            low = chunk.lower() if self.lower else chunk
            if len(chunk) > 1 and chunk[-1] in ".,!?" and EASY.fullmatch(chunk) and low[:-1].isalpha():
                return self.plain[low[:-1]] + self.plain[chunk[-1]]
        return self._cut(chunk)

    def _cut(self, chunk: str) -> bytes:
        if not EASY.fullmatch(chunk):
            return self.whole(chunk)
        return b"".join(map(self.word, self.parts.findall(chunk.lower() if self.lower else chunk)))

    def __call__(self, text: str) -> bytes:
        if self.kind == "word":
            return b"".join(map(self.plain.__getitem__, text.replace("\n", " ").split(" ")))
        if self.kind == "byte" and (parts := spaced_chunks(text)):
            return b"".join([self.plain[parts[0]], *map(self.spaced.__getitem__, parts[1:])])
        return self.whole(text)


def library_encoder(path: str) -> ChunkedEncoder:
    """The tokenizers library with the tokenizer file at ``path``; what cuts are safe follows from the file.

    Strings of special tokens in a text are ordinary text."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    model, letters = library.model, dict(enumerate(byte_letters()))
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, normalizer = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    steps = pre.get("pretokenizers", [pre])
    kind = "whole"
    if not normalizer and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        kind = "byte"
    elif steps[0].get("pattern", {}).get("Regex") == WORD_PATTERN and steps[0].get("invert"):
        kind = "word"

    def whole(text: str) -> bytes:
        ids = library.encode(text, add_special_tokens=False).ids if text else ()
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(part: str) -> bytes:
        ids = [t.id for t in model.tokenize(part.encode().decode("latin-1").translate(letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    return ChunkedEncoder(kind, word, whole, any(x.get("type") == "Lowercase" for x in normalizer.get("normalizers", [])))


def hash_edge(share: float) -> int:
    """The signed 64-bit value below which the given share of all hashes lies."""
    return min(2**63 - 1, int(share * 2**64) - 2**63)


ENCODERS: dict[tuple, object] = {}


def once(key: tuple, make: Callable[[], object]) -> object:
    """One object a Python worker: workers serve many tasks, and tables load once. Those of other files (``key[1]``) are let go."""
    for other in [k for k in ENCODERS if k[1] != key[1]]:
        del ENCODERS[other]
    if key not in ENCODERS:
        ENCODERS[key] = make()
    return ENCODERS[key]


def release() -> None:
    """Lets go of what earlier tasks of other operators left in this worker."""
    ENCODERS.clear()
