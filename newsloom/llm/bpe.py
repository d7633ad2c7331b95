"""Byte-level BPE encoding and decoding with a public vocabulary.

A text is cut into short words by the vocabulary's pattern.  Each word holds its
part boundaries in one contiguous array together with the rank of every
adjacent pair; the smallest rank is searched by a scan, its boundary is
deleted, and only the ranks next to it are computed again.  Words of more than
``LONG_WORD`` bytes use the same rule with a heap, as a scan would be quadratic.

Defined cases: a null text is the empty text and gives no ids; special tokens
in a text become their own ids, as the vocabulary file says; equal texts give
equal ids; rows are independent, so ties, repeats and other columns do not
matter, and an empty table gives an empty result.  Memory in a task is bounded
by one Arrow batch and three caches of ``CACHE_WORDS`` words.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import struct
from collections.abc import Iterable, Iterator
from dataclasses import InitVar, dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_slices

LONG_WORD = 96
#: Words of a cache.  Codec and full caches take less than 75 MB of a worker (tested
#: with words of nine letters); from 87,382 words on their tables would be twice as large.
CACHE_WORDS = 87_000
#: Signs that follow a word and are one word by themselves, however many.
SIGNS = ",.;:!?"
#: Documents of one output batch.
SLICE = 256
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = 1 << 60
#: Writers of the ids of short words, by their number.
_PACKED = [struct.Struct(f"<{n}I").pack for n in range(LONG_WORD + 1)]


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable
    bytes stand for themselves, the others for letters from U+0100 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Codec:
    """Ids of byte strings, ranks of merges, and the bytes of ids."""

    ids: InitVar[dict[bytes, int]]
    ranks: InitVar[Iterable[tuple[int, int, int]]]  # left id, right id and merged id by rank
    tokens: list[bytes]
    specials: dict[str, int]
    single: list[int] = field(init=False)
    cache: dict[str, bytes] = field(default_factory=dict)
    pieces: dict[str, bytes] = field(default_factory=dict)
    older: dict[str, bytes] = field(default_factory=dict)  # pieces of the cache before

    def __post_init__(self, ids: dict[bytes, int], ranks: Iterable[tuple[int, int, int]]) -> None:
        self.single = [ids[bytes([b])] for b in range(256)]
        self.words = regex.compile(PATTERN)
        # Pairs as one number, ranks alone, and the id behind each rank: plain
        # numbers compare far faster than tuples, and take less room.
        self.size = len(self.tokens)
        self.joined, self.merged = {}, []
        for rank, (left, right, own) in enumerate(ranks):
            self.joined[left * self.size + right] = rank
            self.merged.append(own)
        self.starts = [self.joined.get(a * self.size + b, _NONE)
                       for a in self.single for b in self.single]
        self.cut = regex.compile("|".join(
            regex.escape(s) for s in sorted(self.specials, key=len, reverse=True))
        ) if self.specials else None

    def merge_short(self, word: bytes) -> list[int]:
        """Part ids and adjacent ranks side by side; the leftmost smallest rank goes first."""
        single, starts, get, size = self.single, self.starts, self.joined.get, self.size
        parts = [single[b] for b in word]
        links = [starts[a << 8 | b] for a, b in zip(word, word[1:])]
        while links:
            best = min(links)
            if best == _NONE:
                break
            at = links.index(best)
            parts[at] = own = self.merged[best]
            del parts[at + 1], links[at]
            if at:
                links[at - 1] = get(parts[at - 1] * size + own, _NONE)
            if at < len(links):
                links[at] = get(own * size + parts[at + 1], _NONE)
        return parts

    def merge_long(self, word: bytes) -> list[int]:
        """The same merges in n log n: linked parts and a heap of (rank, place)."""
        parts = [self.single[b] for b in word]
        n, get, size = len(parts), self.joined.get, self.size
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < n:
                rank = get(parts[at] * size + parts[after[at]])
                if rank is not None:
                    heapq.heappush(heap, (rank, at, parts[at], parts[after[at]]))

        for i in range(n):
            offer(i)
        while heap:
            rank, at, left, right = heapq.heappop(heap)
            if parts[at] != left or after[at] >= n or parts[after[at]] != right:
                continue
            gone = after[at]
            parts[at] = self.merged[rank]
            parts[gone] = -1
            after[at] = after[gone]
            if after[at] < n:
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [p for p in parts if p >= 0]

    def _packed(self, raw: bytes) -> bytes:
        if len(raw) <= LONG_WORD:
            merged = self.merge_short(raw)
            return _PACKED[len(merged)](*merged)
        merged = self.merge_long(raw)
        return struct.pack(f"<{len(merged)}I", *merged)

    def word(self, word: str) -> bytes:
        """The word's ids as little-endian 32-bit integers."""
        raw = word.encode()
        packed = self._packed(raw)
        if len(raw) <= LONG_WORD:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[word] = packed
        return packed

    def _words(self, text: str) -> list[bytes]:
        get, word = self.cache.get, self.word
        return [get(w) or word(w) for w in self.words.findall(text)]

    def _piece(self, piece: str) -> bytes | None:
        """Ids of a space and the piece; None if it starts or ends with white space."""
        packed = self.older.get(piece)
        if packed is None:
            if piece[0].isspace() or piece[-1].isspace():
                return None
            # Pieces of several words stay out of the cache, which holds each word once.
            core = piece.rstrip(SIGNS) if piece.isascii() else ""
            if not core.isalpha():
                words = self._words(" " + piece)
                if len(words) > 1:
                    return b"".join(words)
                packed = words[0]
            elif len(core) < len(piece):  # a word and signs, without asking the pattern
                signs = piece[len(core):]
                return ((self.pieces.get(core) or self._piece(core))
                        + (self.cache.get(signs) or self.word(signs)))
            else:
                packed = self._packed(b" " + piece.encode())
        if len(piece) <= LONG_WORD:
            if len(self.pieces) >= CACHE_WORDS:
                self.older = dict(self.pieces)  # what is still in use comes back from here
                self.pieces.clear()
            self.pieces[piece] = packed
        return packed

    def _plain(self, text: str, out: list[bytes]) -> None:
        """A word never reaches over a space between two other characters, so
        such a text is cut there first, which is far cheaper than the pattern."""
        first, *pieces = text.split(" ")
        if first and pieces and all(pieces) and not first[-1].isspace():
            get, piece = self.pieces.get, self._piece
            last = pieces.pop()
            packed = [get(p) or piece(p) for p in pieces]
            # The last one may end with white space, as nothing follows it.
            if None not in packed and not last[0].isspace():
                out += self._words(first)
                out += packed
                out += self._words(" " + last)
                return
        out += self._words(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        if self.cut is None or not any(s in text for s in self.specials):
            self._plain(text, out)
            return b"".join(out)
        at = 0
        for found in self.cut.finditer(text):
            self._plain(text[at:found.start()], out)
            out.append(np.asarray([self.specials[found.group()]], "<u4").tobytes())
            at = found.end()
        self._plain(text[at:], out)
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        """The text of the ids, special tokens included."""
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def load(path: str) -> Codec:
    """A codec from a vocabulary file; read once in a worker."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = byte_letters()
    ids = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()
           if all(c in letters for c in token)}
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [b""] * (max([*ids.values(), *specials.values()]) + 1)
    for token, i in ids.items():
        tokens[i] = token
    for token, i in specials.items():
        tokens[i] = token.encode()

    def ranks() -> Iterator[tuple[int, int, int]]:
        for pair in spec["model"]["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right = (bytes(letters[c] for c in x) for x in (a, b))
            yield ids[left], ids[right], ids[left + right]

    return Codec(ids, ranks(), tokens, specials)


def encoded(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
            vocabulary: str | None = None, with_ids: bool = True) -> DataFrame:
    """Ids and decoded text of every document.

    Returns doc_id, ids (array of int; left out without ``with_ids``), n_tokens,
    ids_sha256 and decoded_sha256.  ``vocabulary`` is a path that every
    executor can read.
    """
    path = vocabulary or default_vocabulary()
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path)
        for batch in in_slices(batches, SLICE):
            packed = [codec.encode(t.as_py() or "") for t in batch.column(1)]
            columns = [
                batch.column(0), pa.array([len(p) // 4 for p in packed], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                pa.array([hashlib.sha256(codec.decode(p).encode()).hexdigest()
                          for p in packed])]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                offsets = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype("int32")
                values = np.frombuffer(b"".join(packed), "<i4")
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return (docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
            .mapInArrow(run, schema + ", ids array<int>" * with_ids))


def decoded(ids: DataFrame, ids_column: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """Add ``decoded`` to a table of ids; null ids give null."""
    path = vocabulary or default_vocabulary()

    @F.pandas_udf("string")
    def text(column):
        codec = load(path)
        return column.map(lambda x: None if x is None else codec.decode(
            np.asarray(x, "<u4").tobytes()))

    return ids.withColumn("decoded", text(F.col(ids_column)))
