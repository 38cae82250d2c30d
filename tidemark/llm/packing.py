"""Vector bin packing of tokenized examples.

An example has three sizes: tokens, segments (one a piece) and loss-bearing tokens (all but those of a prompt). Sequences
have a limit on each. The dot-product heuristic fills one sequence at a time: of the pieces that fit, it takes the one
whose sizes have the largest dot product with the room left, each dimension weighted by how scarce it is. When no whole
piece fits, the best one is cut at the room left. Examples longer than a sequence fill whole sequences first. Pieces of
equal sizes are interchangeable, so each choice is among the distinct sizes of a group.

Packing is local to a partition: groups of about 4 MB of text and at most 16,384 rows are packed as they stream by and the
open sequence goes on into the next group, so nothing is shuffled and memory is bounded. The last sequence of a partition is cut at powers of
two, which need no padding. A sequence id is the partition's number in the high bits and a count in the low ones.

Defined cases: a null or empty text is its end token alone; a text of any length is cut into as many pieces as needed; each
token lies in exactly one piece; repeated rows are packed once each; other columns are left out.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import blocks, kept

#: Id that ends each document.
END = 2
#: Shorter room than this is left as padding instead of cutting a piece for it.
LEAST_CUT = 16
#: Parts in the memo, half of them in each generation.
MEMO = 1_000_000
#: Letters beyond ASCII as the byte-level alphabet writes their UTF-8 bytes: bytes without a printable form follow U+0100.
_UNPRINTED = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD)]
_BYTES = {c: "".join(chr(256 + _UNPRINTED.index(b) if b in _UNPRINTED else b) for b in chr(c).encode()) for c in range(0x80, 0x100)}
#: Characters that can end a word before a full stop or comma.
_WORD = re.compile(r"[^\W_]")


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 512
    loss: int = 4096


class PartEncoder:
    """Ids of whole texts by a tokenizer that drops white space and marks word ends, with a memo of space-separated parts.

    The tokenizer's normalization and splitting never look across a space, so a text's ids are its parts' ids in a row. A
    full stop or comma between a letter and a space is a part of its own there too, unless normalization takes the letter
    apart into a letter and a mark, which goes with the stop. The memo has two generations: when the
    young one is full it becomes the old one, so parts in use stay known and the others go.
    """

    def __init__(self, path: str, memo: int = MEMO) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        self.limit = memo // 2
        self.stop = re.compile(rf"(?<=[^\W_{self._apart()}])([.,]) ")

    def _apart(self) -> str:
        """The letters and numbers that normalization makes more than one character of."""
        found = [c for c in map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x110000))) if _WORD.match(c)]
        normal = self.tokenizer.normalizer.normalize_str("|".join(found)).split("|") if self.tokenizer.normalizer else found
        return "".join(c for c, x in zip(found, normal, strict=True) if len(x) != 1)

    def _learn(self, parts: list[str]) -> None:
        """Put the ids of all parts into the young generation."""
        rest, known, model = [], self.young, self.tokenizer.model.tokenize
        for x in parts:
            if x.isalpha() and _latin(x):  # one word, which the model takes as it is but for case and bytes
                known[x] = _pack([t.id for t in model(x.lower().translate(_BYTES))])
            else:
                rest.append(x)
        for x, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            known[x] = _pack(e.ids)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.stop.sub(r" \1 ", (x.lower() if _latin(x) else x).replace("\n", " ")).split(" ") for x in texts]
        missing = set().union(*split).difference(self.young)
        if missing:
            if len(self.young) + len(missing) > self.limit:
                self.old, self.young = self.young, {"": b""}
                missing = set().union(*split).difference(self.young)
            known = missing.intersection(self.old)
            self.young.update(zip(known, map(self.old.__getitem__, known)))
            self._learn(list(missing.difference(known)))
        get = self.young.__getitem__
        return [b"".join(map(get, parts)) for parts in split]


def _pack(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


def _latin(x: str) -> bool:
    """Only characters up to U+00FF? Then lower-casing and composition never change their number."""
    try:
        x.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=2)
def encoder(path: str) -> PartEncoder:
    return PartEncoder(path)


@dataclass
class Piece:
    """Tokens [start, start + length) of an example of `tokens` tokens whose first `prompt` carry no loss."""

    example: object
    start: int
    length: int
    prompt: int = 0

    @property
    def sizes(self) -> tuple[int, int, int]:
        end = self.start + self.length
        return self.length, 1, max(0, end - max(self.start, self.prompt))

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return Piece(self.example, self.start, length, self.prompt), Piece(self.example, self.start + length, self.length - length, self.prompt)


def powers(pieces: list[Piece]) -> list[list[Piece]]:
    """A sequence cut into sequences whose lengths are its length's powers of two, the largest first."""
    left, out = sum(p.length for p in pieces), []
    queue = pieces[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out.append([])
        while room:
            p = queue.pop()
            if p.length > room:
                p, rest = p.cut(room)
                queue.append(rest)
            out[-1].append(p)
            room -= p.length
    return out


def pack(pieces: list[Piece], limits: Limits = Limits()) -> tuple[list[list[Piece]], list[Piece]]:
    """Full sequences, and the pieces of the last, still open one."""
    cap = np.array([limits.tokens, limits.segments, limits.loss], np.float64)
    done: list[list[Piece]] = []
    todo: list[Piece] = []
    for p in pieces:
        while p.length >= limits.tokens and min(p.cut(limits.tokens)[0].sizes[2], limits.tokens) <= limits.loss:
            whole, p = p.cut(limits.tokens)
            done.append([whole])
        if p.length:
            todo.append(p)
    rooms = _Classes(todo, cap)
    current: list[Piece] = []
    room = cap.copy()
    while rooms.left:
        p = rooms.take(room)
        if p is not None:
            current.append(p)
            room -= p.sizes
            continue
        space = int(min(room[0], room[2]))
        if space >= LEAST_CUT and room[1] >= 1:
            part, rest = rooms.take(room, whole=False).cut(space)
            current.append(part)
            rooms.add(rest)
        done.append(current)
        current, room = [], cap.copy()
    return done, current


class _Classes:
    """Pieces by their distinct sizes, and the choice of the best one for a room."""

    def __init__(self, pieces: list[Piece], cap: np.ndarray) -> None:
        self.cap, self.left, self.n = cap, 0, 0
        self.at: dict[tuple[int, int, int], int] = {}
        self.held: list[list[Piece]] = []
        self.sizes = np.empty((64, 3))
        for p in pieces:
            self.add(p)
        counts = np.array([len(x) for x in self.held], np.float64)
        scarce = counts @ (self.sizes[: self.n] / cap)
        self.weight = scarce / max(scarce.sum(), 1e-9) / cap

    def add(self, p: Piece) -> None:
        k = self.at.get(p.sizes)
        if k is None:
            k = self.at[p.sizes] = self.n
            if self.n == len(self.sizes):
                self.sizes = np.concatenate((self.sizes, np.empty_like(self.sizes)))
            self.sizes[k] = p.sizes
            self.held.append([])
            self.n += 1
        self.held[k].append(p)
        self.left += 1

    def take(self, room: np.ndarray, whole: bool = True) -> Piece | None:
        """The piece of the largest dot product, of all or of those that fit whole; None if none does."""
        sizes = self.sizes[: self.n]
        score = sizes @ (self.weight * room / self.cap) + 1e-12
        if whole:
            score *= (sizes <= room).all(1)
        k = int(np.argmax(score)) if self.n else 0
        if not self.n or score[k] <= 0:
            return None
        p = self.held[k].pop()
        self.left -= 1
        if not self.held[k]:  # the last class moves into the empty one's place
            del self.at[p.sizes]
            self.n -= 1
            if k < self.n:
                self.sizes[k], self.held[k] = self.sizes[self.n], self.held[self.n]
                self.at[self.held[k][0].sizes] = k
            self.held.pop()
        return p


def _closed(sequence: list[Piece], limits: Limits) -> list[list[Piece]]:
    """A sequence with room for much more than a cut, which its segments or loss tokens closed, goes by powers of two."""
    return [sequence] if sum(p.length for p in sequence) > limits.tokens - LEAST_CUT else powers(sequence)


def pack_documents(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", prompt: str | None = None, limits: Limits = Limits(), end: int = END) -> DataFrame:
    """One row a piece: key, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    With `prompt`, the column of that name comes before the text and its tokens carry no loss.
    """
    schema = docs.select(key).schema
    for name, kind in (("start", "long"), ("length", "long"), ("ids", "binary"), ("doc_tokens", "long"), ("sequence_id", "long"), ("offset", "long")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        base = TaskContext.get().partitionId() << 32
        open_pieces: list[Piece] = []
        last = np.array([end], "<u4").tobytes()
        kind: list[pa.DataType] = []

        def rows(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal base
            out: list[tuple] = []
            for sequence in sequences:
                at = 0
                for p in sequence:
                    name, ids = p.example
                    out.append((name, p.start, p.length, ids[4 * p.start : 4 * (p.start + p.length)], len(ids) // 4, base, at))
                    at += p.length
                base += 1
            types = (kind[0], pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=schema.names)

        for batch, texts in blocks(batches, text):
            kind[:] = [batch.schema.field(key).type]
            heads = coder.encode_all([x or "" for x in batch.column(batch.schema.names.index(prompt)).to_pylist()]) if prompt else [b""] * len(texts)
            pieces = [Piece((name, head + body + last), 0, (len(head) + len(body)) // 4 + 1, len(head) // 4) for name, head, body in zip(kept(batch, [key])[0].to_pylist(), heads, coder.encode_all(texts), strict=True)]
            full, open_pieces = pack(open_pieces + pieces, limits)
            yield rows([s for f in full for s in _closed(f, limits)])
        if open_pieces:
            yield rows(powers(open_pieces))

    return docs.select(*dict.fromkeys([key, text, *([prompt] if prompt else [])])).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    pieces = pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
