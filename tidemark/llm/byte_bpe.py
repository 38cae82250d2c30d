"""Byte-level BPE encoding and decoding in linear time.

Token bytes are mapped to Latin-1 characters and put in an Aho-Corasick automaton, which gives the longest token that
starts at every position. Encoding walks a pre-token from the left with the longest match and backtracks to the next
shorter prefix whenever the new token and the one before it could not stand side by side in a merge result. That test
depends on the two tokens alone and is memoised. Positions from which no encoding exists are remembered, so each is given
up once; the walk is linear in the pre-token's length. The one sequence of pairwise compatible tokens is what merging by
rank makes, so the ids equal those of the merge loop, which the tests run side by side.

Texts are cut at single spaces between non-space characters, which no pre-token crosses, and each part's ids are kept in a
bounded memo of its worker.

Defined cases: a null or empty text has no ids; any Unicode text is encoded whole; unpaired surrogates can't occur in a
Spark string; repeated rows give equal ids.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from tidemark.llm.common import blocks, kept, set_aside

#: White space as the pattern's `\s` means it; written out because engines differ on U+001C to U+001F and U+0085.
_WIDE = "".join(f"{chr(92)}u{x:04x}" for x in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
SPACE = r"\t-\r \x85\xa0" + _WIDE


def _pattern(letters: str, numbers: str) -> regex.Pattern:
    own = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{SPACE}{letters}{numbers}]").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")
    return regex.compile("(?V1)" + own.replace(r"\p{L}", letters).replace(r"\p{N}", numbers))


#: The tokenizer's pattern by this engine's tables of letters and numbers; texts with characters of _otherwise() need exact_pattern().
PATTERN = _pattern(r"\p{L}", r"\p{N}")


def _engine(kind: str) -> set[str]:
    """All characters of a class by the tables of the tokenizer library's own engine."""
    probe = tiktoken.Encoding("probe", pat_str=kind + "{1,64}", mergeable_ranks={bytes([k]): k for k in range(256)}, special_tokens={})
    return set(probe.decode(probe.encode_ordinary("".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000)))))))


@lru_cache(maxsize=1)
def _tables() -> dict[str, tuple[set[str], set[str]]]:
    """For letters and numbers: the characters that only this engine counts among them, and those that only the library's does."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    return {kind: (own - theirs, theirs - own) for kind in (r"\p{L}", r"\p{N}") for own, theirs in [(set(regex.findall(kind, every)), _engine(kind))]}


@lru_cache(maxsize=1)
def _otherwise() -> frozenset[str]:
    """Characters that the two engines class differently, for their tables are of different Unicode versions."""
    return frozenset().union(*(x for pair in _tables().values() for x in pair))


@lru_cache(maxsize=1)
def exact_pattern() -> regex.Pattern:
    """The pattern with the library's own letters and numbers."""

    def listed(chars: set[str]) -> str:
        codes, runs = sorted(map(ord, chars)), []
        for c in codes:
            if runs and c == runs[-1][1] + 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
        return "".join(f"{chr(92)}U{a:08x}-{chr(92)}U{b:08x}" for a, b in runs)

    def own(kind: str) -> str:
        less, more = map(listed, _tables()[kind])
        return f"[{f'[{kind}--[{less}]]' if less else kind}{more}]"

    return _pattern(own(r"\p{L}"), own(r"\p{N}"))


def pattern_for(text: str) -> regex.Pattern:
    """PATTERN where both engines agree on all characters of the text, else the exact one."""
    return PATTERN if text.isascii() or _otherwise().isdisjoint(set(text)) else exact_pattern()


_UNUSUAL = regex.compile(rf"[\x1c-\x1f\x85\xa0{_WIDE}]")
_LOOSE = regex.compile(r"[ \t-\r] | [ \t-\r]")
#: A single space between two characters that aren't white space.
_JOINT = regex.compile(rf"(?<=[^{SPACE}]) (?=[^{SPACE}])")
#: Entries of a worker's memos; a full memo starts anew.
MEMO = 500_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The plain merge loop: join the leftmost adjacent pair of lowest rank until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    return [ranks[x] for x in _merged(parts, ranks)]


def _merged(parts: list[bytes], ranks: dict[bytes, int]) -> list[bytes]:
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class ByteBpe:
    """Encoder and decoder for one table of ranks."""

    def __init__(self, path: str) -> None:
        self.ranks = load_ranks(path)
        size = max(self.ranks.values()) + 1
        self.bytes: list[bytes] = [b""] * size
        for b, i in self.ranks.items():
            self.bytes[i] = b
        # A token that its own bytes don't merge into can only be a whole pre-token, never a part of one.
        self.whole = [bool(b) and _merged([b[k : k + 1] for k in range(len(b))], self.ranks) == [b] for b in self.bytes]
        self.automaton = ahocorasick.Automaton()
        for b, i in self.ranks.items():
            if self.whole[i]:
                self.automaton.add_word(b.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.shorter = [self._prefix(b) for b in self.bytes]
        self.fit: dict[int, bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _prefix(self, b: bytes) -> int:
        """The longest proper prefix that is a token, or -1."""
        for k in range(len(b) - 1, 0, -1):
            i = self.ranks.get(b[:k], -1)
            if i >= 0 and self.whole[i]:
                return i
        return -1

    def fits(self, a: int, b: int) -> bool:
        """Do the bytes of a and b merge into just these two tokens?"""
        known = self.fit.get(a << 32 | b)
        if known is None:
            if len(self.fit) >= MEMO:
                self.fit.clear()
            x, y = self.bytes[a], self.bytes[b]
            joined = x + y
            known = self.fit[a << 32 | b] = _merged([joined[k : k + 1] for k in range(len(joined))], self.ranks) == [x, y]
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        found = self.ranks.get(piece)
        if found is not None:
            return [found]
        longest: list[int] = [-1] * len(piece)
        best = [0] * len(piece)
        size = self.bytes
        for end, i in self.automaton.iter(piece.decode("latin-1")):
            n = len(size[i])
            start = end - n + 1
            if n > best[start]:
                best[start], longest[start] = n, i
        out: list[int] = []
        open_at = bytearray(b"\x01") * (len(piece) + 1)
        at, token = 0, longest[0]
        while True:
            while token >= 0:
                end = at + len(size[token])
                if open_at[end] and (not out or self.fits(out[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                if at == len(piece):
                    return out
                token = longest[at]
            else:
                if not out:
                    raise ValueError("the ranks lack a token for a single byte")
                open_at[at] = 0
                token = out.pop()
                at -= len(size[token])
                token = self.shorter[token]

    def _encoded(self, piece: str) -> bytes:
        ids = self.encode_piece(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        found = self.parts.get(piece) or self.pieces.get(piece)
        if found is None:
            if len(self.pieces) >= MEMO // 2:
                self.pieces.clear()
            found = self._encoded(piece)
            if len(piece) < 64:
                self.pieces[piece] = found
        return found

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            if len(self.parts) >= MEMO:
                self.parts.clear()
            pieces = pattern_for(part).findall(part)
            found = self._encoded(part) if len(pieces) == 1 else b"".join(map(self._piece, pieces))
            if len(part) < 64:
                self.parts[part] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if _UNUSUAL.search(text) is None and _LOOSE.search(text) is None and text[0] != " " and text[-1] != " ":
            first, *rest = text.split(" ")
        else:
            first, *rest = _JOINT.split(text)
        get, part = self.parts.get, self._part
        return self._part(first) + b"".join([get(x) or part(x) for x in [" " + r for r in rest]])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str) -> ByteBpe:
    """One codec a worker and rank file."""
    return ByteBpe(path)


def encode_documents(docs: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Rows with the columns `keep` (all but text if not given) and the ids of the whole text as a binary column; an input column of its name becomes `<name>_input`."""
    docs = set_aside(docs, ids)
    rest = [c for c in docs.columns if c != text] if keep is None else keep
    schema = docs.select(*rest, docs[text].cast("binary").alias(ids)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(ranks_path)
        for batch, texts in blocks(batches, text):
            yield pa.RecordBatch.from_arrays([*kept(batch, rest), pa.array([coder.encode(x) for x in texts], pa.binary())], names=[*rest, ids])

    return docs.select(*dict.fromkeys([*rest, text])).mapInArrow(run, schema)


def encode_digest(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: n_tokens, ids_sha256 of the encoded ids, decoded_sha256 of the bytes that decoding these ids gives."""
    schema = docs.select(key).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, sha = codec(ranks_path), lambda b: hashlib.sha256(b).hexdigest()
        for batch, texts in blocks(batches, text):
            coded = [coder.encode(x) for x in texts]
            columns = [pa.array([len(x) // 4 for x in coded], pa.int64()), pa.array(map(sha, coded), pa.string()), pa.array([sha(coder.decode(x)) for x in coded], pa.string())]
            yield pa.RecordBatch.from_arrays([*kept(batch, [key]), *columns], schema=pa.schema([batch.schema.field(key), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]))

    return docs.select(key, text).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return encode_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
