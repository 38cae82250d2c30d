"""BPE encoding and decoding through a table of distinct words.

Texts are split into words (the tokenizer's pre-tokens, its special tokens among them) where they are read. A run of
documents with about BLOCK_CHARS characters is a block; each block gives a row per document, whose words are positions in
the block's list of distinct words, and that list. The lists of all blocks are dealt by the words' hash, so every distinct
word of the corpus meets in one part of the word table and is encoded there once, by the tokenizer itself. The ids go back
to the blocks and join the documents by position. Rows of documents are written bucketed by block, so they are never
shuffled: only lists of distinct words travel, packed and compressed, which also leaves a frequent word no more than one
entry a block.

Decoding joins the ids with the id-to-piece table. It has as many rows as the vocabulary, so it is broadcast, as one row
with an array in the order of ids, and each id of a document takes its piece by position. Pieces are bytes, held as Latin-1
characters; what they join to is read as UTF-8.

Defined cases: a null or empty text has no ids and decodes to an empty text; any Unicode text is encoded whole; a special
token's spelling in a text is that token, as in the tokenizers library; a document of any length is one block; repeated rows
give equal ids; other columns pass through, one with an output's name as `<name>_input`. Null ids decode to null, ids
outside the vocabulary to nothing.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType
from tokenizers import Tokenizer

from tidemark.llm.byte_bpe import pattern_for
from tidemark.llm.common import blocks, kept, scratch_path, set_aside, unused

#: Characters of a block's texts.
BLOCK_CHARS = 16 << 20
#: Bytes of distinct words that one part of the word table takes at most, before repeats between blocks are gone.
PART_BYTES = 64 << 20
#: Words that a gathering step handles at once.
GATHER_WORDS = 1 << 20
#: The tokenizer's byte alphabet: printable bytes stand for themselves, the others follow U+0100.
_UNPRINTED = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD)]
_BYTE_OF = {chr(b): b for b in range(256) if b not in _UNPRINTED} | {chr(256 + k): b for k, b in enumerate(_UNPRINTED)}


class Splitter:
    """Words of a text as the tokenizer of a file cuts it."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        cut = made["pre_tokenizer"] or {}
        added = made.get("added_tokens") or []
        if made.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("a tokenizer with a byte-level pre-tokenizer, without normalizer, prefix space and stripping special tokens is needed")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.names = tuple(names)

    def __call__(self, text: str) -> list[str]:
        find = pattern_for(text).findall
        if not any(n in text for n in self.names):
            return find(text)
        return [w for k, x in enumerate(self.special.split(text)) for w in ([x] if k % 2 else find(x))]


@lru_cache(maxsize=2)
def splitter(path: str) -> Splitter:
    return Splitter(path)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def _packed(items: list[bytes]) -> bytes:
    return zstandard.compress(np.array([len(items), *map(len, items)], "<u4").tobytes() + b"".join(items), 3)


def _unpacked(blob: bytes) -> list[bytes]:
    raw = zstandard.decompress(blob)
    n = int.from_bytes(raw[:4], "little")
    ends = (np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 * (n + 1)).tolist()
    return [raw[a:b] for a, b in zip([4 * (n + 1), *ends], ends, strict=False)]


def _slots(numbers: np.ndarray) -> bytes:
    """Rising numbers as compressed differences."""
    return zstandard.compress(np.diff(numbers, prepend=0).astype("<u4").tobytes(), 1)


def split_blocks(docs: DataFrame, path: str, text: str, size: int = BLOCK_CHARS) -> DataFrame:
    """Two kinds of rows a block: its documents (columns but text, `positions`) and one with its distinct words (`words`, their bytes in `word_bytes`)."""
    rest = [c for c in docs.columns if c != text]
    schema = docs.select(F.lit(0).cast("long").alias("block"), *(F.when(F.lit(True), docs[c]).alias(c) for c in rest)).schema
    schema = schema.add("positions", ArrayType(IntegerType())).add("words", "binary").add("word_bytes", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, part = splitter(path), TaskContext.get().partitionId() << 33
        known: dict[str, int] = {}
        block, held, types = part, 0, None

        def words() -> pa.RecordBatch:
            found = [w.encode() for w in known]
            row = [pa.array([block], pa.int64()), *(pa.nulls(1, t) for t in types), pa.nulls(1, pa.list_(pa.int32())), pa.array([_packed(found)], pa.binary()), pa.array([sum(map(len, found))], pa.int64())]
            return pa.RecordBatch.from_arrays(row, names=schema.names)

        for batch, texts in blocks(batches, text, limit=min(size, 4 << 20)):
            types = [c.type for c in kept(batch, rest)]
            if held and held + sum(map(len, texts)) > size:
                yield words()
                known, held, block = {}, 0, block + 1
            put, found, counts = known.setdefault, [], [0]
            for x in texts:
                for w in split(x):
                    found.append(put(w, len(known)))
                counts.append(len(found))
                held += len(x)
            positions = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(np.array(found, np.int32)))
            n = len(texts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), *kept(batch, rest), positions, pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())], names=schema.names)
        if known:
            yield words()

    return docs.select(*rest, text).mapInArrow(run, schema)


def deal_words(lists: DataFrame, parts: int) -> DataFrame:
    """Each block's distinct words by hash: block, part, slots (their positions in the block's list) and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = _unpacked(blob)
                of = np.fromiter((zlib.crc32(w) % parts for w in found), np.int64, len(found))
                order = np.argsort(of, kind="stable")
                ends = np.searchsorted(of[order], np.arange(parts + 1))
                rows = [(p, order[a:b]) for p, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if b > a]
                yield pa.RecordBatch.from_pydict({"block": [block] * len(rows), "part": pa.array([p for p, _ in rows], pa.int32()), "slots": [_slots(x) for _, x in rows], "words": [_packed([found[i] for i in x.tolist()]) for _, x in rows]})

    return lists.select("block", "words").mapInArrow(run, "block long, part int, slots binary, words binary")


def encode_words(dealt: DataFrame, path: str) -> DataFrame:
    """The word table's parts encode each distinct word once and answer every block's list: block, slots, ids (a binary for each word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[bytes, bytes] = {}
        for batch in batches:
            for block, slots, blob in zip(*(batch.column(batch.schema.names.index(n)).to_pylist() for n in ("block", "slots", "words")), strict=True):
                found = _unpacked(blob)
                new = [w for w in found if w not in table]
                for k in range(0, len(new), 10_000):
                    some = new[k : k + 10_000]
                    table.update(zip(some, (np.array(e.ids, "<u4").tobytes() for e in tokenizer(path).encode_batch_fast([w.decode() for w in some], add_special_tokens=False)), strict=True))
                yield pa.RecordBatch.from_pydict({"block": [block], "slots": [slots], "ids": [_packed([table[w] for w in found])]})

    return dealt.mapInArrow(run, "block long, slots binary, ids binary")


def encode_documents(docs: DataFrame, path: str, text: str = "text", block_chars: int = BLOCK_CHARS, digest: bool = False) -> DataFrame:
    """docs without text, with the ids of the whole text as array<int> in `ids`; with `digest` also n_tokens and ids_sha256 (of little-endian unsigned 32-bit ids)."""
    docs = set_aside(docs, "ids", "block", "positions", "words", "word_bytes", *(("n_tokens", "ids_sha256") if digest else ()))
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tidemark_words_{uuid.uuid4().hex}"
    split_blocks(docs, path, text, block_chars).write.bucketBy(parts, "block").option("path", scratch_path(spark, "words")).option("compression", "zstd").saveAsTable(name)
    table = spark.table(name)
    lists = table.filter(F.col("words").isNotNull())
    size = lists.agg(F.sum("word_bytes")).first()[0] or 0
    dealt = deal_words(lists, max(parts, -(-size // PART_BYTES)))
    answers = encode_words(dealt.repartition(max(parts, -(-size // PART_BYTES)), "part"), path)
    rest = [c for c in docs.columns if c != text]
    schema = docs.select(*(F.when(F.lit(True), docs[c]).alias(c) for c in rest)).schema.add("ids", ArrayType(IntegerType()))
    if digest:
        schema = schema.add("n_tokens", "long").add("ids_sha256", "string")

    def gather(documents: pa.Table, answered: pa.Table) -> pa.Table:
        slots, ids = [], []
        for a, b in zip(answered.column("slots").to_pylist(), answered.column("ids").to_pylist(), strict=True):
            slots.append(np.cumsum(np.frombuffer(zstandard.decompress(a), "<u4"), dtype=np.int64))
            ids += _unpacked(b)
        at = np.concatenate(slots) if slots else np.zeros(0, np.int64)
        sizes, starts = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        sizes[at] = lengths
        starts[at] = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        out = []
        for chunk in documents.combine_chunks().to_batches(max_chunksize=256):
            column = chunk.column(chunk.schema.names.index("positions"))
            ends, words = column.offsets.to_numpy().astype(np.int64) - column.offsets[0].as_py(), column.flatten().to_numpy(zero_copy_only=False)
            values = [np.zeros(0, np.int32)]
            for k in range(0, len(words), GATHER_WORDS):
                w = words[k : k + GATHER_WORDS]
                n = sizes[w]
                values.append(flat[np.repeat(starts[w] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
            offsets = np.concatenate([[0], np.cumsum(sizes[words])])[ends]
            found = np.concatenate(values)
            columns = [*kept(chunk, rest), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found))]
            if digest:
                own = found.astype("<u4")
                columns += [pa.array(np.diff(offsets)), pa.array([hashlib.sha256(own[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.string())]
            out.append(pa.RecordBatch.from_arrays(columns, names=schema.names))
        return pa.Table.from_batches(out)

    rows = table.filter(F.col("words").isNull()).select("block", *rest, "positions")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(gather, schema)


def piece_table(spark, path: str) -> DataFrame:
    """The vocabulary as rows: id (from 0 without a gap), piece (its bytes as Latin-1 characters)."""

    def latin(piece: str) -> str:
        own = [_BYTE_OF.get(c, -1) for c in piece]
        return (bytes(own) if -1 not in own else piece.encode()).decode("latin-1")

    found = {i: latin(p) for p, i in tokenizer(path).get_vocab(with_added_tokens=True).items()}
    return spark.createDataFrame([(i, found.get(i, "")) for i in range(max(found) + 1)], "id int, piece string")


def decode_documents(coded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """coded with the text of its ids, special tokens included; bytes that aren't UTF-8 become U+FFFD."""
    pieces = unused("_pieces", coded)
    spelled = F.array_join(F.transform(ids, lambda i: F.coalesce(F.get(pieces, i), F.lit(""))), "")
    table = piece_table(coded.sparkSession, path).agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "piece"))), lambda x: x["piece"]).alias(pieces))
    joined = coded.join(F.broadcast(table))  # one row, as large as the vocabulary
    return joined.withColumn(text, F.make_valid_utf8(F.encode(spelled, "ISO-8859-1").cast("string"))).drop(pieces)


def encode_digest(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per row: n_tokens, ids_sha256 of the ids (little-endian unsigned 32-bit), decoded_sha256 of the text that decoding them gives."""
    decoded = decode_documents(encode_documents(docs.select(key, text), path, text, block_chars, digest=True), path)
    return decoded.select(key, "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return encode_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
