"""Removal of passages that repeat anywhere in the corpus.

Every window of `width` consecutive words of a document has a Rabin-Karp hash: prefix sums over word hashes modulo 2^64,
so a window costs two array reads. The hashes of a unit of documents (about 4 MB of text) are dealt by hash range to
buckets, one packed row for each unit and bucket, and each bucket counts them across the whole corpus in Spark. A unit
sends each of its hashes once, so a passage that a third of all documents hold reaches its bucket as one hash a unit.
Buckets answer with a bit for each hash sent; units turn the windows found repeated into maximal intervals of words, keyed
by the digest of the text, and the texts are joined with their intervals and cut.

A window is judged on the input, never on what is left. Windows are equal if their 64-bit hashes are; at 10^10 windows
about one in 10^9 is taken for a repeat by chance.

Defined cases: a null text stays null with no words; texts of fewer words than a window are never cut; equal texts repeat
each other, so copies lose all words that a window covers, in all rows; rows with equal or null ids are told apart by
their text alone; an empty table gives an empty result; further columns pass through, one named n_words or n_removed as
`n_words_input` or `n_removed_input`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROWS_PER_FILE, blocks, join_found, set_aside, unused, words_of, written

WIDTH = 35
#: Windows that one bucket counts at a time, about.
BUCKET_WINDOWS = 1_000_000
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95
#: Bytes hashed at once; arrays of this length stay in cache.
_STEP = 1 << 20


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n; base is odd."""
    def rising(b: int) -> np.ndarray:
        x = np.full(n, b, np.uint64)
        x[0] = 1
        return np.multiply.accumulate(x)

    return rising(base), rising(pow(base, -1, 1 << 64))


def _power_arrays(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(base, 1 << max(16, (n - 1).bit_length()))
    return up[:n], down[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in data, and the byte at which each starts."""
    hashes, starts = [], []
    at = 0
    while at < len(data):
        stop = min(len(data), at + _STEP)
        while stop < len(data):  # cut at a separator
            seps = np.flatnonzero(_SEPARATOR[np.frombuffer(data, np.uint8, stop - at, at)])
            if len(seps):
                stop = at + int(seps[-1]) + 1
                break
            stop = min(len(data), stop + _STEP)
        b = np.frombuffer(data, np.uint8, stop - at, at)
        edge = np.diff(np.concatenate(([True], _SEPARATOR[b], [True])).astype(np.int8))
        first, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = _power_arrays(_BYTE_BASE, len(b))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE_VALUE[b] * up, dtype=np.uint64)))
        hashes.append(_mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64)))
        starts.append(first + at)
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of each window of `width` word hashes."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    up, down = _power_arrays(_WORD_BASE, len(words))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up, dtype=np.uint64)))
    n = len(words) - width + 1
    return _mix((sums[width:] - sums[:n]) * down[:n])


def intervals(starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals [first, end) of words covered by the windows that begin at the sorted starts."""
    if not len(starts):
        return starts, starts
    breaks = np.flatnonzero(np.diff(starts) > width)
    return starts[np.concatenate(([0], breaks + 1))], starts[np.concatenate((breaks, [len(starts) - 1]))] + width


def _unit_rows(unit: int, texts: list[str], width: int, n_buckets: int) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
    """(bucket, unit, hashes in window order, hashes that repeat within the unit, -) and one row of the unit's layout."""
    windows, counts, keys = [], [], []
    for text in texts:
        raw = text.encode()
        found = window_hashes(word_hashes(raw)[0], width)
        if len(found):
            windows.append(found)
            counts.append(len(found))
            keys.append(hashlib.md5(raw).digest())
    if not windows:
        return
    h = np.concatenate(windows)
    kind = np.uint16 if n_buckets < 0xFFFF else np.uint32
    bucket = ((h >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(kind)
    values, first, times = np.unique(h, return_index=True, return_counts=True)
    alone = np.zeros(len(h), bool)
    alone[first[times == 1]] = True
    again = values[times > 1]
    sent, repeated = np.flatnonzero(alone), ((again >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(kind)
    order = sent[np.argsort(bucket[sent], kind="stable")]
    cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    cuts2 = np.searchsorted(repeated, np.arange(n_buckets + 1))  # `again` is sorted by hash, so by bucket too
    h = h[order]
    for b in range(n_buckets):
        if cuts[b] < cuts[b + 1] or cuts2[b] < cuts2[b + 1]:
            yield b, unit, h[cuts[b] : cuts[b + 1]].tobytes(), again[cuts2[b] : cuts2[b + 1]].tobytes(), b""
    layout = np.where(alone, bucket, np.iinfo(kind).max).astype(kind)
    head = np.array([len(counts), *counts], np.int64).tobytes()
    yield n_buckets + unit % n_buckets, unit, head, b"".join(keys), layout.tobytes()


def _batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r if isinstance(x, bytes)) + 64
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


_SENT = pa.schema([("bucket", pa.int64()), ("unit", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_ANSWER = pa.schema([("unit", pa.int64()), ("bucket", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_FOUND = pa.schema([("text_key", pa.binary()), ("first", pa.list_(pa.int32())), ("end", pa.list_(pa.int32()))])


def repeated_intervals(docs: DataFrame, size: int, text: str = "text", width: int = WIDTH, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """text_key (MD5 of the text), and the word intervals [first, end) to remove, for each distinct text that has any.

    size is the texts' number of bytes; the number of buckets follows it.
    """
    n_buckets = max(8, -(-size // (6 * bucket_windows)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        yield from _batches((r for k, (_, texts) in enumerate(blocks(batches, text)) for r in _unit_rows((part << 32) + k, texts, width, n_buckets)), _SENT)

    def count(key: tuple, table: pa.Table) -> pa.Table:
        units, a, b = (table.column(n).to_pylist() for n in ("unit", "a", "b"))
        if key[0].as_py() >= n_buckets:  # layouts pass through to their units
            return pa.table([table.column("unit"), pa.array([-1] * len(units), pa.int64()), table.column("a"), table.column("b"), table.column("c")], schema=_ANSWER)
        hashes = [np.frombuffer(x, np.uint64) for x in a]
        once = np.concatenate(hashes)
        known = np.frombuffer(b"".join(b), np.uint64)
        values, times = np.unique(np.concatenate((once, known, known)), return_counts=True)
        values = values[times > 1]
        rows = []
        for unit, h in zip(units, hashes, strict=True):
            if len(values) and len(h):
                hit = values[np.minimum(np.searchsorted(values, h), len(values) - 1)] == h
                if hit.any():
                    rows.append((unit, key[0].as_py(), np.packbits(hit).tobytes(), b"", b""))
        return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_ANSWER)], schema=_ANSWER)

    def merge(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket").to_pylist()
        a, b, c = (table.column(n).to_pylist() for n in ("a", "b", "c"))
        k = bucket.index(-1)
        head, keys = np.frombuffer(a[k], np.int64), b[k]
        layout = np.frombuffer(c[k], np.uint16 if n_buckets < 0xFFFF else np.uint32)
        flags = layout == np.iinfo(layout.dtype).max
        order = np.argsort(layout, kind="stable")
        ordered = layout[order]
        for i, x in enumerate(bucket):
            if x >= 0:
                at = order[np.searchsorted(ordered, x) : np.searchsorted(ordered, x, "right")]
                flags[at] = np.unpackbits(np.frombuffer(a[i], np.uint8), count=len(at)).astype(bool)
        out, at = {}, 0
        for d, n in enumerate(head[1 : 1 + head[0]]):
            starts = np.flatnonzero(flags[at : at + n])
            at += n
            if len(starts):
                out[keys[16 * d : 16 * d + 16]] = intervals(starts, width)
        return pa.table([pa.array(list(out), pa.binary()), *(pa.array([x[k] for x in out.values()], _FOUND.field(1).type) for k in (0, 1))], schema=_FOUND)

    sent = docs.select(text).filter(F.col(text).isNotNull()).mapInArrow(send, "bucket long, unit long, a binary, b binary, c binary")
    answers = sent.groupBy("bucket").applyInArrow(count, "unit long, bucket long, a binary, b binary, c binary")
    found = answers.groupBy("unit").applyInArrow(merge, "text_key binary, first array<int>, end array<int>")
    return found.groupBy("text_key").agg(F.min(F.struct("first", "end")).alias("cut")).select("text_key", "cut.first", "cut.end")


def cut_words(text: str, first: list[int], end: list[int]) -> tuple[str, int, int]:
    """The text without the words of the intervals, its number of words, and of those removed. Other white space stays."""
    raw = text.encode()
    n = len(raw.split())
    if not first:
        return text, n, 0
    starts = [m.start() for m in _WORD.finditer(raw)] + [len(raw)]
    kept, at = [], 0
    for a, b in zip(first, end, strict=True):
        kept.append(raw[at : starts[a]])
        at = starts[b]
    kept.append(raw[at:])
    return b"".join(kept).decode(), n, sum(end) - sum(first)


def remove_repeats(docs: DataFrame, text: str = "text", width: int = WIDTH) -> DataFrame:
    """All rows with text cut, and columns n_words (before) and n_removed."""
    docs = set_aside(docs, "n_words", "n_removed")
    key, first, end = (unused(x, docs) for x in ("_key", "_first", "_end"))
    keyed = docs.withColumn(key, F.unhex(F.md5(text)))
    counts = written(keyed.groupBy(key).agg(F.count(F.lit(1)).alias("count"), F.max(F.octet_length(text)).alias("bytes")), "texts", int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * ROWS_PER_FILE // 8)
    total = counts.agg(F.sum("count").alias("rows"), F.sum(F.col("count") * F.col("bytes")).alias("size")).first()
    rows = total["rows"] or 0
    found = written(repeated_intervals(docs, total["size"] or 0, text, width), "intervals", rows)
    rest = [c for c in docs.columns if c != text]
    schema = docs.select(*rest, text).schema.add("n_words", "long").add("n_removed", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in blocks(batches, text):
            at = batch.schema.names.index
            texts, starts, ends = (batch.column(at(c)).to_pylist() for c in (text, first, end))
            cut = [(None, 0, 0) if x is None else cut_words(x, a or [], b or []) for x, a, b in zip(texts, starts, ends, strict=True)]
            columns = [pa.array([r[k] for r in cut], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(at(c)) for c in rest), *columns], names=schema.names)

    found = found.select(F.col("text_key").alias(key), F.col("first").alias(first), F.col("end").alias(end))
    joined = join_found(keyed.select(*rest, text, key), found, key, counts, rows)
    return joined.select(*rest, text, first, end).mapInArrow(run, schema)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
g AS (SELECT rid, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT g.rid, i, md5(array_to_string(w[i : i + 34], ' ')) AS k FROM g JOIN d USING (rid)),
r AS (SELECT rid, i FROM h QUALIFY count(*) OVER (PARTITION BY k) > 1),
c AS (SELECT rid, list(DISTINCT i + o) AS gone FROM r, (SELECT unnest(range(0, 35)) AS o) GROUP BY rid),
p AS (SELECT rid, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS x FROM d),
k AS (SELECT p.rid, string_agg(x, ' ' ORDER BY j) AS kept FROM p LEFT JOIN (SELECT rid, unnest(gone) AS j FROM c) AS q USING (rid, j) WHERE q.rid IS NULL GROUP BY p.rid)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN c USING (rid) LEFT JOIN k USING (rid)
"""


def query(spark, sf_dir: str) -> DataFrame:
    left = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.array_join(words_of(F.col("text")), " "), 256).alias("kept_sha256"))
