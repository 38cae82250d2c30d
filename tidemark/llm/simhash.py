"""Near-duplicates by SimHash, linked by tiled exact comparison.

Fingerprints that differ in at most `radius` bits agree in at least one of radius + 1 bands of bits, so only fingerprints
with an equal band meet. The distinct fingerprints of each band value are sorted by population count and cut into tiles; tile
pairs whose population counts differ beyond the radius are skipped, the others are compared whole with exclusive-or and
bit counts. Each comparison hands on a spanning forest of its links, so a group of thousands of near copies costs one edge
for each member, and no link is lost. A band value with very many fingerprints is compared by many tasks, one for each
pair of tiles. Components come from alternating large-star and small-star steps, each written to the shared folder.

Defined cases: a text without words (null, empty, white space) has fingerprint zero and is linked like any other; fewer
words than a shingle are one shingle; repeated rows and equal texts have equal fingerprints and so one component; if a
component has no id but null, its component id is null; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, drop_written, join_found, kept, written

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Rows of a tile.
TILE = 256
#: A band value with more distinct fingerprints than this is dealt out over several tasks.
HOT = 20_000
_LANE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(text: str, shingle: int = SHINGLE, seed: int = SEED) -> list[int]:
    """XXH64 of each shingle, repeats included; A-Z are lower-cased."""
    words = text.encode().lower().split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [digest(joined, seed)]
    starts = list(accumulate([len(w) + 1 for w in words], initial=0))
    return [digest(joined[a : b - 1], seed) for a, b in zip(starts, starts[shingle:], strict=False)]


def simhash(hashes: list[int]) -> int:
    """A bit is 1 if it is set in over half of the hashes; 0 for none."""
    if not hashes:
        return 0
    lanes = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ _LANE for k in range(8)])
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """key, text_key (MD5 of the text, empty for null) and fingerprint as a signed 64-bit integer, for each row."""
    schema = docs.select(key).schema.add("text_key", "binary").add("fingerprint", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, text):
            prints = np.array([simhash(shingle_hashes(x, shingle, seed)) for x in texts], np.uint64).view(np.int64)
            keys = [hashlib.md5(x.encode()).digest() for x in texts]
            yield pa.RecordBatch.from_arrays([*kept(batch, [key]), pa.array(keys, pa.binary()), pa.array(prints)], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


class _Forest:
    """Labels of rows under unions of many pairs at once."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.label[i], self.label[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.label[self.label]
                if np.array_equal(up, self.label):
                    break
                self.label = up


def near_tiles(prints: np.ndarray, counts: np.ndarray, radius: int, tile: int = TILE) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, row, near or not) of each pair of tiles that may hold near rows; prints (one row of words each) are sorted by population count."""
    words = [np.ascontiguousarray(prints[:, k]) for k in range(prints.shape[1])]
    for i in range(0, len(prints), tile):
        high = int(counts[min(i + tile, len(prints)) - 1])
        for j in range(i, len(prints), tile):
            if int(counts[j]) - high > radius:
                break  # later tiles have still higher population counts
            apart = [np.bitwise_count(w[i : i + tile, None] ^ w[None, j : j + tile]) for w in words]
            yield i, j, (apart[0] if len(apart) == 1 else np.sum(apart, axis=0, dtype=np.uint16)) <= radius


def compare_tiles(prints: np.ndarray, counts: np.ndarray, forest: _Forest, at: int, radius: int, tile: int = TILE) -> None:
    """Link all rows of prints (sorted by population count; row 0 is row `at` of the forest) within the radius."""
    for i, j, near in near_tiles(prints[:, None], counts, radius, tile):
        p, q = np.nonzero(near)
        forest.join(p + (at + i), q + (at + j))


def grouped(group: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by group and population count, and where each group starts in it, with the end."""
    order = np.lexsort((counts, group))
    return order, np.concatenate(([0], np.flatnonzero(np.diff(group[order])) + 1, [len(group)])) if len(group) else np.zeros(1, int)


def linked_rows(group: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (child, parent) of the links between rows of the same group."""
    order, starts = grouped(group, np.bitwise_count(prints))
    prints = prints[order]
    counts, forest = np.bitwise_count(prints), _Forest(len(group))
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a > 1:
            compare_tiles(prints[a:b], counts[a:b], forest, a, radius)
    child = np.flatnonzero(forest.label != np.arange(len(group)))
    return prints[child], prints[forest.label[child]]


def _bands(fingerprint: Column, radius: int) -> Column:
    """Band number and value in one integer, for each of radius + 1 bands."""
    n = radius + 1
    cuts = [64 * k // n for k in range(n + 1)]
    return F.array(*(F.lit(k * (1 << 20)) + F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << b - a) - 1)) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))))


def links(nodes: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """Edges (u, v) between distinct fingerprints, v < u: a spanning forest of the links within each band value."""
    n = nodes.count()
    banded = nodes.select("fingerprint", F.explode(_bands(F.col("fingerprint"), radius)).alias("band"))
    crowded = written(banded.groupBy("band").count().filter(F.col("count") > hot), "bands", (radius + 1) * n // hot)
    packs = max(1, (radius + 1) * n // hot)

    def compare(table: pa.Table) -> pa.Table:
        child, parent = linked_rows(table.column("band").to_numpy(), table.column("fingerprint").to_numpy().view(np.uint64), radius)
        a, b = child.view(np.int64), parent.view(np.int64)
        return pa.table([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["u", "v"])

    plain = banded
    found = None
    if not crowded.isEmpty():
        plain = banded.join(crowded, "band", "left_anti")
        # Tiles of a crowded band value: its population counts, each in `salts` parts. A fingerprint meets every tile within the radius.
        tiled = banded.join(crowded.withColumn("salts", F.ceil(F.col("count") / (8.0 * hot)).cast("int")), "band")
        own, salt = F.bit_count("fingerprint"), F.pmod(F.xxhash64("fingerprint"), F.col("salts")).cast("int")
        other = F.explode(F.sequence(F.lit(-radius), F.lit(radius)))
        pairs = tiled.select("fingerprint", "band", "salts", own.alias("p"), salt.alias("s"), other.alias("d")).select("*", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("t"))
        me, it = F.struct(F.col("p"), F.col("s")), F.struct((F.col("p") + F.col("d")).alias("p"), F.col("t").alias("s"))
        pairs = pairs.select("fingerprint", "band", F.least(me, it).alias("lo"), F.greatest(me, it).alias("hi"))
        found = pairs.groupBy("band", "lo", "hi").applyInArrow(lambda t: compare(t), "u long, v long")
    packed = plain.withColumn("pack", F.pmod(F.xxhash64("band"), F.lit(packs)))
    small = packed.groupBy("pack").applyInArrow(lambda t: compare(t), "u long, v long")
    return (small if found is None else small.unionByName(found)).distinct()


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """node and root (its component's least node) of every node of an edge; edges are (u, v), about `rows` of them.

    Rounds go on until nothing changes; their number grows with the logarithm of the longest chain. Both sides of each join
    are dealt by a shuffle of their own, so that adaptive execution splits the edges of a node that has very many.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    e = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges", rows)
    now = state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.repartition("u").join(least.repartition("u"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.repartition("u").join(low.repartition("u"), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        last, e = e, written(small.filter("u <> v").distinct(), "edges", rows)
        drop_written(last)
        before, now = now, state(e)
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def rooted(per_print: DataFrame, rows: int, radius: int = RADIUS) -> DataFrame:
    """Append root, the fingerprint that names the component, to rows of distinct fingerprints."""
    nodes = written(per_print.select("fingerprint"), "nodes", rows)
    roots = components(links(nodes, radius), rows)
    return per_print.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """key, fingerprint and component_id (the least key reachable) for each row."""
    prints = written(fingerprints(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), "id", "text"), "prints")
    rows = prints.count()
    named = written(rooted(prints.groupBy("fingerprint").agg(F.min("id").alias("least")), rows, radius), "rooted", rows)
    first = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.repartition("root").join(first.repartition("root"), "root").select("fingerprint", "component_id")
    found = join_found(prints.select("id", "fingerprint"), named, "fingerprint", prints.groupBy("fingerprint").count(), rows)
    return found.select(F.col("id").alias(key), "fingerprint", "component_id")


def query(spark, sf_dir: str) -> DataFrame:
    rows = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
