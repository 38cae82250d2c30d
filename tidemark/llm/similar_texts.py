"""Near copies of texts: SimHash fingerprints compared in tiles propose pairs, exact shingle similarity decides.

Texts of equal words are one node. A node has a wide SimHash of its distinct five-word shingles. Two sets of similarity 0.8
differ in each bit with a chance of about acos(8/9) / pi = 0.15, a little more for few shingles. Nodes that agree in one of
the fingerprint's bands meet; the number of bands is such that a pair of similarity 0.8 misses all with a chance of MISS, and
a band has as many bits as keep the nodes of a band value few. All nodes of a band value are compared by the first 128 bits,
in tiles sorted by population count, as exact comparison does for 64 bits. A pair whose sets differ in size by more than a
quarter can't reach 0.8 and is none.

Exact Jaccard similarity of the texts' shingles decides each pair that their odd sketches (512 bits, each flipped by every
shingle that falls on it, so that two of them tell the size of the symmetric difference) leave in question. First, the nodes of a band value are covered by stars,
whose centre is the node with most near ones, so a group of thousands of near copies costs one comparison for each. Then
all near pairs of a band value that the first round left in different components are compared, so none is left out.

Defined cases: texts without words (null, empty, white space) are copies of each other; fewer words than a shingle are one
shingle; rows equal in key and text stay once; a null key comes after all others; an empty table gives an empty result;
other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tidemark.llm.common import blocks, drop_written, join_found, kept, unused, written
from tidemark.llm.simhash import components, grouped, near_tiles, shingle_hashes

SHINGLE = 5
LEAST = 0.8
SEED = 42
#: Chance that a pair of the least similarity meets in no band.
MISS = 0.001
#: Chance that a bit of two such fingerprints differs: 0.15 for many shingles, somewhat more for few.
FLIP = 0.165
#: Bits of the fingerprint by which nodes that meet are compared, and the distance that a pair of similarity 0.8 has at most (3.5 deviations over the mean).
WORDS = 2
RADIUS = math.ceil(64 * WORDS * FLIP + 3.5 * math.sqrt(64 * WORDS * FLIP * (1 - FLIP)))
#: Bits of an odd sketch; it follows the fingerprint's bits in the column `wide`.
ODD = 512
#: Nodes of a band value that one task holds.
HOT = 4000


def band_plan(rows: int) -> tuple[int, int]:
    """(bits of a band, number of bands) for about `rows` nodes: some 32 to 64 unrelated nodes share a band value."""
    bits = max(8, math.ceil(math.log2(max(rows, 2))) - 6)
    return bits, math.ceil(math.log(MISS) / math.log(1 - (1 - FLIP) ** bits))


def _lanes(words: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 63, words, np.uint64) << np.uint64(1) | np.uint64(1)


def wide_simhash(hashes: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    """64 bits for each lane: 1 if set in over half of the hashes as that lane mixes them."""
    total = np.zeros(64 * len(lanes), np.int64)
    for i in range(0, len(hashes), 255):  # sums of 255 bits fit a byte
        x = hashes[i : i + 255, None] * lanes
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(29)
        total += np.add.reduce(np.unpackbits(x.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return total * 2 > len(hashes)


def words_and_node(text: str) -> tuple[str, int]:
    """The words with one blank between them, A-Z lower-cased, and a signed 64-bit digest of them."""
    joined = b" ".join(text.encode().lower().split())
    return joined.decode(), int.from_bytes(hashlib.md5(joined).digest()[:8], "little", signed=True)


def sketches(docs: DataFrame, plan: tuple[int, int], shingle: int = SHINGLE) -> DataFrame:
    """id, text_key and node for each row of (id, text); bands, size (distinct shingles) and wide for the first row of a node in its task, else null."""
    bits, bands = plan
    lanes = _lanes(max(WORDS, -(-bits * bands // 64)))
    schema = docs.select("id").schema.add("text_key", "binary").add("node", "long").add("bands", ArrayType(LongType())).add("size", "integer").add("wide", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        weights, numbers = 1 << np.arange(bits), np.arange(bands) << 32
        for batch, texts in blocks(batches):
            nodes, found, sizes, prints = [], [], [], []
            for x in texts:
                words, node = words_and_node(x)
                nodes.append(node)
                if node in seen:
                    found.append(None)
                    sizes.append(None)
                    prints.append(None)
                    continue
                seen.add(node)
                hashes = np.unique(np.array(shingle_hashes(words, shingle), np.uint64))
                on = wide_simhash(hashes, lanes)
                sizes.append(len(hashes))
                found.append(numbers | on[: bits * bands].reshape(bands, bits) @ weights if words else [])
                odd = np.bincount((hashes & np.uint64(ODD - 1)).astype(int), minlength=ODD) & 1 == 1
                prints.append(np.packbits(np.concatenate((on[: 64 * WORDS], odd)), bitorder="little").tobytes())
            keys = [hashlib.md5(x.encode()).digest() for x in texts]
            yield pa.RecordBatch.from_arrays(
                [*kept(batch, ["id"]), pa.array(keys, pa.binary()), pa.array(nodes, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(sizes, pa.int32()), pa.array(prints, pa.binary())],
                names=schema.names,
            )

    return docs.mapInArrow(run, schema)


def reachable(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray, least: float) -> np.ndarray:
    """Whether the odd sketches of two sets allow a similarity of `least`, for each row.

    Their difference never exceeds the sets' symmetric difference; where that is large it stays below, by chance within the
    limit taken here (4 deviations).
    """
    most = np.floor((a_size + b_size) * ((1 - least) / (1 + least)) + 1e-9)
    mean = ODD / 2 * (1 - np.exp(-2 * most / ODD))
    limit = np.minimum(most, mean + 4 * np.sqrt(ODD / 4 * (1 - np.exp(-4 * most / ODD))))
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.uint16) <= limit


def near_pairs(prints: np.ndarray, counts: np.ndarray, sizes: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows within the radius whose sizes allow a similarity of `least`; prints are sorted by population count."""
    first, second = [], []
    for i, j, near in near_tiles(prints, counts, RADIUS):
        p, q = np.nonzero(np.triu(near, 1) if i == j else near)
        p, q = p + i, q + j
        fit = np.minimum(sizes[p], sizes[q]) >= least * np.maximum(sizes[p], sizes[q])
        first.append(p[fit])
        second.append(q[fit])
    return (np.concatenate(first), np.concatenate(second)) if first else (np.zeros(0, int), np.zeros(0, int))


def stars(n: int, p: np.ndarray, q: np.ndarray, nodes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(centre, row): each row with a near one is a centre or has a centre; rows with most near ones (to a power of two) are centres first.

    Among those the least of `nodes` comes first (the first row, without them), so that the bands of one large group choose the same centres and give the same pairs.
    """
    nodes = np.arange(n) if nodes is None else nodes
    a, b = np.concatenate((p, q)), np.concatenate((q, p))
    order = np.argsort(a, kind="stable")
    b, degree = b[order], np.bincount(a, minlength=n)
    ends = np.cumsum(degree)
    free, centres, rows = degree > 0, [], []
    for c in np.lexsort((nodes, -np.frexp(degree)[1]))[: int(free.sum())].tolist():
        if free[c]:
            own = b[ends[c] - degree[c] : ends[c]]
            free[c] = False
            taken = own[free[own]]
            if not len(taken):  # all its near ones have centres; it joins one of them
                taken = own[:1]
            free[taken] = False
            centres.append(np.full(len(taken), c))
            rows.append(taken)
    return (np.concatenate(centres), np.concatenate(rows)) if rows else (np.zeros(0, int), np.zeros(0, int))


def _words(column: pa.ChunkedArray | pa.Array, words: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, words)


def _by_group(table: pa.Table, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of the table, their prints, population counts, sizes) of each band value with several rows, sorted by population count."""
    sizes = table.column("size").to_numpy()
    counts = np.bitwise_count(prints).sum(axis=1)
    order, starts = grouped(table.column("band").to_numpy(), counts)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a > 1:
            rows = order[a:b]
            yield rows, prints[rows], counts[rows], sizes[rows]


def _cover(table: pa.Table, least: float) -> pa.Table:
    """Stars as pairs (u, v); rows of a band value with further near pairs come as (u, null, band)."""
    nodes, band = (table.column(c).to_numpy() for c in ("node", "band"))
    u, v, open_rows = [], [], []
    for rows, own, counts, sizes in _by_group(table, _words(table.column("print"), WORDS)):
        p, q = near_pairs(own, counts, sizes, least)
        if len(p):
            centre, row = stars(len(rows), p, q, nodes[rows])
            u.append(rows[centre])
            v.append(rows[row])
            if len(p) > len(row):
                open_rows.append(rows[np.unique(np.concatenate((p, q)))])
    u, v, more = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (u, v, open_rows))
    columns = {
        "u": pa.array(np.concatenate((nodes[u], nodes[more]))),
        "v": pa.concat_arrays([pa.array(nodes[v]), pa.nulls(len(more), pa.int64())]),
        "band": pa.concat_arrays([pa.nulls(len(u), pa.int64()), pa.array(band[more])]),
    }
    return pa.table(columns)


def _apart(table: pa.Table, least: float) -> pa.Table:
    """All near pairs of different labels whose odd sketches allow the similarity."""
    nodes, labels = table.column("node").to_numpy(), table.column("label").to_numpy()
    wide, size = _words(table.column("wide"), WORDS + ODD // 64), table.column("size").to_numpy()
    odd = wide[:, WORDS:]
    u, v = [], []
    for rows, own, counts, sizes in _by_group(table, wide[:, :WORDS]):
        if len(np.unique(labels[rows])) > 1:
            p, q = (rows[x] for x in near_pairs(own, counts, sizes, least))
            differ = labels[p] != labels[q]
            p, q = p[differ], q[differ]
            for i in range(0, len(p), 1 << 16):
                a, b = p[i : i + (1 << 16)], q[i : i + (1 << 16)]
                near = reachable(odd[a], odd[b], size[a], size[b], least)
                u.append(nodes[a[near]])
                v.append(nodes[b[near]])
    return pa.table([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (u, v)], names=["u", "v"])


def likely(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose odd sketches allow the similarity, each once, u < v."""
    pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    for side in ("u", "v"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.struct("size", F.substring("wide", 8 * WORDS + 1, ODD // 8).alias("odd")).alias(f"{side}_of")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = kept(batch, ["u_of", "v_of"])
                near = reachable(*(_words(x.field("odd"), ODD // 64) for x in (a, b)), *(x.field("size").to_numpy() for x in (a, b)), least)
                yield batch.select(["u", "v"]).filter(pa.array(near))

    return pairs.select("u", "v", "u_of", "v_of").mapInArrow(run, "u long, v long")


def _tiled(banded: DataFrame, rows: int, compare, schema: str, hot: int) -> DataFrame:
    """Apply compare to packs of whole band values; one with over `hot` nodes goes to a task for each pair of its parts.

    Crowded band values are told by a sixteenth of the nodes, which only decides how they are dealt: no row is left out.
    """
    part = 16 if rows > 16 * hot else 1
    some = banded.filter(F.pmod(F.xxhash64("node", F.lit(7)), F.lit(part)) == 0)
    crowded = written(some.groupBy("band").agg((F.count(F.lit(1)) * part).alias("count")).filter(F.col("count") > hot), "crowded", 1)
    met = banded.join(crowded, "band", "left")
    salts = F.coalesce(F.ceil(F.col("count") / float(hot)).cast("int"), F.lit(1))
    met = met.withColumn("s", F.pmod(F.xxhash64("node"), salts).cast("int")).withColumn("t", F.explode(F.sequence(F.lit(0), salts - 1)))
    packs = F.when(salts > 1, F.xxhash64("band", F.least("s", "t"), F.greatest("s", "t"))).otherwise(F.pmod(F.xxhash64("band"), F.lit(max(1, rows // 20_000))))
    return met.withColumn("pack", packs).drop("s", "t", "count").groupBy("pack").applyInArrow(lambda x: compare(x), schema)


def links(words: DataFrame, nodes: DataFrame, shingle: int = SHINGLE, least: float = LEAST, hot: int = HOT) -> DataFrame:
    """Edges (u, v) that connect all similar nodes which meet in a band; nodes has node, bands, size and wide."""
    banded = nodes.select("node", "size", F.substring("wide", 1, 8 * WORDS).alias("print"), F.explode("bands").alias("band"))
    rows = nodes.agg(F.sum(F.size("bands"))).first()[0] or 0
    covered = written(_tiled(banded, rows, lambda x: _cover(x, least), "u long, v long, band long", hot), "stars")
    first = similar_pairs(likely(covered.filter("v is not null").select("u", "v"), nodes, least), words, shingle, least)
    more = covered.filter("v is null").select(F.col("u").alias("node"), "band").distinct()
    if more.isEmpty():
        drop_written(covered)
        return first
    labels = components(first).withColumnRenamed("root", "label")
    more = written(more.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
    drop_written(covered)
    bands = more.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("band")
    apart = written(more.join(bands, "band", "left_semi").join(nodes.select("node", "size", "wide"), "node"), "open")
    drop_written(more)
    found = written(_tiled(apart, apart.count(), lambda x: _apart(x, least), "u long, v long", hot), "apart")
    drop_written(apart)
    return first if found.isEmpty() else first.unionByName(similar_pairs(found, words, shingle, least))


def node_words(docs: DataFrame) -> DataFrame:
    """node and words, once for each node of a task; docs has text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, texts in blocks(batches):
            found = {node: words for words, node in map(words_and_node, texts) if node not in seen}
            seen.update(found)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(found.values(), pa.string())], names=["node", "words"])

    return docs.select("text").mapInArrow(run, "node long, words string")


def similar_pairs(pairs: DataFrame, words: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs (u, v) of nodes whose texts' sets of shingles have a Jaccard similarity of `least` or more.

    words has node and words of all texts; only those of nodes in a pair are shuffled, each once.
    """
    pairs = chosen = written(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "pairs")
    rows = pairs.count()
    met = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    words = written(words.join(met, "node", "left_semi").dropDuplicates(["node"]), "words", codec="zstd")
    for side in ("u", "v"):
        pairs = join_found(pairs, words.select(F.col("node").alias(side), F.col("words").alias(f"{side}_words")), side, pairs.groupBy(side).count(), rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, set[int]] = {}

        def shingles(node: int, text: str) -> set[int]:
            if node not in held:
                if len(held) >= 64:
                    held.clear()
                held[node] = set(shingle_hashes(text, shingle))
            return held[node]

        for batch in batches:
            found = []
            for u, v, a, b in zip(*(x.to_pylist() for x in kept(batch, ["u", "v", "u_words", "v_words"])), strict=True):
                x, y = shingles(u, a), shingles(v, b)
                both = len(x & y)
                if both >= least * (len(x) + len(y) - both):
                    found.append((u, v))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

    found = written(pairs.select("u", "v", "u_words", "v_words").mapInArrow(run, "u long, v long"), "similar")
    drop_written(chosen)
    drop_written(words)
    return found


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, least: float = LEAST) -> DataFrame:
    """Rows of docs, one of each group that chains of near copies connect: the one of least key (null last), then least text digest."""
    plain = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = docs.count()
    prints = written(sketches(plain, band_plan(rows), shingle), "sketches")
    nodes = written(prints.filter("bands is not null").select("node", "bands", "size", "wide").dropDuplicates(["node"]), "nodes", codec="zstd")
    roots = components(links(node_words(plain), nodes, shingle, least))
    first = prints.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "text_key")).alias("best"))
    best = first.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best"))
    return rows_of(docs, prints, best.select("best.id", "best.text_key"), key, text)


def rows_of(docs: DataFrame, prints: DataFrame, chosen: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of docs that `chosen` names by id and text_key, each once; prints has id and text_key of all rows.

    Rows equal in key and text get a serial number within salted groups, so that copies by the million are no single task.
    """
    digest, mine, theirs = (unused(x, docs) for x in ("_digest", "_id", "_text_key"))
    keyed = docs.withColumn(digest, F.unhex(F.md5(F.coalesce(text, F.lit("")))))
    chosen = chosen.select(F.col("id").alias(mine), F.col("text_key").alias(theirs))
    found = keyed.join(chosen, F.col(key).eqNullSafe(F.col(mine)) & (F.col(digest) == F.col(theirs)), "left_semi")
    if prints.groupBy("id", "text_key").count().filter("count > 1").isEmpty():
        return found.drop(digest)
    salt = unused("_salt", docs)
    some = found.withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(64))).dropDuplicates([key, digest, salt])
    return some.dropDuplicates([key, digest]).drop(digest, salt)
