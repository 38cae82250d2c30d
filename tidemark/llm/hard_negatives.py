"""Hard-negative mining by a vertical scan of columnar dimensions (branch and bound on decomposed vectors).

Vectors are scaled to whole numbers. Rows are packed into columnar blocks, one array a dimension, and written once. An anchor
reads a block's dimensions in the descending order of its own components' magnitude, some at a time. After each step every
candidate has a partial score, and the minimum and maximum of the unread columns bound what can still come; candidates whose
bounds can't reach a needed place leave the bitmap. What is left after the last dimension has its exact score, so nothing is
approximate.

Two scans answer the question. The first finds each anchor's positives: its best rows of the same label. The second finds,
for each anchor and positive, the best rows of other labels whose score lies in the positive's window; the windows and the
places taken so far shrink the bitmap. Blocks meet anchors in cells: a cell has about ROWS_PER_CELL rows and at most about
ANCHORS_PER_CELL anchors, so anchors are copied to each cell of rows, blocks only where there are more anchors than one
cell takes; no anchor meets rows outside an array step. Each cell returns at most k rows an anchor or window, which a window
function merges. The whole work is that of a stated query set against all rows.

Defined cases: a row takes no part if its id, label or vector is null, or a component is null, not finite or LARGEST or more
in magnitude (their products could leave a long); vectors of different lengths are compared as if the shorter had zeros;
an empty vector scores 0; ties go to the smaller id; rows that repeat an id are candidates each, never each other's positive,
and one of them (smallest label, then vector) is the anchor; an anchor without positives or a positive without negatives
gives no row; an empty table gives none; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

SCALE = 256
#: Largest magnitude of a component before scaling (2^18), so that sums over up to 2048 dimensions fit a long.
LARGEST = 1 << 18
BLOCK_ROWS = 4096
ROWS_PER_CELL = 65_536
ANCHORS_PER_CELL = 8192
#: Dimensions read before bounds are taken again.
STEP = 8
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these parts of its positive's, in hundredths.
LOW, HIGH = 30, 90


def scaled(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """Rows that take part: id, label, v (floor of the scaled components as array<int>)."""
    ok = F.forall(vector, lambda x: F.coalesce((F.abs(x.cast("double")) < LARGEST), F.lit(False)))  # neither null nor NaN nor infinite
    v = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    return rows.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & ok).select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), v.alias("v"))


def columnar_blocks(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Packed blocks: n rows, d dimensions, ids, labels and dims (the columns one after another), all as little-endian integers."""

    def pack(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        n, found = table.num_rows, table.column("v").combine_chunks()
        sizes = np.diff(found.offsets.to_numpy())
        d = int(sizes.max(initial=0))
        dims = np.zeros((n, d), "<i4")
        dims[np.arange(d) < sizes[:, None]] = found.flatten().to_numpy(zero_copy_only=False)
        row = {"n": [n], "d": [d], "ids": [table.column("id").to_numpy().astype("<i8").tobytes()], "labels": [table.column("label").to_numpy().astype("<i8").tobytes()], "dims": [np.ascontiguousarray(dims.T).tobytes()]}
        return pa.RecordBatch.from_pydict(row, schema=pa.schema([("n", pa.int32()), ("d", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("dims", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for k in range(0, batch.num_rows, block_rows):
                part = batch.slice(k, block_rows)
                if n + part.num_rows > block_rows:
                    yield pack(held)
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if held:
            yield pack(held)

    return vectors.select("id", "label", "v").mapInArrow(run, "n int, d int, ids binary, labels binary, dims binary")


class Block:
    """One columnar block, with its columns' extremes."""

    def __init__(self, row: dict) -> None:
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        self.dims = np.frombuffer(row["dims"], "<i4").reshape(row["d"], row["n"]).astype(np.int64)
        self.low, self.high = (self.dims.min(axis=1), self.dims.max(axis=1)) if row["d"] else (np.zeros(0, np.int64),) * 2
        self.most = int(max(np.abs(self.low).max(initial=0), np.abs(self.high).max(initial=0)))
        self.kinds: dict[type, np.ndarray] = {}

    def columns(self, most: int) -> np.ndarray:
        """The columns in the fastest type that holds every partial score with an anchor of this largest component exactly."""
        top = self.most * most * max(1, len(self.dims))
        kind = np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64
        if kind not in self.kinds:
            self.kinds[kind] = self.dims.astype(kind)
        return self.kinds[kind]


def vertical_scan(block: Block, anchor: np.ndarray, alive: np.ndarray, prune) -> tuple[np.ndarray, np.ndarray]:
    """The candidates that prune() left, as positions in the block, and their exact scores.

    prune(low, high) gets bounds of the alive candidates' scores and returns which of them stay.
    """
    d = min(len(anchor), len(block.dims))
    a = anchor[:d]
    order = np.argsort(-np.abs(a), kind="stable")
    columns = block.columns(int(np.abs(a).max(initial=0)))
    left_low = np.minimum(a * block.low[:d], a * block.high[:d])[order]
    left_high = np.maximum(a * block.low[:d], a * block.high[:d])[order]
    rest_low, rest_high = left_low.sum() - np.cumsum(left_low), left_high.sum() - np.cumsum(left_high)
    part = np.zeros(len(alive), np.int64)
    whole = len(alive) == block.dims.shape[1]
    for k in range(0, d, STEP):
        some = order[k : k + STEP]
        read = columns[some] if whole else columns[some[:, None], alive]
        part = part + (a[some].astype(columns.dtype) @ read).astype(np.int64)
        end = min(k + STEP, d) - 1
        stays = prune(part + rest_low[end], part + rest_high[end])
        if not stays.all():
            alive, part, whole = alive[stays], part[stays], False
            if not len(alive):
                break
    return alive, part


def _kth(values: np.ndarray, k: int, floor: int) -> int:
    """The k-th largest value, or floor if there are fewer or it is less."""
    return floor if len(values) < k else max(floor, int(np.partition(values, len(values) - k)[len(values) - k]))


#: Less than any score.
NONE = -(1 << 62)


class Best:
    """The k best (score, id) so far, higher scores first and smaller ids among equals."""

    def __init__(self, k: int, floor: int = NONE) -> None:
        self.k, self.floor = k, floor
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((i, -s))[: self.k]
        self.scores, self.ids = s[order], i[order]
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.scores[-1]))


def _cells(blocks: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, search, schema: str, rows_per_cell: int, anchors_per_cell: int, block_rows: int) -> DataFrame:
    """search(list of blocks, anchors table) over all cells: each block meets each anchor in exactly one."""
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    across = max(1, -(-n_rows // rows_per_cell), min(parts, -(-n_rows // block_rows)))  # smaller cells where that keeps more tasks busy
    down = max(1, -(-n_anchors // anchors_per_cell))
    at = F.monotonically_increasing_id()  # of scanned rows, so the same in each attempt: partition and number in it
    left = blocks.withColumn("row_cell", F.pmod(F.shiftright(at, 33) + at.bitwiseAND((1 << 33) - 1), F.lit(across))).withColumn("anchor_cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long"))))
    right = anchors.withColumn("anchor_cell", F.pmod(F.xxhash64("anchor_id"), F.lit(down))).withColumn("row_cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long"))))

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        return search([Block(r) for r in rows.select(["n", "d", "ids", "labels", "dims"]).to_pylist()] if found.num_rows else [], found.to_pylist())

    return left.groupBy("row_cell", "anchor_cell").cogroup(right.groupBy("row_cell", "anchor_cell")).applyInArrow(run, schema)


def _positives(blocks: list[Block], anchors: list[dict], k: int) -> pa.Table:
    out = {"anchor_id": [], "positive_id": [], "positive_score": []}
    for row in anchors:
        anchor, best = np.array(row["v"], np.int64), Best(k)
        for block in blocks:
            alive = np.flatnonzero((block.labels == row["label"]) & (block.ids != row["anchor_id"]))
            alive, scores = vertical_scan(block, anchor, alive, lambda low, high, best=best: high >= _kth(low, k, best.floor))
            best.add(scores, block.ids[alive])
        out["anchor_id"] += [row["anchor_id"]] * len(best.ids)
        out["positive_id"] += best.ids.tolist()
        out["positive_score"] += best.scores.tolist()
    return pa.table({n: pa.array(x, pa.int64()) for n, x in out.items()})


def _negatives(blocks: list[Block], anchors: list[dict], k: int, low_part: int, high_part: int) -> pa.Table:
    names = ("anchor_id", "positive_id", "positive_score", "place", "negative_id", "negative_score")
    out: dict[str, list] = {n: [] for n in names}
    for row in anchors:
        anchor = np.array(row["v"], np.int64)
        windows = [(p, -(-low_part * p["positive_score"] // 100), high_part * p["positive_score"] // 100) for p in row["positives"]]
        bests = [(Best(k, least), least, most) for _, least, most in windows]

        def prune(low: np.ndarray, high: np.ndarray, bests=bests) -> np.ndarray:
            stays = np.zeros(len(low), bool)
            for best, least, most in bests:
                if least <= most:
                    inside = low[(low >= least) & (high <= most)]
                    stays |= (high >= _kth(inside, k, best.floor)) & (low <= most)
            return stays

        for block in blocks:
            alive, scores = vertical_scan(block, anchor, np.flatnonzero(block.labels != row["label"]), prune)
            for best, least, most in bests:
                fits = (scores >= least) & (scores <= most)
                best.add(scores[fits], block.ids[alive[fits]])
        for (p, *_), (best, *_) in zip(windows, bests, strict=True):
            n = len(best.ids)
            for name, values in zip(names, ([row["anchor_id"]] * n, [p["positive_id"]] * n, [p["positive_score"]] * n, [p["place"]] * n, best.ids.tolist(), best.scores.tolist()), strict=True):
                out[name] += values
    return pa.table({n: pa.array(x, pa.int64()) for n, x in out.items()})


def mine(
    rows: DataFrame, anchor_ids, key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    rows_per_cell: int = ROWS_PER_CELL, anchors_per_cell: int = ANCHORS_PER_CELL, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Hard negatives of the rows for which anchor_ids (a function of the id column) holds: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    vectors = scaled(rows, key, vector, label)
    blocks = written(columnar_blocks(vectors, block_rows), "columns")
    n_rows = blocks.agg(F.sum("n")).first()[0] or 0
    first = F.min(F.struct("label", "v"))
    anchors = written(vectors.filter(anchor_ids(F.col("id"))).groupBy(F.col("id").alias("anchor_id")).agg(first.alias("x")).select("anchor_id", "x.*"), "anchors")
    n_anchors = anchors.count()
    sizes, shape = (n_rows, n_anchors), (rows_per_cell, anchors_per_cell, block_rows)
    near = _cells(blocks, anchors, *sizes, lambda b, a: _positives(b, a, positives), "anchor_id long, positive_id long, positive_score long", *shape)
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    near = near.withColumn("place", place.cast("long")).filter(F.col("place") <= positives)
    known = anchors.join(near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score", "place")).alias("positives")), "anchor_id")
    known = written(known, "positives")
    schema = "anchor_id long, positive_id long, positive_score long, place long, negative_id long, negative_score long"
    far = _cells(blocks, known, *sizes, lambda b, a: _negatives(b, a, negatives, low, high), schema, *shape)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id"))
    return far.withColumn("rank", rank).filter(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(moved, lambda i: i % 100 == 0)


SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), ranked AS (
  SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
  FROM positives JOIN scored s USING (anchor_id)
  WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT * FROM ranked WHERE rank <= 10
"""
