"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six white-space characters that separate words.
WORD_BREAK = r"[\x20\x09-\x0D]+"
#: Text bytes that a Python task handles at once; with it memory stays flat.
BLOCK_BYTES = 4 << 20
#: Rows that it handles at once, for texts that are short or empty.
BLOCK_ROWS = 16_384
ROWS_PER_FILE = 250_000
#: Rows of an Arrow batch; ten times as many, Spark's default, take JVM buffers of over 100 MB a task for whole texts.
ARROW_ROWS = 1000
#: Applications whose workers have the package.
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Prepare a session: workers get this package as a zip, and Arrow batches of whole texts stay small (a session setting)."""
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if rows <= 0 or rows > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        top = Path(__file__).resolve().parents[1]
        package = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark-llm.zip"  # the driver serves it to all workers
        with zipfile.ZipFile(package, "w") as z:
            for f in (top / "__init__.py", *sorted((top / "llm").glob("*.py"))):
                z.write(f, f.relative_to(top.parent).as_posix())
        context.addPyFile(str(package))
        _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only in local mode, where it may be unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which the session deletes when it ends."""
    path = f"{shared_dir(spark).rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex}"
    _filesystem(spark, path, "deleteOnExit")
    return path


def _filesystem(spark: SparkSession, path: str, call: str, *args) -> None:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    getattr(found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), call)(found, *args)


def written(df: DataFrame, name: str, rows: int | None = None, codec: str | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back, which cuts lineage and survives lost executors.

    With `rows`, about that many narrow rows are expected and files get ROWS_PER_FILE each (8 files at least).
    """
    path = scratch_path(df.sparkSession, name)
    (df if rows is None else df.coalesce(max(8, -(-rows // ROWS_PER_FILE)))).write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete a table that written() gave and nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _filesystem(df.sparkSession, path, "delete", True)


def unused(name: str, *frames: DataFrame) -> str:
    """A name for a helper column that no column of the frames has, whatever its case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def aside(columns: list[str], outputs: tuple[str, ...]) -> dict[str, str]:
    """New names of the columns that clash with an output, whatever their case: `n_words` becomes `n_words_input`."""
    taken, new = {c.lower() for c in (*columns, *outputs)}, {}
    for c in columns:
        if c.lower() in {o.lower() for o in outputs}:
            name = f"{c}_input"
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
            new[c] = name
    return new


def set_aside(df: DataFrame, *outputs: str) -> DataFrame:
    """df with the columns that clash with an output renamed, so that an operator loses none and overwrites none."""
    return df.withColumnsRenamed(aside(df.columns, outputs))


def own_columns(df: DataFrame, columns: list[str], *outputs: str) -> DataFrame:
    """The given columns of an operator's input, under their own names, from its result."""
    renamed = aside(columns, outputs)
    return df.select(*(F.col(f"`{renamed.get(c, c)}`").alias(c) for c in columns))


def join_found(left: DataFrame, right: DataFrame, key: str, counts: DataFrame, rows: int, how: str = "left") -> DataFrame:
    """left joined with right, which has one row a key, where a few keys may hold most of the `rows` rows of left.

    counts has left's rows of each key (key, count). Keys with over 1 / (4 * partitions) of the rows, fewer than
    4 * partitions of them, are broadcast; their rows are dealt over as many partitions as they fill, and right's row goes
    to each of these.
    """
    spark = left.sparkSession
    salt, salts = unused("_salt", left, right), unused("_salts", left, right)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = max(1, rows // (4 * parts))
    hot = counts.filter(F.col(key).isNotNull() & (F.col("count") > limit)).collect()
    sized = spark.createDataFrame([(r[key], -(-r["count"] // limit)) for r in hot], left.select(key).schema.add(salts, "long"))
    many = F.when(F.col(key).isNull(), parts).otherwise(F.coalesce(salts, F.lit(1))).cast("long")  # null meets nothing and goes anywhere
    dealt = left.join(F.broadcast(sized), key, "left").withColumn(salt, F.pmod(F.monotonically_increasing_id(), many)).drop(salts)
    spread = right.filter(F.col(key).isNotNull()).join(F.broadcast(sized), key, "left").withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), many - 1))).drop(salts)
    return dealt.repartition(parts, key, salt).join(spread.repartition(parts, key, salt), [key, salt], how).drop(salt)


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES, rows: int = BLOCK_ROWS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Deal batches anew into runs of at most `rows` rows and about `limit` characters of text; null text reads as empty.

    One longer text is a run of its own.
    """
    held: list[pa.RecordBatch] = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        found = [x or "" for x in batch.column(batch.schema.names.index(text)).to_pylist()]
        start = 0
        for i, x in enumerate(found):
            if size and size + len(x) > limit or len(texts) >= rows:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield _one(held), texts
                held, texts, size, start = [], [], 0, i
            texts.append(x)
            size += len(x)
        if start < len(found):
            held.append(batch.slice(start))
    if held:
        yield _one(held), texts


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def kept(batch: pa.RecordBatch, names: list[str]) -> list[pa.Array]:
    return [batch.column(batch.schema.names.index(n)) for n in names]


def let(value: Column, body) -> Column:
    """body(value) with value computed once per row, also when body uses it inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of a text, unchanged; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK, -1), lambda w: w != "")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
