"""What the text operators share: tables, folds, words and running sums."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize, scratch_dir

__all__ = [
    "documents", "few", "fold", "free_name", "giving_back", "materialize", "number_copies", "running", "scratch_dir", "table", "text_words", "words_of",
]


_shipped: set[str] = set()
#: Most bytes of rows that go to a Python worker at once (one row at least): Spark's own 64 MB are held
#: several times over, as vectors that double, as the worker's copy and as what it makes of them.
BATCH_BYTES = 2 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Most rows that a scan of Parquet decodes at once: Spark's own 4,096 texts are vectors of many MB in each task,
#: which double as they grow.
SCAN_ROWS = 512
_SCAN_CONF = "spark.sql.parquet.columnarReaderBatchSize"


def bound_batches(spark: SparkSession) -> None:
    """Lower this session's bounds on an Arrow batch and on a scan's rows to those above; lower ones stay."""
    held = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_CONF))
    if not 0 < held <= BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    if int(spark.conf.get(_SCAN_CONF)) > SCAN_ROWS:
        spark.conf.set(_SCAN_CONF, str(SCAN_ROWS))


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would, once per application, and bound the batches they take."""
    bound_batches(spark)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp()  # the driver serves the archive from here until it ends
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sources = Path(folder, "sources", package.name)
        shutil.copytree(package, sources, ignore=shutil.ignore_patterns("__pycache__"))
        archive = shutil.make_archive(str(Path(folder, package.name)), "zip", sources.parent)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{stem}_{uuid.uuid4().hex[:8]}"
    return name


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8.

    ``bytes.lower`` and ``bytes.split`` know ASCII only, which is what is asked for.
    """
    return text.encode("utf-8", "replace").lower().split() if text else []


# Digits, letters a-z (A-Z lower-cased) and bytes above 0x7F stay, all else parts words.
_LETTERS = bytes(
    b if b > 0x7F or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20
    for b in range(256)
)


def text_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.encode("utf-8", "replace").translate(_LETTERS).split() if text else []


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index(column))
        whole = max(1, text.nbytes)
        step = max(1, min(batch.num_rows, batch.num_rows * limit // whole))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def give_back() -> None:
    """Return freed memory of this process to the machine; allocators keep it for themselves otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def giving_back(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``function``, which at the end of a task gives back what its worker has freed.

    Workers are kept for the next task, of whatever stage: what one holds on to adds to all that follow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return run


def few(spark: SparkSession, rows: list[tuple[int, ...]], schema: str) -> DataFrame:
    """A frame of a few rows of integers, read by the JVM alone; from a list, Spark starts Python workers to read it."""
    kind = StructType.fromDDL(schema)
    columns = zip(*rows, strict=True) if rows else [()] * len(kind)
    return spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in columns], names=kind.names), kind)


def running(df: DataFrame, order: list[str], sums: dict[str, str], rank: str | None = None) -> DataFrame:
    """Rank and exclusive running sums of a frame in the order of ``order``, without one task seeing all.

    The rows are range-partitioned and stored; each range is numbered by itself,
    and the totals of the ranges before it (one row per range) are added.
    ``sums`` maps a new column to the column summed. Ties of ``order`` are
    ordered arbitrarily: give a unique order where it matters. NULLs sort first.
    """
    part = free_name(df, "range")
    ranged = materialize(
        df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).withColumn(part, F.spark_partition_id()),
        "ranged",
    )
    totals = (
        ranged.groupBy(part)
        .agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(sums.values())])
        .orderBy(part)
        .collect()
    )
    # One row per range: as many as there are shuffle partitions.
    before, offsets = [0] * (1 + len(sums)), []
    for row in totals:
        offsets.append((row[0], *before))
        before = [a + (b or 0) for a, b in zip(before, row[1:], strict=True)]
    names = [f"{part}_{i}" for i in range(1 + len(sums))]
    schema = f"`{part}` int, " + ", ".join(f"`{n}` long" for n in names)
    base = few(df.sparkSession, offsets, schema)
    window = Window.partitionBy(part).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    before_row = window.rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(F.broadcast(base), part)
    added = {
        new: F.col(n) + F.coalesce(F.sum(old).over(before_row), F.lit(0))
        for (new, old), n in zip(sums.items(), names[1:], strict=True)
    }
    if rank:
        added[rank] = F.col(names[0]) + F.row_number().over(window) - 1
    return out.withColumns(added).drop(part, *names)


def number_copies(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number rows that are equal in ``keys`` from 0, so that each can be dealt by itself.

    Only rows with an equal one are numbered, by ranges that a hot key is split over. Which of
    equal rows gets which number is arbitrary.
    """
    repeated = materialize(
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1").select(*keys), "repeated"
    )
    if repeated.isEmpty():
        return df.withColumn(name, F.lit(0).cast("bigint"))

    def same(other: DataFrame):
        renamed = other.withColumnsRenamed({k: f"_of_{k}" for k in keys})
        condition = F.lit(True)
        for k in keys:
            condition &= F.col(k).eqNullSafe(F.col(f"_of_{k}"))
        return renamed, condition

    other, condition = same(repeated)
    single = df.join(other, condition, "left_anti").withColumn(name, F.lit(0).cast("bigint"))
    row = free_name(df, "row")
    several = df.join(other, condition, "left_semi").withColumn(row, F.monotonically_increasing_id())
    placed = running(several, [*keys, row], {}, rank=name)
    first, condition = same(placed.groupBy(*keys).agg(F.min(name).alias("_first")))
    placed = placed.join(first, condition).withColumn(name, F.col(name) - F.col("_first"))
    return single.unionByName(placed.select(*df.columns, name))
