"""What several operators share: stored intermediates, row keys, bounded slices of Arrow batches."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
import tripmill
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.sources.workdir import new_workdir

# Characters of text that a Python worker holds as one group of rows.
GROUP_CHARS = 1 << 21


@contextmanager
def paused_collector() -> Iterator[None]:
    """Holds back the cycle collector while very many small objects without cycles are made."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands the package to the Python workers, once per application, as `--py-files` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(tripmill.__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="tripmill-"), "tripmill.zip")
    with zipfile.ZipFile(archive, "w") as package:
        for source in sorted(root.rglob("*.py")):
            package.write(source, source.relative_to(root.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


Batches = Iterator[pa.RecordBatch]


def map_batches(
    df: DataFrame, run: Callable[[Batches], Batches], schema: StructType | str
) -> DataFrame:
    """`mapInArrow` by a function whose module the workers can import."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


# Rows of whole texts, and of vectors, that Spark hands to Python at once.
TEXT_ROWS, VECTOR_ROWS = 1_000, 10_000


def hand_over(spark: SparkSession, rows: int) -> None:
    """Sets the session's Arrow batch size, for queries and stages to call; operators never do."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    Cuts the lineage, so a lost executor costs no recomputation of what came before. An empty
    frame keeps its schema.
    """
    spark = df.sparkSession
    path = new_workdir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drops columns whose name (in any case) an operator is about to use."""
    taken = {name.lower() for name in names}
    clashing = [c for c in df.columns if c.lower() in taken]
    return df.drop(*clashing) if clashing else df


def text_key(column: str | Column) -> Column:
    """128 bits of a text: two XXH64 values of different seeds."""
    return F.struct(
        F.xxhash64(column).alias("a"), F.xxhash64(F.lit("second"), column).alias("b")
    )


def row_groups(
    batch: pa.RecordBatch, column: str, limit: int = GROUP_CHARS
) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about `limit` bytes together, one row at least."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(False)
    start, held = 0, 0
    for row, length in enumerate(lengths):
        if row > start and held + length > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += int(length)
    if batch.num_rows > start:
        yield batch.slice(start)
