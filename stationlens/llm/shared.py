"""What the operators of this subpackage share: reading, sizing, streaming groups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import discard, materialize

__all__ = ["binaries", "discard", "kept", "let", "materialize", "parts", "runs", "size_in_bytes", "table"]

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def size_in_bytes(df: DataFrame, column: str) -> int:
    """About how large the input is: from its files, or else from the column itself."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= 1 << 50:  # what Spark says when it doesn't know
        size = df.select(F.sum(F.octet_length(column))).first()[0] or 0
    return size


def parts(spark: SparkSession, size: int, each: int) -> int:
    """Partitions of about ``each`` bytes, and at least one for each core."""
    return max(spark.sparkContext.defaultParallelism, -(-size // each), 1)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` refers to it, in lambdas too."""
    return F.transform(F.array(value), use)[0]


def runs(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[object, pa.Table]]:
    """Runs of rows with one value in ``column``, from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    last: object = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy(zero_copy_only=False)
        cuts = (values[1:] != values[:-1]).nonzero()[0] + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if held and values[a] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = values[a]
    if held:
        yield last, pa.Table.from_batches(held)


_kept: dict[str, object] = {}


def kept(owner: str, make: Callable[[], object] | None = None) -> object:
    """What an operator keeps in a Python worker between its tasks; that of others goes, so a pipeline's workers hold one."""
    for other in [k for k in _kept if k != owner]:
        del _kept[other]
    if make and owner not in _kept:
        _kept[owner] = make()
    return _kept.get(owner)


def binaries(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary()).to_pylist()
