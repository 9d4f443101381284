"""Rounds of observations folded into state, exactly once for each micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import plays


def _version(spark: SparkSession, folder: str, batch: int) -> DataFrame | None:
    """The state before a batch: the version that the batch before it wrote."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch={batch - 1}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.parquet(f"{folder}/batch={batch - 1}")


def fold_pairs(folder: str, **columns: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: play counts as a version of the state for each batch; a batch that runs again writes the same."""

    def fold(batch: DataFrame, number: int) -> None:
        new = plays.pairs(batch, **columns)
        state = _version(batch.sparkSession, folder, number)
        (new if state is None else plays.merged_pairs(state, new)).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return fold


def fold_halves(folder: str, raw: str = "raw", limit: int = plays.HALVES) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: the histogram of title halves, as a bounded version of the state for each batch."""

    def fold(batch: DataFrame, number: int) -> None:
        new = plays.half_counts(batch, raw, limit)
        state = _version(batch.sparkSession, folder, number)
        (new if state is None else plays.merged_halves(state, new, limit)).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return fold


def _rounds(every: str | None) -> dict:
    """What is there now, or a round each so often, as "1 hour"."""
    return {"availableNow": True} if every is None else {"processingTime": every}


def stream_pairs(observations: DataFrame, folder: str, checkpoint: str, every: str | None = None, **columns: str) -> StreamingQuery:
    return observations.writeStream.foreachBatch(fold_pairs(folder, **columns)).option("checkpointLocation", checkpoint).trigger(**_rounds(every)).start()


def stream_halves(titles: DataFrame, folder: str, checkpoint: str, every: str | None = None, raw: str = "raw", limit: int = plays.HALVES) -> StreamingQuery:
    return titles.writeStream.foreachBatch(fold_halves(folder, raw, limit)).option("checkpointLocation", checkpoint).trigger(**_rounds(every)).start()


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """The last version that was written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    last = max(int(f.getPath().getName().removeprefix("batch=")) for f in files if f.getPath().getName().startswith("batch="))
    return spark.read.parquet(f"{folder}/batch={last}")


def new_titles(titles: DataFrame, keys: list[str], path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Titles that weren't there before, appended; the state of what was seen is Spark's."""
    return titles.dropDuplicates(keys).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**_rounds(every)).start()


class Tally(StatefulProcessor):
    """A station's four counters and the titles that have voted, kept between batches.

    Rows of a batch are taken in order of ``seq``; columns as ``with_evidence`` gives them, flattened.
    """

    def __init__(self, cap: int = 64):
        self.cap = cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getValueState("counts", "a long, b long, c long, d long")
        self.voted = handle.getMapState("voted", "text string", "seen boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        counts = list(self.counts.get()) if self.counts.exists() else [0, 0, 0, 0]
        held = pd.concat(list(rows)).sort_values("seq", kind="stable")
        out = []
        for row in held.itertuples(index=False):
            if key[0] and not pd.isna(row.orientation) and row.strength >= 1 and not self.voted.containsKey((row.text,)):
                self.voted.updateValue((row.text,), (True,))
                i = (0 if row.strength >= 2 else 2) + int(row.orientation)
                counts[i] = min(self.cap, counts[i] + 1)
            out.append((key[0], row.seq, *counts))
        self.counts.update(tuple(counts))
        yield pd.DataFrame(out, columns=["station", "seq", "strong_first", "strong_second", "weak_first", "weak_second"])

    def close(self) -> None:
        pass


def stream_tally(evidence: DataFrame, cap: int = 64) -> DataFrame:
    """Counters after each row of a stream of (station, seq, text, orientation, strength); needs the RocksDB state store."""
    shape = "station string, seq long, strong_first long, strong_second long, weak_first long, weak_second long"
    rows = evidence.withColumn("station", F.coalesce("station", F.lit("")))
    return rows.groupBy("station").transformWithStateInPandas(Tally(cap), shape, "Append", "None")
