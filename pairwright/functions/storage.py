"""Places for files that executors and driver share."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Cuts of an order, those that are looked through at once, and rows that are worth a partition of their own.
CUTS, STEP, ROWS = 1024, 32, 50_000


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below spark.checkpoint.dir, removed when the session ends; a local one only on a local master without that setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share.")
        folder = tempfile.mkdtemp(prefix="pairwright-")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.deleteOnExit(path)
    return store.makeQualified(path).toString()


def in_order(rows: DataFrame, first: str, *more: str) -> DataFrame:
    """The rows sorted by whole numbers, as `orderBy` does it, over the partitions in order.

    The cuts are quantiles of `first`, for which no other column is made; a sort by range makes all rows to sample them.
    Equal values of `first` lie in one partition.
    """
    return dealt_in_order(rows, first).sortWithinPartitions(first, *more)


def dealt_in_order(rows: DataFrame, first: str, parts: int | None = None) -> DataFrame:
    """The rows over partitions in order of `first`, not sorted inside them; about `parts` of these, or as their number asks."""
    found = rows.agg(F.percentile_approx(first, [i / CUTS for i in range(1, CUTS)], 10 * CUTS).alias("q"), F.count(F.lit(1)).alias("n")).first()
    if parts is None:
        parts = min(max(1, found["n"] // ROWS), max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), found["n"] // (8 * ROWS)))
    parts = min(CUTS, parts)
    cuts = sorted({found["q"][i * CUTS // parts - 1] for i in range(1, parts)}) if found["q"] else []
    if not cuts:
        return rows.coalesce(1)
    below = lambda some: F.size(F.filter(some, lambda c: c < F.col(first)))
    every = F.array(*[F.lit(c) for c in cuts])
    wide = below(F.array(*[F.lit(c) for c in cuts[STEP - 1 :: STEP]])) * STEP if len(cuts) >= STEP else F.lit(0)
    part = wide + below(F.slice(every, wide + 1, STEP))
    return rows.repartitionById(len(cuts) + 1, part)


def write_lines(lines: DataFrame, path: str | Path, packed: bool = False) -> int:
    """Write `value` as text files, gzip files where `packed`, and return the number of lines. An existing path fails; nothing stays of a write that fails."""
    spark, counted = lines.sparkSession, Observation()
    place = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    there = store.exists(place)
    writer = lines.observe(counted, F.count(F.lit(1)).alias("n")).select("value").write.mode("errorifexists")
    if packed:
        writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    try:
        writer.text(str(path))
    except Exception:
        if not there:
            store.delete(place, True)
        raise
    return counted.get["n"]
