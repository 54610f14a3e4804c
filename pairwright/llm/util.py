"""Shared pieces of the corpus operators: tables on shared storage and running totals without a hot task."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
HASH_SLOTS = 65536
#: So many narrow rows are broadcast at most, a few ten MB; more are joined by a shuffle.
MOST_BROADCAST = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, with its scheme; a temporary one only on a local master (tests) that names none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share.")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pairwright-"))
        found = spark.sparkContext.getCheckpointDir()
    return qualified(spark, found)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme of the file system that the cluster means by it."""
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    return held.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(held).toString().rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path on shared storage, removed when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df once as Parquet on shared storage and read it back: lineage ends there and lost executors cost nothing."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a materialized table that no later plan reads."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def lean_batches(spark: SparkSession, rows: int = 1024, size: str = "16m") -> None:
    """Keep the session's Arrow batches to what a worker holds of texts at a time; values that the user has set stay."""
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows)), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        if key not in spark.conf.getAll:
            spark.conf.set(key, value)


def few(df: DataFrame, label: str, most: int = MOST_BROADCAST) -> DataFrame:
    """`df`, written once and counted: to be broadcast where it has at most `most` rows, else left to a shuffle."""
    kept = materialize(df, label)
    return F.broadcast(kept) if kept.count() <= most else kept


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores after it as no column of `df` has; names differ by more than case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_ids(docs: DataFrame, ids: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """The rows of `docs` whose doc_id isn't in `ids`; rows without one stay.

    Up to `most` ids are broadcast, so no text is shuffled; more are joined by a shuffle.
    """
    ids = few(ids.select("doc_id").filter("doc_id IS NOT NULL").distinct(), "ids", most)
    return docs.join(ids, "doc_id", "left_anti").select(*docs.columns)


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slot_of(key: Column) -> Column:
    """A stable slot in [0, 65536) from a key of any type; null has one too."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 4), 16, 10).cast("long")


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on null-safe equality of the named columns and keep the left ones; further columns must differ in name."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = F.lit(True)
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(renamed, on, how).drop(*[f"_r_{c}" for c in keys])


def running_total(df: DataFrame, group: list[str], spread: str, order: list[Column], value: Column, out: str, block_rows: int = 2_000, wrap: int | None = None) -> DataFrame:
    """Add `out`: the sum of `value` over the rows of the same group that come before this one.

    Rows of a group are dealt over hash blocks of about `block_rows` rows by `spread`, so that a group that holds
    a third of all rows is numbered by many tasks; the order is by block, then `order`. With up to `block_rows` rows
    in a group the order is `order` alone. Only groups of several blocks need their counts and the sums of their
    blocks; these meet the rows by a broadcast behind a count, so that the rows themselves move once. With `wrap` the
    sums are right but for multiples of it, and can't overflow. `df` should be cheap to read again (a materialized
    table): it is read up to three times.
    """
    counts = few(df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block_rows).select(*group, F.least(F.lit(HASH_SLOTS), F.ceil(F.col("_n") / block_rows)).alias("_blocks")), "blocks")
    dealt = join_same(df.withColumn("_value", value.cast("long")), counts, group, "left")
    dealt = dealt.withColumn("_block", F.when(F.col("_blocks").isNull(), 0).otherwise(F.floor(slot_of(F.col(spread)) * F.col("_blocks") / HASH_SLOTS)).cast("int"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_value") if wrap is None else F.sum("_value") % wrap
    sums = dealt.filter("_blocks IS NOT NULL").groupBy(*group, "_block").agg(total.alias("_sum"))
    offsets = few(sums.select(*group, "_block", F.sum("_sum").over(before).alias("_offset")).filter("_offset IS NOT NULL"), "offsets")
    inside = Window.partitionBy(*group, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("_local", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return join_same(local, offsets, [*group, "_block"], "left").select(*df.columns, (F.coalesce("_offset", F.lit(0)) + F.col("_local")).alias(out))
