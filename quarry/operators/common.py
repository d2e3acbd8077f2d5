"""Helpers of the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(df: DataFrame) -> str:
    """The folder for checkpoints: that of spark.checkpoint.dir. Only on one machine (a local master) a temporary folder serves where the session names none."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return str(context.getCheckpointDir())


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df)
    return df.checkpoint(eager=True)


def tabled(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table in the shared folder, the size of which is known.

    Loops of joins need it: a checkpoint keeps the estimated size of its plan, and
    each join multiplies the estimates of its sides, which squares them in every round.
    """
    path = f"{shared_folder(df)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def short_batches(spark: SparkSession, rows: int = 1_000, size: int = 16 << 20) -> None:
    """Documents are long rows: fewer of them, and of their bytes, in each Arrow
    batch keep the memory of executors and Python workers low. The two settings
    of the session are lowered and stay so; smaller ones are left alone."""
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{key}"
        if not 0 < int(str(spark.conf.get(key)).rstrip("b")) <= most:
            spark.conf.set(key, str(most))


#: Keys of more rows than this, and than one in SHARE of all, are hot: there are SHARE of them at most, which are broadcast.
HOT, SHARE = 1_000_000, 10_000


def join_hot(rows: DataFrame, table: DataFrame, on: list[str], least: int = HOT) -> DataFrame:
    """`rows` left join `table`, which has each key of `on` once at most. Null keys meet nothing.

    The rows of a hot key aren't gathered in one task: what `table` has for
    it is broadcast to them. Hot are keys of more than `least` rows, where rows
    are large, but never more than SHARE keys.
    """
    total = rows.count()
    if total <= least:  # no key can be hot
        return rows.join(table, on, "left")
    counts = rows.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > max(least, total // SHARE))
    hot = settle(counts.na.drop(subset=on).drop("_n").join(table, on, "left").withColumn("_hot", F.lit(True)))
    if hot.isEmpty():
        return rows.join(table, on, "left")
    told = rows.join(F.broadcast(hot), on, "left")
    others = told.where("_hot is null").select(*rows.columns).join(table, on, "left")
    return told.where("_hot").drop("_hot").unionByName(others)


def numbered(df: DataFrame, by: str, name: str = "ordinal") -> DataFrame:
    """`df` with dense numbers from 0 in ascending order of column `by`.

    Rows are sorted by ranges; each range starts where the counts of the ranges
    before end. No task sees all rows: only the counts are gathered.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, by).sortWithinPartitions(by)
    ranged = settle(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()))
    counts = sorted((r[0], r[1]) for r in ranged.groupBy("_part").agg(F.count("*")).collect())
    offset, offsets = 0, []
    for part, count in counts:
        offsets += [F.lit(part), F.lit(offset)]
        offset += count
    if not offsets:
        return ranged.drop("_part", "_place").withColumn(name, F.lit(0).cast("long"))
    start = F.create_map(*offsets)[F.col("_part")]
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn(name, (start + place).cast("long")).drop("_part", "_place")
