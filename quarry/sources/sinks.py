"""Sinks of training texts, models, rules and cached results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import exploded
from quarry.operators.language_model import arpa_lines


def write_exploded(texts: DataFrame, path: str, column: str = "text", records: int = 2_000) -> None:
    """Training texts with blanks between characters, so many texts a file."""
    lines = texts.select(F.explode(F.split(column, "\n")).alias("line")).select(exploded(F.col("line")).alias("value"))
    lines.write.mode("overwrite").option("maxRecordsPerFile", records).text(path)


def write_model(model: DataFrame, path: str) -> None:
    """A language model as ARPA entries, compressed; lines are in order within and across files."""
    lines = arpa_lines(model).repartitionByRange("ord", "place").sortWithinPartitions("ord", "place")
    lines.select(F.col("line").alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)


def content_key(df: DataFrame) -> str:
    """A name for the rows of a table, whatever their order."""
    n, x, y = df.select(F.xxhash64(*df.columns).alias("h"), F.hash(*df.columns).cast("long").alias("g")).agg(F.count("*"), F.bit_xor("h"), F.sum("g")).first()
    return f"{n}-{(x or 0) & (1 << 64) - 1:016x}-{(y or 0) & (1 << 64) - 1:016x}"


def cached(spark: SparkSession, path: str, make: Callable[[], DataFrame], of: DataFrame | None = None) -> DataFrame:
    """What `make` gives, kept as Parquet under `path`; made only where nothing is there yet.
    With `of`, a table that it is made of, in a folder for just these rows."""
    path = path if of is None else f"{path}/{content_key(of)}"
    if not _exists(spark, path):
        make().write.mode("ignore").parquet(path)
    return spark.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_rules(rules: DataFrame, path: str) -> None:
    """Resolved template actions (name, action) in the `_`-separated form, in order within and across files."""
    rows = rules.repartitionByRange("name").sortWithinPartitions("name")
    rows.select(F.concat_ws("_", F.translate("name", "_", " "), "action", F.lit("")).alias("value")).write.mode("overwrite").text(path)


def progress(df: DataFrame, name: str, text: str = "text"):
    """`df` with an observation of its rows and of those without text: (df, observation)."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(F.trim(text), F.lit("")) == "").alias("empty")), seen
