"""Pages kept so that single ones are found without a scan: sorted by name, with Bloom filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A row group is what a look-up reads at least.
GROUP_BYTES = 8 << 20
#: More names than these are joined instead: then most row groups are read anyway.
LOOK_UPS = 1_000


def write_page_store(pages: DataFrame, path: str, name: str = "title", files: int | None = None, group_bytes: int = GROUP_BYTES) -> None:
    """Pages as Parquet, in the order of their names within and across files.

    Bounds of names tell most row groups apart, and Bloom filters those whose
    bounds hold a name that they don't have. Pages of one name may be many:
    they are dealt by a hash of their contents as well. Pages without a name
    are kept, but no look-up finds them.
    """
    others = [c for c in pages.columns if c != name]
    names = pages.agg(F.approx_count_distinct(name)).first()[0] or 1
    files = files or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = pages.withColumn("_dealt", F.xxhash64(*others) if others else F.lit(0)).repartitionByRange(files, name, "_dealt")
    options = {
        f"parquet.bloom.filter.enabled#{name}": "true",
        # A file's names bound those of a row group; of several sizes up to that the least that serves is kept.
        f"parquet.bloom.filter.expected.ndv#{name}": str(-(-names // files)),
        f"parquet.bloom.filter.adaptive.enabled#{name}": "true",
        "parquet.block.size": str(group_bytes),
    }
    ranged.sortWithinPartitions(name).drop("_dealt").write.mode("overwrite").options(**options).parquet(path)


def read_page_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def is_one_of(column: str, values: Sequence[str]) -> Column:
    """Equal to one of `values`: single equations, all of which reach the scan (of a long list only its bounds would)."""
    if not values:
        return F.lit(False)
    if len(values) == 1:
        return F.col(column) == values[0]
    half = len(values) // 2
    return is_one_of(column, values[:half]) | is_one_of(column, values[half:])


def look_up(store: DataFrame, names: DataFrame, name: str = "title", most: int = LOOK_UPS) -> DataFrame:
    """The pages of a store that have one of `names`; a name given twice counts once, null and unknown ones find nothing.

    Up to `most` names are filters of the scan; more are joined, with the same rows.
    """
    wanted = names.select(name).na.drop().distinct()
    few = [r[0] for r in wanted.limit(most + 1).collect()]
    if len(few) > most:
        return store.join(wanted, name, "left_semi").select(*store.columns)
    return store.where(is_one_of(name, sorted(few)))
