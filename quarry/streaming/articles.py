"""The stateless stages over pages that keep coming in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.operators import markup

PAGES = "page_id long, url string, html string"


def read_pages(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    """(title, markup) of the pages in Parquet files under `path`, as they arrive."""
    found = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return found.select(F.col("url").alias("title"), F.col("html").alias("markup"))


def write_sections(pages: DataFrame, path: str, checkpoint: str, mode: str = "classify", once: bool = True) -> StreamingQuery:
    """Append each batch's sections to Parquet under `path`; `once` takes what is there and ends."""
    out = markup.sections_of(pages, mode=mode)
    writer = out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
