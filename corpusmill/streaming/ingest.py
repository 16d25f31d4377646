"""The batch filters over a stream of files, with dedup of what arrives within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from ..operators import rules


def read_folder(spark: SparkSession, folder: str, schema: StructType | str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines as they arrive in a folder, with ``arrived``, the file's time."""
    reader = spark.readStream.schema(schema).option("mode", "DROPMALFORMED")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder).withColumn("arrived", F.col("_metadata.file_modification_time"))


def filtered(stream: DataFrame, filters: list[rules.Filter], mutate: bool = False) -> DataFrame:
    """The stream with the failures of its rows: filters keep no state, so a plan is the same for streams and tables."""
    return rules.verdicts(stream, filters, mutate)


def deduplicated(stream: DataFrame, text_field: str = "text", within: str = "1 hour", time: str = "arrived") -> DataFrame:
    """The first row of each text within a span of time; state older than that is dropped."""
    return stream.withColumn("hash", T.sha256(T.text_of(text_field))).withWatermark(time, within).dropDuplicatesWithinWatermark(["hash"])


def drop_counts(stream: DataFrame, window: str = "10 minutes", late: str = "10 minutes", time: str = "arrived") -> DataFrame:
    """(window, filter, dropped): what first drops the rows of a span of time; rows later than ``late`` don't count."""
    first = F.get("failures", F.lit(0))["filter"]
    return stream.withWatermark(time, late).groupBy(F.window(time, window), F.coalesce(first, F.lit("kept")).alias("filter")).agg(F.count(F.lit(1)).alias("dropped"))
