"""Beyond the batch run: CSV files that keep arriving, cleaned as they come and deduplicated by their exact keys within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean
from ..schema import LEAD_RAW
from ..vocab import NA_TOKENS


def read_stream(spark: SparkSession, folder: str, sep: str = ",") -> DataFrame:
    """Leads of a folder's CSV files as a stream. The files have the columns of LEAD_RAW but the last two, in that order."""
    schema = LEAD_RAW[:12] if isinstance(LEAD_RAW[:12], type(LEAD_RAW)) else type(LEAD_RAW)(LEAD_RAW.fields[:12])
    df = spark.readStream.schema(schema).option("header", True).option("sep", sep).option("multiLine", True).option("escape", '"').csv(folder)
    return df.select(*[F.when(~F.col(c).isin(*NA_TOKENS), F.col(c)).alias(c) for c in df.columns], F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_modification_time").alias("arrived_at"))


def cleaned_stream(raw: DataFrame, delay: str = "1 day") -> DataFrame:
    """Cleaned leads; of those with one phone and one domain that arrive within the delay only the first. Leads with neither all pass."""
    d = clean(raw.withWatermark("arrived_at", delay))
    key = F.when(F.length("phone_e164") >= 10, F.concat(F.lit("p"), F.col("phone_e164"))).when(F.col("website_domain") != "", F.concat(F.lit("d"), F.col("website_domain"))).otherwise(F.uuid())
    return d.withColumn("_key", key).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def write_stream(df: DataFrame, folder: str, checkpoint: str):
    """Write the stream as Parquet, exactly once; returns the running query."""
    return df.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
