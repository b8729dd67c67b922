"""Incoming rows as a stream: normalising and judging need no state, so they run unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contactmill.config import CANONICAL, Config
from contactmill.operators import rules
from contactmill.sources import csv as source


def judge_stream(rows: DataFrame, config: Config) -> DataFrame:
    """A stream of raw rows (source, row and any canonical fields) -> judged records. Ids are not
    told apart here: that needs all rows of an export."""
    filled = rows.select(
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce(F.col("row").cast("int"), F.lit(0)).alias("row"),
        *[(source.T.clean_text(F.col(f)) if f in rows.columns else F.lit("")).alias(f) for f in CANONICAL],
    )
    uid = F.when(F.col("id") != "", F.col("id")).otherwise(F.concat(F.lit("row"), "row"))
    filled = filled.withColumns({"uid": F.concat_ws(":", "source", uid), "index": F.col("row").cast("long")})
    return rules.judge(source.to_records(filled, config), config)


def watch(
    spark: SparkSession, folder: str, schema: str, config: Config, out: str, checkpoint: str
) -> StreamingQuery:
    """Judge all Parquet files that are or come in a folder, and append the records to `out`."""
    rows = spark.readStream.schema(schema).parquet(folder)
    judged = judge_stream(rows, config)
    return (
        judged.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
