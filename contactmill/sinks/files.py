"""CSV files as a spreadsheet writes them: a header, minimal quoting, line feeds, one file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactmill import storage

_OPTIONS = {
    "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "", "lineSep": "\n", "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str, order: list[str], columns: list[str], single: bool = True) -> None:
    """Write the columns in the given order. Ranges of rows are sorted and written side by side, and
    then joined to one file, the form that other systems import; single=False leaves a folder of
    files whose names are in order instead, each with a header. Cells hold no line breaks."""
    spark = df.sparkSession
    keys = [f"_o{i}" for i in range(len(order))]
    rows = df.select(*columns, *[F.col(c).alias(k) for c, k in zip(order, keys)]).orderBy(*keys).select(*columns)
    folder = path + ".parts" if single else path
    rows.write.mode("overwrite").option("header", not single).options(**_OPTIONS).csv(folder)
    if single:
        storage.join_files(spark, ",".join(columns) + "\n", folder, path)
        storage.remove(spark, folder)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A table that write_csv wrote, all strings, without nulls; a large file is read in ranges."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    table = spark.read.schema(schema).option("header", True).option("lineSep", "\n")
    table = table.option("quote", '"').option("escape", '"').option("enforceSchema", True).csv(path)
    return table.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])
