"""CSV exports of differing layouts, unified by a column mapping for each file."""

from __future__ import annotations

import codecs
import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactmill import storage
from contactmill.config import CANONICAL, LIST_MARK, Config, ConfigError, Source
from contactmill.functions import text as T

#: Rows of one file in the order of files; an index is a file's number times this, plus the row.
FILE_STRIDE = 1 << 40
KINDS = {"email": "unbrauchbare E-Mail", "phone": "unbrauchbare Telefonnummer", "created": "nicht lesbares Datum"}


def expand_inputs(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Existing paths as they are, else wildcards, in any file system; sorted, each file once however
    it is spelled."""
    paths = set()
    for pattern in patterns:
        hits = [pattern] if storage.exists(spark, pattern) else storage.matching(spark, pattern)
        if not hits:
            raise ConfigError(f"Keine Eingabedatei unter {pattern!r}")
        paths |= {storage.uri(spark, hit) for hit in hits}
    return sorted(paths)


def jvm_charset(encoding: str) -> str:
    """The JVM's name of a Python codec; the mark at the start of UTF-8 files is skipped anyway."""
    try:
        name = codecs.lookup(encoding).name
    except LookupError as wrong:
        raise ConfigError(f"Unbekannte Kodierung {encoding!r}") from wrong
    known = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8", "ascii": "US-ASCII", "iso8859-1": "ISO-8859-1", "utf-16": "UTF-16"}
    return known.get(name, name.replace("cp125", "windows-125").replace("iso8859-", "ISO-8859-"))


def _reader(spark: SparkSession, source: Source):
    charset = jvm_charset(source.encoding)
    if charset not in ("UTF-8", "US-ASCII", "ISO-8859-1", "UTF-16"):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # as long as the files may be read
    options = {"multiLine": True, "quote": '"', "escape": '"', "sep": source.delimiter, "encoding": charset, "mode": "PERMISSIVE"}
    return spark.read.options(**options)


def read_header(spark: SparkSession, path: str, source: Source) -> list[str]:
    first = _reader(spark, source).option("header", False).csv(path).head()
    return [(cell or "").removeprefix("\ufeff") for cell in first or []]


def scan(spark: SparkSession, path: str, source: Source) -> DataFrame:
    """One file: its mapped columns under their canonical names, and row from 1."""
    name = storage.name(path)
    if set(path) & set("*?[]{}\\"):
        raise ConfigError(f"{name}: Dateinamen mit Platzhalterzeichen werden nicht unterstützt")
    header = read_header(spark, path, source)
    missing = sorted(set(source.columns.values()) - set(header))
    if missing:
        raise ConfigError(f"{name}: {missing} fehlen in der Datei; sie hat die Spalten {sorted(set(header))}")
    # by position: names may be repeated, and then the last one counts
    place = {h: i for i, h in enumerate(header)}
    table = _reader(spark, source).schema(", ".join(f"_c{i} string" for i in range(max(1, len(header)))))
    table = table.option("header", True).option("enforceSchema", True).csv(path)
    # a quoted line break can't be split, so a file is one task and its rows come in order
    cells = [
        T.clean_text(F.col(f"_c{place[source.columns[f]]}")).alias(f) if f in source.columns else F.lit("").alias(f)
        for f in CANONICAL
    ]
    return table.select((F.monotonically_increasing_id() + 1).alias("row"), *cells)


def raw_rows(spark: SparkSession, paths: list[str], config: Config) -> DataFrame:
    """The rows of all files in one table, with source, file and index."""
    parts = []
    for number, path in enumerate(paths):
        name = storage.name(path)
        stem = os.path.splitext(name)[0]
        rows = scan(spark, path, config.source_for(name))
        index = (F.lit(number * FILE_STRIDE) + F.col("row")).cast("long")
        parts.append(rows.select(F.lit(stem).alias("source"), F.lit(name).alias("file"), index.alias("index"), "*"))
    return reduce(DataFrame.unionByName, parts)


def with_uids(rows: DataFrame) -> DataFrame:
    """Adds uid and whether it was a duplicate: the second and later rows of an id get their row
    number, and their file's number as well if that would still not tell them apart."""
    uid = F.concat_ws(":", "source", F.when(F.col("id") != "", F.col("id")).otherwise(F.concat(F.lit("row"), F.col("row"))))
    rows = rows.withColumn("uid", uid)
    # only ids that repeat take part in the numbering
    repeated = rows.groupBy("uid").agg(F.count("*").alias("n"), F.min("index").alias("first")).where("n > 1")
    rows = rows.join(repeated.select("uid", "first"), "uid", "left")
    again = F.col("first").isNotNull() & (F.col("first") != F.col("index"))
    rows = rows.withColumns({"duplicate": again, "uid": F.when(again, F.concat("uid", F.lit("@row"), "row")).otherwise(F.col("uid"))})
    file = (F.col("index") / FILE_STRIDE).cast("long")
    clash = rows.where("duplicate").groupBy("uid").agg(F.min("index").alias("least"), F.count("*").alias("m")).where("m > 1")
    rows = rows.join(clash.select("uid", "least"), "uid", "left")
    later = F.col("duplicate") & F.col("least").isNotNull() & (F.col("least") != F.col("index"))
    return rows.withColumn("uid", F.when(later, F.concat("uid", F.lit("@file"), file + 1)).otherwise(F.col("uid"))).drop(
        "first", "least"
    )


def to_records(rows: DataFrame, config: Config) -> DataFrame:
    """Raw rows (canonical fields, uid, source, row, index) -> records."""
    name = F.when(F.col("name") != "", F.col("name")).otherwise(T.clean_text(F.concat_ws(" ", "first_name", "last_name")))
    normal = {
        "email": T.normalize_email(F.col("email")),
        "email_2": T.normalize_email(F.col("email_2")),
        "phone": T.normalize_phone(F.col("phone"), config.country_code),
        "phone_2": T.normalize_phone(F.col("phone_2"), config.country_code),
        "created": T.iso_date(F.col("created")),
    }
    # each normal form is a column, that values and complaints refer to
    rows = rows.withColumns({"name": T.normalize_name(name)} | {f"normal_{c}": form for c, form in normal.items()})

    def given(*columns: str) -> Column:
        return F.filter(F.array(*columns), lambda v: v != "")

    def bad(column: str) -> Column:
        kind = KINDS[column.removesuffix("_2")]
        text = F.concat(F.lit(kind + " "), T.quoted(F.col(column)))
        what = F.struct(F.lit(kind).alias("kind"), F.col(column).alias("value"), text.alias("text"))
        return F.when((F.col(column) != "") & (F.col(f"normal_{column}") == ""), what)

    return rows.select(
        "uid", "source", "row", "index", "name", "company", "city",
        F.col("normal_created").alias("created"),
        F.array_distinct(given("normal_email", "normal_email_2")).alias("emails"),
        F.array_distinct(given("normal_phone", "normal_phone_2")).alias("phones"),
        given("email", "email_2").alias("raw_emails"),
        given("phone", "phone_2").alias("raw_phones"),
        F.array_compact(F.array(*map(bad, normal))).alias("unusable"),
        *[c for c in ("file", "duplicate") if c in rows.columns],
    )


def load_records(spark: SparkSession, paths: list[str], config: Config) -> DataFrame:
    """Records of all files; an id with the list mark is an error that names file and row."""
    rows = with_uids(raw_rows(spark, paths, config))
    marked = rows.where(F.contains("uid", F.lit(LIST_MARK))).orderBy("index").select("file", "row", "uid").first()
    if marked:
        raise ConfigError(
            f"{marked['file']}, Zeile {marked['row']}: Die ID {marked['uid']!r} enthält '{LIST_MARK}', das "
            "Listentrennzeichen der Ausgabedateien; bereinigen Sie die ID-Spalte oder benennen Sie die Datei um"
        )
    return to_records(rows, config)
