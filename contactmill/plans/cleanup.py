"""The whole clean-up: load, judge, group, merge, check, write, check again."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactmill import storage
from contactmill.config import Config
from contactmill.operators import integrity, merge, rules
from contactmill.session import materialise
from contactmill.sinks import files
from contactmill.sinks import report as reporting
from contactmill.sources import csv as source

CLEAN = (
    "id name company city email email_2 more_emails phone phone_2 more_phones created sources merged_from suspect "
    "suspect_reasons notes"
).split()
EXCLUDED = "id source row name email phone email_normalized phone_normalized reason_code reason".split()


@dataclass
class Result:
    """The tables of a run; records, grouped and contacts are in the shared folder, the others follow."""

    records: DataFrame
    grouped: DataFrame  # the records that are kept, with their component
    contacts: DataFrame
    config: Config

    @property
    def excluded(self) -> DataFrame:
        return merge.excluded_rows(self.records.where(F.size("reasons") > 0))

    @property
    def clean(self) -> DataFrame:
        return merge.clean_rows(self.contacts)

    @cached_property
    def metrics(self) -> dict:
        """Counts for the summary and the report; each group of counts is one aggregation."""
        rejected = F.size("reasons") > 0
        first = F.get("reasons", F.lit(0))["code"]
        totals = self.records.agg(F.count("*").alias("n"), F.count_if(rejected).alias("x")).first()
        of = self.contacts.agg(
            F.count("*").alias("n"), F.coalesce(F.sum(F.col("n_members") - 1), F.lit(0)).alias("absorbed"),
            F.count_if(F.size("flags") > 0).alias("suspect"),
        ).first()

        def counts(df: DataFrame, key) -> dict:
            return {r["key"]: r["n"] for r in df.groupBy(key.alias("key")).agg(F.count("*").alias("n")).collect()}

        return {
            "n_input": totals["n"], "n_excluded": totals["x"], "n_output": of["n"], "n_absorbed": of["absorbed"],
            "n_suspect": of["suspect"],
            "files": sorted(counts(self.records, F.col("file")).items()),
            "reasons": counts(self.records.where(rejected), first),
            "flags": counts(self.contacts.select(F.explode("flags").alias("f")), F.col("f.code")),
            "unusable": counts(self.records.select(F.explode("unusable").alias("u")), F.col("u.kind")),
            "group_sizes": counts(self.contacts, F.col("n_members")),
        }

    def warnings(self) -> Iterator[str]:
        """One line for each duplicate id, in order; rows come from the executors as they are read."""
        again = self.records.where("duplicate").orderBy("index").select("file", "row", "uid")
        for r in again.toLocalIterator():
            yield f"{r['file']}, Zeile {r['row']}: doppelte ID, verwendet wird {r['uid']}"


def process(spark: SparkSession, paths: list[str], config: Config) -> Result:
    """All steps up to the first check; nothing is written to the output folder."""
    judged = rules.judge(source.load_records(spark, paths, config), config)
    records, _ = materialise(judged, "records")
    # rows that are set aside must not link two contacts, so only kept rows are grouped
    kept = records.where(F.size("reasons") == 0)
    grouped, _ = materialise(merge.with_components(kept), "grouped")
    contacts, _ = materialise(merge.merge_contacts(grouped), "contacts")
    result = Result(records, grouped, contacts, config)
    integrity.verify(records, result.clean, result.excluded, config.country_code)
    return result


def run(spark: SparkSession, patterns: list[str], config: Config, out: str) -> Result:
    """Process, write clean.csv, excluded.csv, report.md and review.html, and check the files read
    back. They are staged and only get their place in `out`, a folder in any file system, after that
    check."""
    result = process(spark, source.expand_inputs(spark, patterns), config)
    out = out.rstrip("/")
    staged = f"{out}/_staged"
    storage.remove(spark, staged)
    storage.make_folder(spark, staged)
    files.write_csv(result.clean, f"{staged}/clean.csv", ["component"], CLEAN)
    files.write_csv(result.excluded, f"{staged}/excluded.csv", ["index"], EXCLUDED)
    storage.write_text(spark, f"{staged}/report.md", reporting.report(result.metrics, result.warnings()))
    page = reporting.review_page(result.metrics, result.contacts, result.excluded, result.grouped)
    storage.write_text(spark, f"{staged}/review.html", page)
    integrity.verify(
        result.records,
        files.read_csv(spark, f"{staged}/clean.csv", CLEAN),
        files.read_csv(spark, f"{staged}/excluded.csv", EXCLUDED),
        config.country_code,
    )
    for name in ("clean.csv", "excluded.csv", "report.md", "review.html"):
        storage.move(spark, f"{staged}/{name}", f"{out}/{name}")
    storage.remove(spark, staged)
    return result
