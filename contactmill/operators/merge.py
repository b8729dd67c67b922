"""Grouping of records that share an address or a number, and merging of each group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactmill.functions import text as T
from contactmill.operators.components import connected_components

MARK = " | "


def contact_keys(records: DataFrame) -> DataFrame:
    """(index, key): each record's addresses and numbers, in name spaces of their own."""
    tagged = F.concat(
        F.transform("emails", lambda e: F.concat(F.lit("m:"), e)),
        F.transform("phones", lambda p: F.concat(F.lit("t:"), p)),
    )
    return records.select("index", F.explode(tagged).alias("key"))


def key_edges(records: DataFrame) -> DataFrame:
    """(u, v): each record linked to the first record with one of its keys: a star for each key,
    so that a key that very many records share costs no more than their number."""
    keys = contact_keys(records)
    first = keys.groupBy("key").agg(F.min("index").alias("v"))
    return keys.join(first, "key").where("index <> v").select(F.col("index").alias("u"), "v").distinct()


def with_components(records: DataFrame) -> DataFrame:
    """records with the least index of each one's group in `component`."""
    found = connected_components(key_edges(records)).withColumnRenamed("node", "index")
    joined = records.join(found, "index", "left")
    return joined.withColumn("component", F.coalesce("component", "index"))


def completeness():
    filled = [F.when(F.col(c) != "", 1).otherwise(0) for c in ("name", "company", "city", "created")]
    return sum(filled[1:], filled[0]) + F.size("emails") + F.size("phones")


def with_place(grouped: DataFrame) -> DataFrame:
    """Adds place, by which the records of a component are ranked: the most complete one first, the
    earlier one on a tie."""
    return grouped.withColumn("place", F.struct((-completeness()).alias("rank"), "index"))


def merge_contacts(grouped: DataFrame) -> DataFrame:
    """One contact for each component.

    Single fields come from minima by place, lists from the first place of each distinct value, all
    by partial aggregation: of a component with very many members no task holds more than what its
    contact says of them. Nulls do not occur in records; a component is never empty.
    """
    rows = with_place(grouped)
    given = F.col("name") != ""

    def first(column: str, holds=None):
        holds = F.col(column) != "" if holds is None else holds
        return F.min_by(column, F.when(holds, F.col("place")))

    spelled = given & ~F.col("name").rlike(r"[\p{L}\p{N}_]\.")
    single = rows.groupBy("component").agg(
        F.min_by("uid", "place").alias("id"),
        F.min_by("index", "place").alias("leader_index"),
        F.coalesce(first("name", spelled), first("name"), F.lit("")).alias("name"),
        F.coalesce(first("company"), F.lit("")).alias("company"),
        F.coalesce(first("city"), F.lit("")).alias("city"),
        F.coalesce(F.min(F.when(F.col("created") != "", F.col("created"))), F.lit("")).alias("created"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.array_sort(F.collect_list(F.struct("place", "uid"))).alias("ranked"),
        F.count("*").cast("int").alias("n_members"),
    )

    def item(kind: str, text, at, code=None, each=None):
        """each: tells apart values that count every time."""
        return F.struct(
            F.lit(kind).alias("kind"), text.alias("text"), (code if code is not None else F.lit("")).alias("code"),
            (each if each is not None else F.lit("")).alias("each"), at.alias("at"),
        )

    noted = F.transform(
        "unusable",
        lambda u, i: item(
            "note", F.concat(u["text"], F.lit(" ("), F.col("uid"), F.lit(")")), i, each=F.concat("uid", F.lit(" "), i.cast("string"))
        ),
    )
    items = F.concat(
        F.transform("emails", lambda v, i: item("email", v, i)),
        F.transform("phones", lambda v, i: item("phone", v, i)),
        F.transform("flags", lambda f, i: item("flag", f["text"], i, f["code"])),
        F.filter(F.array(item("name", F.col("name"), F.lit(0))), lambda x: x["text"] != ""),
        noted,
    )
    values = rows.select("component", "place", F.explode(items).alias("x"))
    values = values.groupBy("component", "x.kind", "x.text", "x.code", "x.each").agg(
        F.min(F.struct("place", "x.at")).alias("first")
    )
    kinds = ("email", "phone", "flag", "name", "note")
    listed = values.groupBy("component").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("first", "text", "code")))).alias(f"of_{k}") for k in kinds
    ])
    contacts = single.join(listed, "component", "left")
    contacts = contacts.withColumns({f"of_{k}": F.coalesce(f"of_{k}", F.array().cast(listed.schema[f"of_{k}"].dataType)) for k in kinds})

    def texts(kind: str):
        return F.transform(f"of_{kind}", lambda v: v["text"])

    others = F.filter(texts("name"), lambda n: T.casefold(n) != T.casefold(F.col("name")))
    return contacts.select(
        "component", "id", "leader_index", "name", "company", "city", "created",
        texts("email").alias("emails"),
        texts("phone").alias("phones"),
        F.concat(F.transform(others, lambda n: F.concat(F.lit("auch erfasst als: "), n)), texts("note")).alias("notes"),
        F.transform("of_flag", lambda v: F.struct(v["code"].alias("code"), v["text"].alias("text"))).alias("flags"),
        F.transform(F.slice("ranked", 2, F.size("ranked")), lambda m: m["uid"]).alias("merged_from"),
        "sources", "n_members",
    )


def clean_rows(contacts: DataFrame) -> DataFrame:
    """The rows of the clean table, all strings; component tells their order."""

    def cell(column: str, at: int):
        return F.coalesce(F.get(column, F.lit(at)), F.lit(""))

    def rest(column: str):
        return F.array_join(F.slice(column, 3, F.greatest(F.size(column), F.lit(1))), MARK)

    return contacts.select(
        "component",
        "id",
        "name",
        "company",
        "city",
        cell("emails", 0).alias("email"),
        cell("emails", 1).alias("email_2"),
        rest("emails").alias("more_emails"),
        cell("phones", 0).alias("phone"),
        cell("phones", 1).alias("phone_2"),
        rest("phones").alias("more_phones"),
        "created",
        F.array_join("sources", MARK).alias("sources"),
        F.array_join("merged_from", MARK).alias("merged_from"),
        F.when(F.size("flags") > 0, "yes").otherwise("").alias("suspect"),
        F.array_join(F.transform("flags", lambda f: f["text"]), "; ").alias("suspect_reasons"),
        F.array_join("notes", "; ").alias("notes"),
    )


def excluded_rows(excluded: DataFrame) -> DataFrame:
    """The rows of the excluded table; index tells their order."""
    return excluded.select(
        "index",
        F.col("uid").alias("id"),
        "source",
        "row",
        "name",
        F.array_join("raw_emails", MARK).alias("email"),
        F.array_join("raw_phones", MARK).alias("phone"),
        F.array_join("emails", MARK).alias("email_normalized"),
        F.array_join("phones", MARK).alias("phone_normalized"),
        F.get("reasons", F.lit(0))["code"].alias("reason_code"),
        F.array_join(F.transform("reasons", lambda r: r["text"]), "; ").alias("reason"),
    )
