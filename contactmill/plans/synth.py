"""Synthetic exports in two layouts, with a known outcome.

Everything is arithmetic on the row number and a seed, so any size is made by spark.range without
state. Special rows come in fixed shares; the rest are people with one, two or three rows (of 100
people 70, 22 and 8), which share addresses and numbers: the rows of three form a chain.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactmill import storage
from contactmill.sinks import files

# Shares of special rows, in thousandths.
SHARES = {
    "test": 30, "internal": 25, "internal_shared": 5, "mash": 20, "no_contact": 15, "mash_border": 15, "digits": 10,
    "repeat": 5, "cryptic": 10, "no_name": 10, "keyboard": 5,
}
REASON = {"test": "test_entry", "internal": "internal", "internal_shared": "internal", "mash": "keyboard_mash", "no_contact": "no_contact"}
# Headers of the two layouts.
LAYOUTS = {
    "a": {"id": "Contact ID", "name": "Full Name", "email": "Email", "phone": "Phone", "company": "Company", "city": "City", "created": "Created"},
    "b": {"id": "Kontakt-Nr", "first_name": "Vorname", "last_name": "Nachname", "email": "E-Mail", "phone": "Telefon",
          "phone_2": "Mobil", "company": "Firma", "city": "Ort", "created": "Erstellt am"},
}
_FIRST = "Anna Ben Clara David Elif Finn Greta Hanna Ida Jonas Käthe Lena Mara Noah Olga Paul Rosa Sven Tilda Uwe Zoë".split()
_LAST = "Albers Brandt Claus Dietz Ebert Fischer Gärtner Hoffmann Jansen Keller Lorenz Meier Neumann Otto Peters Richter Sauer Thiel Ulrich Vogel Weber".split()
_CITY = "Köln Bonn Mainz Ulm Kiel Trier Essen".split()
_PER_BLOCK = 70 + 22 * 2 + 8 * 3


def _pick(words: list[str], at: Column) -> Column:
    return F.get(F.array(*map(F.lit, words)), F.pmod(at, F.lit(len(words))).cast("int"))


def build(spark: SparkSession, n: int, seed: int) -> DataFrame:
    """n rows: layout, kind, entity, the canonical fields, and order (the place in the export)."""
    counts = {k: n * share // 1000 for k, share in SHARES.items()}
    kind, start = F.lit("person"), 0
    for name, count in counts.items():
        kind = F.when((F.col("i") >= start) & (F.col("i") < start + count), name).otherwise(kind)
        start += count
    rows = spark.range(n).withColumnRenamed("id", "i").withColumn("kind", kind)
    place = F.col("i") - start
    block, at = F.floor(place / _PER_BLOCK), F.pmod(place, F.lit(_PER_BLOCK))
    inside = F.when(at < 70, at).when(at < 114, 70 + F.floor((at - 70) / 2)).otherwise(92 + F.floor((at - 114) / 3))
    part = F.when(at < 70, 0).when(at < 114, F.pmod(at - 70, F.lit(2))).otherwise(F.pmod(at - 114, F.lit(3)))
    person = F.col("kind") == "person"
    rows = rows.withColumns({
        "entity": F.when(person, block * 100 + inside).otherwise(F.lit(n) + F.col("i")).cast("long"),
        "part": F.when(person, part).otherwise(0).cast("int"),
        "h": F.xxhash64(F.lit(seed), F.col("i")),
    })
    rows = rows.withColumn("e", F.xxhash64(F.lit(seed), F.lit(1), F.col("entity")))
    first, last = _pick(_FIRST, F.col("e")), _pick(_LAST, F.shiftright("e", 9))
    k = F.col("kind")
    rows = rows.withColumns({
        "first": F.when(k == "test", "Test").when(k == "mash", "Xkjhsd").when(k == "mash_border", "Bertschlk").when(k == "keyboard", "Asdfi")
        .when(k == "no_name", "").when((F.col("part") == 1) & (F.pmod("h", F.lit(3)) == 0), F.concat(F.left(first, F.lit(1)), F.lit("."))).otherwise(first),
        "last": F.when(k == "test", "Test").when(k == "mash", "Qwrtpl").when(k == "mash_border", "Kranz").when(k == "keyboard", "Qweru")
        .when(k == "no_name", "").when(k == "repeat", first).when(k == "digits", F.concat(last, F.lit(" 2"))).otherwise(last),
    })
    domain = F.when(k.startswith("internal"), "example.org").otherwise("example.com")
    local = F.when(k == "cryptic", "xkcvbnmqz").when(k == "test", "probe").otherwise("kontakt")
    # the third row of a person has an address of its own and the number of the second
    own = F.concat(local, F.lit("."), F.col("entity").cast("string"), F.when(F.col("part") == 2, ".b").otherwise(""), F.lit("@"), domain)
    digits = F.lpad(F.col("entity").cast("string"), 8, "0")
    # the first of three has no number, so that only the second links the other two
    silent = (F.col("part") == 0) & person & (at >= 114) | (k == "no_contact")
    shared = F.when(k == "internal_shared", F.lpad(F.lit("70"), 8, "0")).otherwise(digits)
    phone = F.concat(F.lit("0151"), shared)
    form = F.pmod("h", F.lit(4))
    rows = rows.withColumns({
        "layout": F.when(F.pmod(F.shiftright("h", 5), F.lit(2)) == 0, "a").otherwise("b"),
        "email": F.when(k == "no_contact", F.when(form == 0, "n/a").otherwise("")).when(form == 0, F.upper(own)).when(form == 1, F.concat(F.lit(" "), own))
        .when(form == 2, F.concat(F.lit("<"), own, F.lit(">"))).otherwise(own),
        "phone": F.when(silent, F.when(form == 1, "12345").otherwise("")).when(form == 0, phone)
        .when(form == 1, F.concat(F.lit("+49 (0)151 "), shared)).when(form == 2, F.concat(F.lit("0049 151/"), shared)).otherwise(F.concat(F.lit("Tel. 0151 "), shared)),
        "phone_2": F.lit(""),
        "company": F.when(F.pmod(F.shiftright("h", 8), F.lit(3)) == 0, "").otherwise(F.concat(F.lit("Firma "), F.pmod("e", F.lit(50)).cast("string"))),
        "city": _pick(_CITY, F.col("e")),
        "day": F.date_add(F.lit("2020-01-01").cast("date"), F.pmod("h", F.lit(1500)).cast("int")),
    })
    case = F.pmod(F.shiftright("h", 11), F.lit(5))
    name = F.trim(F.concat_ws(" ", "first", "last"))
    name = F.when(case == 0, F.upper(name)).when(case == 1, F.lower(name)).otherwise(name)
    plain = ~k.isin("no_name", "digits") & (F.col("layout") == "a")
    return rows.select(
        "layout", "kind", "entity", F.xxhash64(F.lit(seed), F.lit(2), F.col("i")).alias("order"),
        F.concat(F.lit("K"), F.lpad(F.col("i").cast("string"), 7, "0")).alias("id"),
        F.when(plain, name).otherwise(F.trim(F.concat_ws(" ", "first", "last"))).alias("name"),
        F.col("first").alias("first_name"), F.col("last").alias("last_name"),
        "email", "phone", "phone_2", "company", "city",
        F.when(F.col("layout") == "a", F.date_format("day", "yyyy-MM-dd")).otherwise(F.date_format("day", "dd.MM.yyyy")).alias("created"),
    )


def truth(rows: DataFrame) -> dict:
    """What a run over the rows must find, from their making alone."""
    kinds = {r["kind"]: (r["n"], r["e"]) for r in rows.groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("entity").alias("e")).collect()}
    reasons: dict[str, int] = {}
    for kind, (n, _) in kinds.items():
        if kind in REASON:
            reasons[REASON[kind]] = reasons.get(REASON[kind], 0) + n
    people, persons = kinds.get("person", (0, 0))
    total = sum(n for n, _ in kinds.values())
    excluded = sum(reasons.values())
    return {"n_input": total, "n_excluded": excluded, "n_absorbed": people - persons, "n_output": total - excluded - people + persons, "reasons": reasons}


def write(spark: SparkSession, n: int, seed: int, out: str) -> dict:
    """Write export_a.csv, export_b.csv and truth.json to a folder."""
    storage.make_folder(spark, out)
    rows = build(spark, n, seed)
    for layout, headers in LAYOUTS.items():
        part = rows.where(F.col("layout") == layout)
        part = part.select("order", *[F.col(f).alias(h) for f, h in headers.items()])
        files.write_csv(part, f"{out}/export_{layout}.csv", ["order"], list(headers.values()))
    known = truth(rows)
    storage.write_text(spark, f"{out}/truth.json", [json.dumps(known, indent=1, sort_keys=True)])
    return known
