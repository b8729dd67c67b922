import random

import pytest
from pyspark.sql import functions as F

from contactmill.config import Config
from contactmill.operators import integrity, merge, rules
from contactmill.operators.components import connected_components
from contactmill.session import materialise
from contactmill.sources.csv import KINDS

CONFIG = Config(
    internal_domains=("example.org",), internal_emails=("support@example.com",),
    test_patterns=(r"(?iuU)\btest\b", r"(?iuU)\btest\d*@", r"(?iuU)\bmustermann\b"),
)
SCHEMA = (
    "uid string, source string, row int, index long, name string, company string, city string, created string, "
    "emails array<string>, phones array<string>, raw_emails array<string>, raw_phones array<string>, "
    "unusable array<struct<kind:string,value:string,text:string>>"
)


def record(i, name="Anna Meier", emails=(), phones=(), company="", city="", created="", unusable=()):
    bad = [(KINDS["email"], v, f"{KINDS['email']} '{v}'") for v in unusable]
    return (f"a:{i}", "a", i, i, name, company, city, created, list(emails), list(phones), list(emails), list(phones), bad)


def judged(spark, rows):
    return rules.judge(spark.createDataFrame(rows, SCHEMA), CONFIG)


def test_reasons(spark):
    cases = [
        (dict(emails=["anna.mueller@example.com"], phones=["+4915100001234"]), []),
        (dict(emails=["kim@example.org"]), ["internal"]), (dict(emails=["kim@team.example.org"]), ["internal"]),
        (dict(emails=["support@example.com"]), ["internal"]), (dict(emails=["kim@notexample.org"]), []),
        (dict(name="Test Test", emails=["x@example.com"]), ["test_entry"]),
        (dict(name="Max Mustermann", emails=["x@example.com"]), ["test_entry"]),
        (dict(company="ein Test", emails=["x@example.com"]), ["test_entry"]),
        (dict(name="Xkjhsd Qwrtpl", emails=["x@example.com"]), ["keyboard_mash"]),
        (dict(name="Plch", emails=["x@example.com"]), []), (dict(name="Krmpfl", emails=["x@example.com"]), ["keyboard_mash"]),
        (dict(name="Hjkl", emails=["x@example.com"]), ["keyboard_mash"]), (dict(name="L. Brandt", emails=["x@example.com"]), []),
        (dict(), ["no_contact"]), (dict(name="Test Test"), ["test_entry", "no_contact"]),
    ]
    rows = judged(spark, [record(i, **c) for i, (c, _) in enumerate(cases)]).orderBy("index").collect()
    assert [[r["code"] for r in row["reasons"]] for row in rows] == [want for _, want in cases]
    texts = {r["code"]: r["text"] for row in rows for r in row["reasons"]}
    assert texts["keyboard_mash"] in ("Tastatur-Müll (Vokalanteil 0 %)",)
    assert all(not row["flags"] for row in rows if row["reasons"])


def test_flags(spark):
    ok = ["anna.mueller@example.com"]
    odd = ["+4911111111", "+4912345678", "+4987654321", "+491234567890", "+499876543210"]
    fine = ["+49891234567", "+493012345678", "+4915100000000", "+4915100001234", "+4915112345670"]
    cases = [
        (dict(emails=ok, phones=["+4915100001234"]), []), (dict(emails=ok, name="Anna Müller 2"), ["digits_in_name"]),
        (dict(emails=ok, name="Lena Lena"), ["repeated_name"]), (dict(emails=ok, name=""), ["no_name"]),
        (dict(emails=ok, name="Asdfg Qwertu"), ["keyboard_pattern"]), (dict(emails=ok, name="Plch"), ["low_vowel_share"]),
        (dict(emails=ok, name="Bertschlk Kranz"), ["low_vowel_share"]), (dict(emails=ok, name="Jan Strnad"), []),
        (dict(emails=["xkcvbnmqz@example.com"]), ["cryptic_email"]), (dict(emails=["schmidt@example.com"]), []),
        *[(dict(emails=ok, phones=[p]), ["odd_phone"]) for p in odd], *[(dict(emails=ok, phones=[p]), []) for p in fine],
    ]
    rows = judged(spark, [record(i, **c) for i, (c, _) in enumerate(cases)]).orderBy("index").collect()
    assert [[f["code"] for f in row["flags"]] for row in rows] == [want for _, want in cases]


def components_of(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(60)], [(i + 1, i) for i in range(0, 60, 2)], [(5, 5), (7, 3), (3, 7), (3, 7)],
    [(0, i) for i in range(1, 80)] + [(200, i) for i in range(79, 120)],
    [(random.Random(9).randrange(i + 1), i + 1) for i in range(50)],
])
def test_components(spark, edges):
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in got} == components_of(edges)


def test_components_edges(spark):
    df = spark.createDataFrame([(None, 1), (2, None)], "u long, v long")
    assert connected_components(df).count() == 0
    assert connected_components(df.limit(0)).count() == 0


def merged(spark, rows):
    kept = judged(spark, rows).where(F.size("reasons") == 0)
    return merge.merge_contacts(merge.with_components(kept))


def test_grouping_and_merging(spark):
    rows = [
        record(1, "L. Brandt", ["a@example.com"]),
        record(2, "Lena Brandt", ["a@example.com"], ["+4915100000001"], "Firma", "Köln", "2024-02-01"),
        record(3, "LENA Brandt", [], ["+4915100000001"], city="Bonn", created="2023-01-01", unusable=["n/a"]),
        record(4, "Kim", ["kim@example.org"], ["+4915100000001"]),
        record(5, "Ben", ["b@example.com"], ["+4915100000009"]),
        record(6, "Ben 2", ["b@example.com", "c@example.com"]), record(7, "Ben 2", ["d@example.com", "b@example.com", ]),
    ]
    got = {r["id"]: r for r in merged(spark, rows).collect()}
    assert sorted(got) == ["a:2", "a:5"]
    lena = got["a:2"]
    assert (lena["name"], lena["company"], lena["city"], lena["created"]) == ("Lena Brandt", "Firma", "Köln", "2023-01-01")
    assert lena["merged_from"] == ["a:3", "a:1"] and lena["n_members"] == 3 and lena["component"] == 1
    assert lena["notes"] == ["auch erfasst als: L. Brandt", "unbrauchbare E-Mail 'n/a' (a:3)"]
    ben = got["a:5"]  # as complete as the next one, but earlier
    assert ben["notes"] == ["auch erfasst als: Ben 2"]
    assert ben["emails"] == ["b@example.com", "c@example.com", "d@example.com"]
    assert [f["code"] for f in ben["flags"]] == ["digits_in_name"]
    rows = merge.clean_rows(merged(spark, rows)).orderBy("component").collect()
    assert [r["more_emails"] for r in rows] == ["", "d@example.com"] and [r["suspect"] for r in rows] == ["", "yes"]


def tables(spark):
    rows = judged(spark, [
        record(1, emails=["a@example.com"], phones=["+4915100000001"]), record(2, "Ben", ["a@example.com"]),
        record(3, "Kim", ["kim@example.org"]), record(4, "Ida", ["i@example.com"], ["+4915100000004"], created="2024-01-01"),
    ])
    rows, _ = materialise(rows)
    clean = merge.clean_rows(merge.merge_contacts(merge.with_components(rows.where(F.size("reasons") == 0))))
    return rows, clean, merge.excluded_rows(rows.where(F.size("reasons") > 0))


def test_checks_find_tampering(spark):
    rows, clean, excluded = tables(spark)
    clean = spark.createDataFrame(clean.collect(), clean.schema)
    integrity.verify(rows, clean, excluded)

    def broken(**changes):
        return clean.withColumns({c: F.when(F.col("id") == "a:4", F.lit(v)).otherwise(F.col(c)) for c, v in changes.items()})

    for name, bad in {
        "dropped": clean.where("id <> 'a:4'"), "counted twice": clean.union(clean.where("id = 'a:4'")), "other id": broken(id="a:9"),
        "lost address": broken(email=""), "lost number": broken(phone=""), "repeated": broken(email_2="a@example.com"),
        "upper case": broken(email_2="X@example.com"), "bad number": broken(phone_2="+4901510000000"), "no E.164": broken(phone_2="0151"),
        "date": broken(created="1.1.2024"), "mark": broken(suspect="no"), "merged": broken(merged_from="a:1"),
    }.items():
        with pytest.raises(integrity.IntegrityError):
            integrity.verify(rows, bad, excluded)
            pytest.fail(name)
    with pytest.raises(integrity.IntegrityError):
        integrity.verify(rows, clean, excluded.limit(0))
    with pytest.raises(integrity.IntegrityError):
        integrity.require_balance(4, a=1, b=1, c=1)
