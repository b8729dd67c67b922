"""Contacts derived from the customer table, by arithmetic that Spark and DuckDB share.

The tables hold no addresses or numbers; these make some that look like two exports: layout a and
layout b, with notations, mistakes and shared keys dealt out by the customer's number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactmill import storage
from contactmill.config import Config
from contactmill.operators import rules
from contactmill.session import materialise
from contactmill.sinks import files
from contactmill.sources import csv as source

CONFIG = Config(
    country_code="49",
    internal_domains=("example.org",),
    internal_emails=("support@example.com",),
    test_patterns=(r"(?iuU)\btest\b", r"(?iuU)\bmustermann\b"),
)

_FIRST, _LAST = "Anna|Zoë|Jürgen|Ben|Lena|Mäx|Tom", "Müller|Brandt|Köhler|von Heide|Strnad|Schmidt"
_MAIL = "concat('p', cast(b as string), 'x', cast((k * 11) % 1409 as string), '@example.', case when k % 40 = 3 then 'org' else 'com' end)"
_NUMBER = "concat(lpad(cast(b as string), 4, '0'), lpad(cast((k * 7) % 1201 as string), 4, '0'))"
_SHORT = "concat(lpad(cast(b as string), 4, '0'), ' ', lpad(cast((k * 7) % 1201 as string), 4, '0'))"

#: Columns in steps; each step may use the names of those before it.
STEPS: list[dict[str, str]] = [
    {
        "k": "c_custkey",
        "b": "cast(floor(c_custkey / 1500) as bigint)",
        "nation": "c_nationkey",
    },
    {
        "first": f"split_part('{_FIRST}', '|', cast(k % 7 + 1 as int))",
        "last": f"split_part('{_LAST}', '|', cast(k % 6 + 1 as int))",
        "mail": _MAIL,
        "number": _NUMBER,
        "short": _SHORT,
    },
    {
        "source": "case when k % 2 = 0 then 'a' else 'b' end",
        "given_id": "case when k % 17 = 0 then '' when k % 101 = 50 then cast(k - 2 as string) else cast(k as string) end",
        "raw_name": "case when k % 50 = 7 then 'Test Tester' when k % 50 = 9 then 'Xkjhsd Qwrtpl' when k % 50 = 11 then '' "
        "when k % 97 = 5 then concat(first, ' ', last, ' 2') when k % 89 = 6 then concat(first, ' ', first) "
        "when k % 73 = 12 then 'Asdfg Qwert' when k % 71 = 20 then 'Plch' when k % 67 = 21 then 'Bertschlk Kranz' "
        "when k % 5 = 0 then upper(concat(first, ' ', last)) when k % 5 = 1 then concat(substring(first, 1, 1), '. ', last) "
        "when k % 5 = 2 then lower(concat(first, '  ', last)) else concat(first, ' ', last) end",
        "raw_email": "case when k % 9 = 4 then '' when k % 50 = 13 then 'n/a' "
        "when k % 83 = 8 then concat('xkcvbnmqz@example', cast(k as string), '.com') "
        "when k % 4 = 0 then upper(mail) when k % 4 = 1 then concat('  ', mail, ' ') "
        "when k % 4 = 2 then concat(first, ' <', mail, '>') else concat('mailto:', mail, ';') end",
        "raw_phone": "case when k % 7 = 2 then '' when k % 50 = 13 then '12345' when k % 79 = 10 then '+49 11111111' "
        "when k % 12 = 0 then concat('0151 ', short) when k % 12 = 1 then concat('0151/', number) "
        "when k % 12 = 2 then concat('+49 151 ', short) when k % 12 = 3 then concat('+49 (0)151 ', short) "
        "when k % 12 = 4 then concat('0049 151 ', number) when k % 12 = 5 then concat('(0151) ', short) "
        "when k % 12 = 6 then concat('Tel. 0151 ', short) when k % 12 = 7 then concat('49151', number) "
        "when k % 12 = 8 then concat('+49 0151 ', number) when k % 12 = 9 then concat('049 151 ', number) "
        "when k % 12 = 10 then concat('0151-', number) else concat('0151 ', short, ' ext 5') end",
        "raw_created": "case when k % 4 = 0 then concat('2024-', lpad(cast(k % 12 + 1 as string), 2, '0'), '-', lpad(cast(k % 28 + 1 as string), 2, '0')) "
        "when k % 4 = 1 then concat(cast(k % 28 + 1 as string), '.', cast(k % 12 + 1 as string), '.2023') "
        "when k % 4 = 2 then '31.02.2024' else '' end",
        "raw_email_2": "case when k % 6 = 0 then concat(' ', upper(mail)) when k % 6 = 1 then concat('<zweite', cast(k as string), '@example.net>') "
        "when k % 47 = 2 then 'keine' else '' end",
        "raw_phone_2": "case when k % 5 = 0 then concat('0049 151 ', number) when k % 5 = 1 then concat('0171/', number) "
        "when k % 43 = 3 then 'folgt' else '' end",
        "raw_company": "case when k % 3 = 0 then '' else concat(' Firma  ', cast(nation as string)) end",
        "raw_city": "case when k % 4 = 1 then '' else concat('Ort ', cast(k % 6 as string)) end",
    },
]


def contacts_sql() -> str:
    """A query text for DuckDB: all columns of the view."""
    query = "customer"
    for i, step in enumerate(STEPS):
        query = f"(SELECT *, {', '.join(f'{e} AS {n}' for n, e in step.items())} FROM {query}) AS s{i}"
    return f"SELECT * FROM {query}"


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    for step in STEPS:
        df = df.selectExpr("*", *(f"{e} as {n}" for n, e in step.items()))
    return df


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contacts as rows of two exports in canonical fields; layout b has first and last names."""
    view = contacts(spark, sf_dir)
    given = F.col("source") == "a"
    clean = {f: source.T.clean_text(F.col(f"raw_{f}")) for f in ("name", "email", "phone", "company", "city", "created")}
    return view.select(
        "source", F.concat("source", F.lit(".csv")).alias("file"), F.col("k").alias("index"), F.col("k").cast("int").alias("row"),
        F.col("given_id").alias("id"),
        F.when(given, clean["name"]).otherwise("").alias("name"),
        F.when(given, "").otherwise(F.substring_index(clean["name"], " ", 1)).alias("first_name"),
        F.when(given | ~clean["name"].contains(" "), "").otherwise(F.expr("substring(trim(regexp_replace(raw_name, ' +', ' ')), "
               "instr(trim(regexp_replace(raw_name, ' +', ' ')), ' ') + 1)")).alias("last_name"),
        clean["email"].alias("email"), F.lit("").alias("email_2"), clean["phone"].alias("phone"), F.lit("").alias("phone_2"),
        clean["company"].alias("company"), clean["city"].alias("city"), clean["created"].alias("created"),
    )


# Headers of the two layouts that the contacts are exported in.
LAYOUTS = {
    "a": {"id": "Contact ID", "name": "Full Name", "email": "Email", "email_2": "Email 2", "phone": "Phone", "phone_2": "Phone 2",
          "company": "Company", "city": "City", "created": "Created"},
    "b": {"id": "Kontakt-Nr", "first_name": "Vorname", "last_name": "Nachname", "email": "E-Mail", "email_2": "E-Mail 2",
          "phone": "Telefon", "phone_2": "Mobil", "company": "Firma", "city": "Ort", "created": "Erstellt am"},
}


def settings() -> dict:
    """The settings for the exports, as a TOML document holds them."""
    return {
        "phone": {"default_country_code": "49"},
        "exclude": {
            "internal_domains": ["@Example.org"], "internal_emails": ["Support@example.com"],
            "test_patterns": [r"\btest\b", r"\bmustermann\b"],
        },
        "source": [{"match": f"export_{x}.csv", "columns": columns} for x, columns in LAYOUTS.items()],
    }


def export(spark: SparkSession, sf_dir: str, folder: str, second: bool = True) -> None:
    """Write the contacts as two CSV files, as they are given; second: with second addresses and numbers."""
    view = contacts(spark, sf_dir)
    name = source.T.clean_text(F.col("raw_name"))
    cells = {
        "id": F.col("given_id"), "name": F.col("raw_name"), "first_name": F.substring_index(name, " ", 1),
        "last_name": F.when(name.contains(" "), F.substr(name, F.instr(name, " ") + 1)).otherwise(""),
        **{f: F.col(f"raw_{f}") for f in ("email", "phone", "company", "city", "created")},
        **{f: F.col(f"raw_{f}") if second else F.lit("") for f in ("email_2", "phone_2")},
    }
    storage.make_folder(spark, folder)
    for layout, headers in LAYOUTS.items():
        rows = view.where(F.col("source") == layout).select("k", *[cells[f].alias(h) for f, h in headers.items()])
        files.write_csv(rows, f"{folder}/export_{layout}.csv", ["k"], list(headers.values()))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contacts as records with reasons and flags, written to the shared folder once."""
    rows = source.with_uids(raw_rows(spark, sf_dir))
    out, _ = materialise(rules.judge(source.to_records(rows, CONFIG), CONFIG), "records")
    return out
