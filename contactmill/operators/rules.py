"""Exclusion reasons and suspect flags as arrays of (code, text)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactmill.config import Config
from contactmill.functions import text as T

# Shares of vowels and lengths that decide.
EXCLUDE_BELOW, SUSPECT_BELOW, CRYPTIC_BELOW = 0.10, 0.15, 0.12
MASH_LETTERS, CRYPTIC_LETTERS, PATTERN_DIGITS = 6, 7, 6
# The texts of reasons and flags.
REASONS = {
    "internal": "interne Adresse (konfigurierte Domain oder Adressliste)",
    "test_entry": "Testeintrag (passt auf ein konfiguriertes Testmuster)",
    "keyboard_mash": "Tastatur-Müll (Vokalanteil {})",
    "no_contact": "kein nutzbarer Kontaktweg (keine gültige E-Mail, keine gültige Telefonnummer)",
}
FLAGS = {
    "no_name": "kein Name",
    "low_vowel_share": "Name mit wenigen Vokalen ({})",
    "keyboard_pattern": "Name enthält ein Tastaturreihen-Muster",
    "digits_in_name": "Ziffern im Namen",
    "repeated_name": "Vor- und Nachname sind identisch",
    "cryptic_email": "Lokalteil der E-Mail wirkt zufällig",
    "odd_phone": "Die gesamte Telefonnummer ist ein Wiederholungs- oder Zahlenfolgemuster",
}
PAIRS = "array<struct<code:string,text:string>>"
_ROWS = "|".join(T.KEYBOARD.split())


def _pairs(cases: list[tuple[str, str, Column, Column | None]]) -> Column:
    out = []
    for code, text, holds, share in cases:
        before, _, after = text.partition("{}")
        full = F.concat(F.lit(before), T.percent(share), F.lit(after)) if share is not None else F.lit(text)
        out.append(F.when(holds, F.struct(F.lit(code).alias("code"), full.alias("text"))))
    return F.array_compact(F.array(*out)).cast(PAIRS)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def is_internal(email: Column, config: Config) -> Column:
    host = F.substring_index(email, "@", -1)
    hosts = _any([(host == d) | host.endswith("." + d) for d in config.internal_domains])
    return (email.isin(*config.internal_emails) | hosts) if config.internal_emails else hosts


def looks_like_test(value: Column, config: Config) -> Column:
    return (value != "") & _any([value.rlike(p) for p in config.test_patterns])


def is_digit_pattern(number: Column) -> Column:
    """All digits equal, or each one more or each one less than the digit before, modulo 10."""
    up, down = "1234567890" * 3, "0987654321" * 3
    run = F.lit(up).contains(number) | F.lit(down).contains(number)
    return (F.length(number) >= PATTERN_DIGITS) & (run | number.rlike(r"^(.)\1+\z"))


def with_letters(records: DataFrame) -> DataFrame:
    """Adds base (letters of the name without initials), base_all (with them) and ratio."""
    rows = records.withColumns({"base": T.name_letters(F.col("name")), "base_all": T.letters(F.col("name"))})
    return rows.withColumn("ratio", T.vowel_ratio(F.col("base")))


def exclusion_reasons(config: Config) -> Column:
    """All reasons in order of priority, over the columns of with_letters."""
    emails, base, ratio = F.col("emails"), F.col("base"), F.col("ratio")
    mash = (F.length(base) >= 4) & (ratio < EXCLUDE_BELOW)
    mash &= (F.length(base) >= MASH_LETTERS) | base.rlike(_ROWS)
    test = looks_like_test(F.col("name"), config) | looks_like_test(F.col("company"), config)
    return _pairs([
        ("internal", REASONS["internal"], F.exists(emails, lambda e: is_internal(e, config)), None),
        ("test_entry", REASONS["test_entry"], test | F.exists(emails, lambda e: looks_like_test(e, config)), None),
        ("keyboard_mash", REASONS["keyboard_mash"], mash, ratio),
        ("no_contact", REASONS["no_contact"], (F.size(emails) == 0) & (F.size("phones") == 0), None),
    ])


def suspect_flags(config: Config) -> Column:
    """All flags in order, over the columns of with_letters; meant for rows that are kept."""
    name, base, ratio = F.col("name"), F.col("base"), F.col("ratio")
    size, words = F.length(base), F.split(F.lower(name), " ")
    few = ((size >= 4) & (ratio < EXCLUDE_BELOW)) | ((size >= 5) & (ratio < SUSPECT_BELOW))

    def cryptic(email: Column) -> Column:
        local = T.letters(F.substring_index(email, "@", 1))
        return (F.length(local) >= CRYPTIC_LETTERS) & (T.vowel_ratio(local) < CRYPTIC_BELOW)

    def odd(phone: Column) -> Column:
        return is_digit_pattern(F.regexp_replace(phone, rf"^\+({config.country_code})?", ""))

    return _pairs([
        ("no_name", FLAGS["no_name"], name == "", None),
        ("low_vowel_share", FLAGS["low_vowel_share"], few, ratio),
        ("keyboard_pattern", FLAGS["keyboard_pattern"], F.col("base_all").rlike(_ROWS), None),
        ("digits_in_name", FLAGS["digits_in_name"], name.rlike(r"\p{Nd}"), None),
        ("repeated_name", FLAGS["repeated_name"], (F.size(words) == 2) & (F.get(words, F.lit(0)) == F.get(words, F.lit(1))), None),
        ("cryptic_email", FLAGS["cryptic_email"], F.exists("emails", cryptic), None),
        ("odd_phone", FLAGS["odd_phone"], F.exists("phones", odd), None),
    ])


def judge(records: DataFrame, config: Config) -> DataFrame:
    """records with reasons and flags; rows with a reason have no flags."""
    rows = with_letters(records).withColumn("reasons", exclusion_reasons(config))
    flags = F.when(F.size("reasons") == 0, suspect_flags(config)).otherwise(F.array().cast(PAIRS))
    return rows.withColumn("flags", flags).drop("base", "base_all", "ratio")
