import html
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from contactmill.functions import text as T

NUMBER = "+4915100001234"
# Notations, and what each of them means; the rules behind them leave no other choice.
EMAILS = {
    "  Anna.Müller@Example.COM ": "", "  Anna.Mueller@Example.COM ": "anna.mueller@example.com",
    "<mailto:a@example.com>": "a@example.com", "info@gebäude-service.de": "info@gebäude-service.de",
    "John Doe <john@example.com>": "john@example.com", '"Doe, John" <John@Example.com>': "john@example.com", "Doe <>": "",
    "anna@xn--gebude-0ra.de": "anna@xn--gebude-0ra.de", "info@example.xn--p1ai": "info@example.xn--p1ai", "a@xn--.de": "",
    "a@example.com.,; ": "a@example.com", "<a@example.com> <b@example.com>": "a@example.com",
    **{bad: "" for bad in ["", "n/a", "none", "anna.example.com", "a@@example.com", "a@example", "a b@example.com", ".a@example.com",
                           "a..b@example.com", "a@example.c", "a@-example.com", "kein mail"]},
}
PHONES = {
    **{raw: NUMBER for raw in [
        "0151 0000 1234", "0151/00001234", "0151-0000-1234", "+49 151 0000 1234", "+49 (0)151 0000 1234", "0049 151 00001234",
        "(0151) 0000 1234", "Tel. 0151 0000 1234", "4915100001234", "+49 0151 00001234", "  +49151 00001234  ",
        "0049 0151 00001234", "49 0151 0000 1234", "0049 (0)151 00001234", "049 151 00001234", "(049) 151 0000 1234",
        "049/151/00001234", "Mobil: 0151 00001234", "(+49) 151 00001234"]},
    "04921 123456": "+494921123456", "49 30 123456": "+4930123456", "4930123456": "+4930123456", "49301234": "",
    "+43 664 000 1234": "+436640001234", "0043 664 0001234": "+436640001234", "+12345678": "", "+123456789": "+123456789",
    "+123456789012345": "+123456789012345", "+1234567890123456": "", "+49 00151 000012": "+490151000012",
    **{bad: "" for bad in ["", "n/a", "keine", "12345", "0151", "+49", "tel folgt", "0151 0000 1234 ext 5", "+0151 0000 1234",
                           "15100001234", "0151 0000 1234 / 0171 999 99 99 oder 5"]},
}
NAMES = {
    "ANNA  MÜLLER ": "Anna Müller", "anna müller": "Anna Müller", "VON DER HEIDE": "Von der Heide", "Anna McDonald": "Anna McDonald",
    "müller-meier o'neil": "Müller-Meier O'Neil", "abc": "abc", "": "", "l. brandt": "L. Brandt", "李小龙王": "李小龙王",
}
DATES = {
    "2024-03-17": "2024-03-17", "17.03.2024": "2024-03-17", "17.03.2024 14:30": "2024-03-17", "31.02.2024": "", "n/a": "",
    "2024-03-17T10:11:12": "2024-03-17", "2024-03-17 10:11:12": "2024-03-17", "2024-03-17 10:11:60": "", "2024-3-7": "2024-03-07",
    "7.3.2024": "2024-03-07", "2024-03- 7": "2024-03-07", "0000-01-01": "", "2024-03-17x": "", "29.02.2023": "", "2024-03-17 10:11": "",
}


def table(spark, values, **columns):
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", *[c.alias(n) for n, c in columns.items()])
    return {r["v"]: r for r in df.collect()}


@pytest.mark.parametrize("cases, function", [
    (EMAILS, T.normalize_email), (PHONES, T.normalize_phone), (NAMES, T.normalize_name), (DATES, T.iso_date),
])
def test_normalisers(spark, cases, function):
    got = table(spark, cases, x=function(F.col("v")))
    assert {v: r["x"] for v, r in got.items()} == cases


def test_other_country_and_validity(spark):
    got = table(spark, ["0664 0001234"], x=T.normalize_phone(F.col("v"), "43"))
    assert got["0664 0001234"]["x"] == "+436640001234"
    got = table(spark, [NUMBER, "+490151000012", "12", "+0123456789", None], x=T.is_valid_phone(F.col("v")))
    assert [got[v]["x"] for v in [NUMBER, "+490151000012", "12", "+0123456789", None]] == [True, False, False, False, False]


def test_clean_text_is_like_python(spark):
    rng = random.Random(2)
    odd = [chr(c) for c in range(0x3001) if chr(c).isspace()] + list(T.ZERO_WIDTH) + list("abä ")
    values = list({"".join(rng.choices(odd, k=12)) for _ in range(400)})
    got = table(spark, [*values, None], x=T.clean_text(F.col("v")))
    hidden = {ord(c): None for c in T.ZERO_WIDTH}
    for v in values:
        assert got[v]["x"] == re.sub(r"\s+", " ", v.translate(hidden)).strip(), repr(v)
    assert got[None]["x"] == ""


def test_letters_ratio_percent(spark):
    words = ["Ελλάδα", "Йосип Ёлкин", "김민준 한글", "Nguyễn Văn Đức", "№ 5 ™ ½ ㎏", "ﷺ", "𝔄𝔟", "ﾊﾝｶｸ", "Åse", "ⅳ", "Zoë", "Müller", "straße", "L. Brandt", "Ĳssel", "ﬁn", "Ａｂ", "Ŀ x 1²", "", "Łódź", "Ǆ"]
    got = table(spark, words, a=T.letters(F.col("v")), b=T.vowel_ratio(T.letters(F.col("v"))), c=T.name_letters(F.col("v")))
    for w in words:
        plain = "".join(c for c in unicodedata.normalize("NFKD", w.lower()) if c.isalpha() and not unicodedata.combining(c))
        assert got[w]["a"] == plain
        assert got[w]["b"] == (sum(c in T.VOWELS for c in plain) / len(plain) if plain else 1.0)
    assert got["L. Brandt"]["c"] == "brandt"
    pairs = [(a, b) for b in range(1, 41) for a in range(b + 1)]
    rows = spark.createDataFrame(pairs, "a int, b int").select("a", "b", T.percent(F.col("a") / F.col("b")).alias("p")).collect()
    assert all(r["p"] == f"{r['a'] / r['b']:.0%}".replace("%", " %") for r in rows)


def test_quoting_and_folding(spark):
    values = ["plain", "o'neil", 'say "x"', "both ' and \"", "back\\slash", "it's \\", "a\x07b", "soft\xadhyphen", "x\u2028y", "\U000e0001 ' \x9f", "ä€😀"]
    got = table(spark, values, x=T.quoted(F.col("v")))
    assert all(got[v]["x"] == repr(v) for v in values)
    got = table(spark, ["STRAẞE", "straße", "Müller"], x=T.casefold(F.col("v")))
    assert got["STRAẞE"]["x"] == got["straße"]["x"] == "strasse"


def test_thousands(spark):
    rows = spark.createDataFrame([(1,), (1326,), (12345678,)], "n long").select(T.thousands(F.col("n")).alias("x")).collect()
    assert [r["x"] for r in rows] == ["1", "1.326", "12.345.678"]


def test_slug_and_escape(spark):
    values = {"Jürgen Groß": "juergengross", "Zoë-Ähm 2²": "zoeaehm22", "": "", "李": ""}
    got = table(spark, values, x=T.slug(F.col("v")))
    assert {v: r["x"] for v, r in got.items()} == values
    odd = "a<b> & \"c\" 'd' &amp;"
    assert table(spark, [odd], x=T.escape_html(F.col("v")))[odd]["x"] == html.escape(odd)
