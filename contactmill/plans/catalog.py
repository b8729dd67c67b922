"""Named queries over the benchmark tables, and the SQL that each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactmill.functions import text as T
from contactmill.operators import integrity, merge, rules
from contactmill.plans import contacts as C
from contactmill.session import materialise
from contactmill.sources import csv as source

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


# ---------------------------------------------------------------- SQL parts

_WHITE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def s_clean(x: str) -> str:
    visible = rf"regexp_replace(coalesce({x}, ''), '[\x{{200b}}-\x{{200d}}\x{{2060}}\x{{feff}}]', '', 'g')"
    return f"trim(regexp_replace({visible}, '{_WHITE}', ' ', 'g'))"


_EMAIL = (
    r"[a-z0-9_%+''-]+(\.[a-z0-9_%+''-]+)*@([\p{L}\p{N}]+(-+[\p{L}\p{N}]+)*\.)+"
    r"([\p{L}\p{Nl}\p{No}]{2,}|xn--[a-z0-9-]*[a-z0-9])"
)


def s_email(x: str) -> str:
    """A scalar subquery that walks the steps by name."""
    return rf"""(SELECT CASE WHEN regexp_full_match(e, '{_EMAIL}') THEN e ELSE '' END FROM (
      SELECT regexp_replace(regexp_replace(s, '^mailto:', ''), '[.,; ]+$', '') AS e FROM (
      SELECT regexp_replace(CASE WHEN a <> '' THEN a ELSE v END, '^[<> ]+|[<> ]+$', '', 'g') AS s FROM (
      SELECT v, regexp_extract(v, '< ?([^<> ]+) ?>', 1) AS a FROM (SELECT lower({s_clean(x)}) AS v)))))"""


def s_phone(x: str, cc: str = "49") -> str:
    return rf"""(SELECT CASE WHEN v <> '' AND NOT regexp_matches(v, '[^0-9 +()./\x{{2010}}-\x{{2015}}-]') AND d <> ''
        AND NOT starts_with(j, '0') AND length(j) BETWEEN 9 AND 15 THEN '+' || j ELSE '' END FROM (
      SELECT v, d, regexp_replace(i, '^{cc}0', '{cc}') AS j FROM (
      SELECT v, d, CASE WHEN starts_with(v, '+') THEN d WHEN starts_with(d, '00') THEN substr(d, 3)
        WHEN starts_with(d, '0') AND regexp_matches(v, '^\(?0{cc}[ ./)-]') THEN substr(d, 2)
        WHEN starts_with(d, '0') THEN '{cc}' || substr(d, 2)
        WHEN starts_with(d, '{cc}') AND length(d) >= 10 THEN d ELSE '' END AS i FROM (
      SELECT v, regexp_replace(v, '[^0-9]', '', 'g') AS d FROM (
      SELECT regexp_replace(regexp_replace({s_clean(x)}, '(?i)^(tel|telefon|phone|mobil|mobile|handy|fon)\b\.? ?:? ?', ''),
        '\( ?0 ?\)', '', 'g') AS v)))))"""


_TITLE = (
    "array_to_string(list_transform(regexp_extract_all({w}, '\\p{{L}}+|\\P{{L}}+'), "
    "lambda p: upper(substr(p, 1, 1)) || lower(substr(p, 2))), '')"
)
_PARTICLE_LIST = "[" + ", ".join(f"'{p}'" for p in T.PARTICLES.split()) + "]"


def s_name(x: str) -> str:
    title = _TITLE.format(w="w")
    return rf"""(SELECT CASE WHEN length(regexp_replace(v, '\P{{L}}', '', 'g')) >= 4 AND (upper(v) = v OR lower(v) = v)
        AND upper(v) <> lower(v) THEN array_to_string(list_transform(string_split(lower(v), ' '), lambda w, i:
        CASE WHEN i > 1 AND list_contains({_PARTICLE_LIST}, w) THEN w ELSE {title} END), ' ') ELSE v END
      FROM (SELECT {s_clean(x)} AS v))"""


def s_date(x: str) -> str:
    return rf"""(SELECT coalesce(strftime(try_cast(CASE WHEN regexp_full_match(v, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}([Tt ][0-9]{{1,2}}:[0-9]{{1,2}}:[0-9]{{1,2}})?')
        THEN lpad(split_part(d, '-', 1), 4, '0') || '-' || lpad(split_part(d, '-', 2), 2, '0') || '-' || lpad(split_part(d, '-', 3), 2, '0')
        WHEN regexp_full_match(v, '[0-9]{{1,2}}\.[0-9]{{1,2}}\.[0-9]{{4}}( [0-9]{{1,2}}:[0-9]{{1,2}})?')
        THEN split_part(d, '.', 3) || '-' || lpad(split_part(d, '.', 2), 2, '0') || '-' || lpad(split_part(d, '.', 1), 2, '0') END AS DATE), '%Y-%m-%d'), '')
      FROM (SELECT v, regexp_extract(v, '^[0-9.-]+') AS d FROM (SELECT {s_clean(x)} AS v)))"""


def s_letters(x: str) -> str:
    return rf"regexp_replace(strip_accents(lower({x})), '\P{{L}}', '', 'g')"


def s_name_letters(x: str) -> str:
    kept = rf"list_filter(string_split({x}, ' '), lambda w: NOT regexp_full_match(w, '[\p{{L}}\p{{N}}_]\.?'))"
    return s_letters(f"array_to_string({kept}, ' ')")


def s_ratio(x: str) -> str:
    return f"CASE WHEN length({x}) = 0 THEN 1.0::DOUBLE ELSE length(regexp_replace({x}, '[^{T.VOWELS}]', '', 'g'))::DOUBLE / length({x}) END"


def s_percent(x: str) -> str:
    return f"round_even({x} * 100, 0)::INT::VARCHAR || ' %'"


_ROWS = "|".join(T.KEYBOARD.split())
_UP, _DOWN = "1234567890" * 3, "0987654321" * 3


def s_odd(n: str) -> str:
    return f"(length({n}) >= 6 AND (instr('{_UP}', {n}) > 0 OR instr('{_DOWN}', {n}) > 0 OR {n} = repeat(substr({n}, 1, 1), length({n}))))"


_RECORDS = f"""
WITH RECURSIVE v AS ({C.contacts_sql()}
), u0 AS (SELECT *, source || ':' || CASE WHEN given_id <> '' THEN given_id ELSE 'row' || k END AS uid0 FROM v
), u AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY uid0 ORDER BY k) > 1 THEN uid0 || '@row' || k ELSE uid0 END AS uid FROM u0
), n AS (
  SELECT k, uid, source, {s_name('raw_name')} AS name, {s_clean('raw_company')} AS company, {s_clean('raw_city')} AS city,
    {s_date('raw_created')} AS created, {s_clean('raw_created')} AS created_given,
    {s_clean('raw_email')} AS email_given, {s_email('raw_email')} AS email,
    {s_clean('raw_phone')} AS phone_given, {s_phone('raw_phone')} AS phone FROM u
), l AS (SELECT *, {s_name_letters('name')} AS base, {s_letters('name')} AS base_all FROM n
), q AS (SELECT *, {s_ratio('base')} AS ratio, split_part(email, '@', 2) AS host,
    {s_letters("split_part(email, '@', 1)")} AS local, regexp_replace(phone, '^[+](49)?', '') AS national FROM l
), r AS (
  SELECT *,
    email <> '' AND (email = 'support@example.com' OR host = 'example.org' OR ends_with(host, '.example.org')) AS x1,
    regexp_matches(lower(name), '\\b(test|mustermann)\\b') OR regexp_matches(lower(company), '\\b(test|mustermann)\\b')
      OR regexp_matches(email, '\\b(test|mustermann)\\b') AS x2,
    length(base) >= 4 AND ratio < 0.1 AND (length(base) >= 6 OR regexp_matches(base, '{_ROWS}')) AS x3,
    email = '' AND phone = '' AS x4,
    name = '' AS f1, (length(base) >= 4 AND ratio < 0.1) OR (length(base) >= 5 AND ratio < 0.15) AS f2,
    regexp_matches(base_all, '{_ROWS}') AS f3, regexp_matches(name, '\\p{{Nd}}') AS f4,
    len(string_split(lower(name), ' ')) = 2 AND split_part(lower(name), ' ', 1) = split_part(lower(name), ' ', 2) AS f5,
    length(local) >= 7 AND ({s_ratio('local')}) < 0.12 AS f6, {s_odd('national')} AS f7
  FROM q
), t AS (
  SELECT *, list_filter([CASE WHEN x1 THEN 'internal' END, CASE WHEN x2 THEN 'test_entry' END, CASE WHEN x3 THEN 'keyboard_mash' END,
      CASE WHEN x4 THEN 'no_contact' END], lambda c: c IS NOT NULL) AS reason_codes,
    list_filter([CASE WHEN x1 THEN '{rules.REASONS["internal"]}' END, CASE WHEN x2 THEN '{rules.REASONS["test_entry"]}' END,
      CASE WHEN x3 THEN 'Tastatur-Müll (Vokalanteil ' || {s_percent('ratio')} || ')' END,
      CASE WHEN x4 THEN '{rules.REASONS["no_contact"]}' END], lambda c: c IS NOT NULL) AS reason_texts,
    list_filter([CASE WHEN f1 THEN 'no_name' END, CASE WHEN f2 THEN 'low_vowel_share' END, CASE WHEN f3 THEN 'keyboard_pattern' END,
      CASE WHEN f4 THEN 'digits_in_name' END, CASE WHEN f5 THEN 'repeated_name' END, CASE WHEN f6 THEN 'cryptic_email' END,
      CASE WHEN f7 THEN 'odd_phone' END], lambda c: c IS NOT NULL) AS flag_codes,
    list_filter([CASE WHEN f1 THEN '{rules.FLAGS["no_name"]}' END,
      CASE WHEN f2 THEN 'Name mit wenigen Vokalen (' || {s_percent('ratio')} || ')' END,
      CASE WHEN f3 THEN '{rules.FLAGS["keyboard_pattern"]}' END, CASE WHEN f4 THEN '{rules.FLAGS["digits_in_name"]}' END,
      CASE WHEN f5 THEN '{rules.FLAGS["repeated_name"]}' END, CASE WHEN f6 THEN '{rules.FLAGS["cryptic_email"]}' END,
      CASE WHEN f7 THEN '{rules.FLAGS["odd_phone"]}' END], lambda c: c IS NOT NULL) AS flag_texts,
    list_filter([CASE WHEN email_given <> '' AND email = '' THEN 'unbrauchbare E-Mail ''' || email_given || '''' END,
      CASE WHEN phone_given <> '' AND phone = '' THEN 'unbrauchbare Telefonnummer ''' || phone_given || '''' END,
      CASE WHEN created_given <> '' AND created = '' THEN 'nicht lesbares Datum ''' || created_given || '''' END],
      lambda c: c IS NOT NULL) AS unusable,
    (name <> '')::INT + (company <> '')::INT + (city <> '')::INT + (created <> '')::INT + (email <> '')::INT + (phone <> '')::INT AS complete
  FROM r
)"""

_GROUPS = f"""{_RECORDS}, kept AS (SELECT * FROM t WHERE len(reason_codes) = 0
), keys AS (SELECT k, 'm:' || email AS key FROM kept WHERE email <> '' UNION ALL SELECT k, 't:' || phone FROM kept WHERE phone <> ''
), f AS (SELECT key, min(k) AS f FROM keys GROUP BY 1
), e AS (SELECT DISTINCT k AS u, f AS v FROM keys JOIN f USING (key) WHERE k <> f
), pairs AS (SELECT u, v FROM e UNION SELECT v, u FROM e
), reach AS (SELECT k AS a, k AS z FROM kept UNION SELECT reach.a, pairs.v FROM reach JOIN pairs ON reach.z = pairs.u
), comp AS (SELECT a AS k, min(z) AS component FROM reach GROUP BY 1
), m AS (SELECT kept.*, component, row_number() OVER (PARTITION BY component ORDER BY complete DESC, k) AS rank FROM kept JOIN comp USING (k))"""

_CONTACTS = f"""{_GROUPS}, names AS (
  SELECT component, list(name ORDER BY rank) FILTER (WHERE name <> '') AS all_names FROM m GROUP BY 1
), chosen AS (
  SELECT component, coalesce(list_filter(all_names, lambda n: NOT regexp_matches(n, '[\\p{{L}}\\p{{N}}_]\\.'))[1], all_names[1], '') AS name,
    all_names FROM names
), ordered AS (
  SELECT component, kind, list(value ORDER BY r) AS vs FROM (
    SELECT component, kind, value, min(r) AS r FROM (
      SELECT component, 'email' AS kind, email AS value, rank * 10 AS r FROM m WHERE email <> ''
      UNION ALL SELECT component, 'phone', phone, rank * 10 FROM m WHERE phone <> ''
      UNION ALL SELECT component, 'flag', x, rank * 10 + j FROM (SELECT component, rank, unnest(flag_texts) AS x, generate_subscripts(flag_texts, 1) AS j FROM m)
      UNION ALL SELECT m.component, 'other', m.name, rank * 10 FROM m JOIN chosen c ON c.component = m.component WHERE m.name <> '' AND lower(m.name) <> lower(c.name)
    ) GROUP BY 1, 2, 3) GROUP BY 1, 2
), bad AS (
  SELECT component, list(x || ' (' || uid || ')' ORDER BY rank, j) AS vs FROM (
    SELECT component, rank, uid, unnest(unusable) AS x, generate_subscripts(unusable, 1) AS j FROM m) GROUP BY 1
), g AS (
  SELECT component, arg_min(uid, rank) AS id, arg_min(k, rank) AS leader_index, count(*) AS n_members,
    coalesce(arg_min(company, rank) FILTER (WHERE company <> ''), '') AS company, coalesce(arg_min(city, rank) FILTER (WHERE city <> ''), '') AS city,
    coalesce(min(created) FILTER (WHERE created <> ''), '') AS created, string_agg(DISTINCT source, ' | ' ORDER BY source) AS sources,
    coalesce(string_agg(uid, ' | ' ORDER BY rank) FILTER (WHERE rank > 1), '') AS merged_from
  FROM m GROUP BY 1
), clean AS (
  SELECT g.component, g.id, c.name, company, city, coalesce(e.vs[1], '') AS email, coalesce(e.vs[2], '') AS email_2,
    coalesce(array_to_string(e.vs[3:], ' | '), '') AS more_emails, coalesce(p.vs[1], '') AS phone, coalesce(p.vs[2], '') AS phone_2,
    coalesce(array_to_string(p.vs[3:], ' | '), '') AS more_phones, created, sources, merged_from,
    CASE WHEN f.vs IS NULL THEN '' ELSE 'yes' END AS suspect, coalesce(array_to_string(f.vs, '; '), '') AS suspect_reasons,
    array_to_string(list_concat(coalesce(list_transform(o.vs, lambda x: 'auch erfasst als: ' || x), []), coalesce(bad.vs, [])), '; ') AS notes,
    leader_index, n_members
  FROM g JOIN chosen c USING (component) LEFT JOIN ordered e ON e.component = g.component AND e.kind = 'email'
  LEFT JOIN ordered p ON p.component = g.component AND p.kind = 'phone' LEFT JOIN ordered f ON f.component = g.component AND f.kind = 'flag'
  LEFT JOIN ordered o ON o.component = g.component AND o.kind = 'other' LEFT JOIN bad ON bad.component = g.component
), excluded AS (
  SELECT k, uid AS id, source, k::INT AS "row", name, email_given AS email, phone_given AS phone, email AS email_normalized,
    phone AS phone_normalized, reason_codes[1] AS reason_code, array_to_string(reason_texts, '; ') AS reason
  FROM t WHERE len(reason_codes) > 0
)"""

_CLEAN_COLUMNS = (
    "id, name, company, city, email, email_2, more_emails, phone, phone_2, more_phones, created, sources, merged_from, "
    "suspect, suspect_reasons, notes"
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------- scalar normalisers


@query(f"SELECT doc_id, {s_clean('text')} AS cleaned FROM documents")
def clean_text_docs(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", T.clean_text(F.col("text")).alias("cleaned"))


@query(f"SELECT k, {s_name('raw_name')} AS name FROM ({C.contacts_sql()})")
def name_case(spark, sf_dir):
    return C.contacts(spark, sf_dir).select("k", T.normalize_name(F.col("raw_name")).alias("name"))


_DATES = [
    "strftime(o_orderdate, '%Y-%m-%d')", "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
    "strftime(o_orderdate, '%d.%m.%Y')", "strftime(o_orderdate, '%d.%m.%Y %H:%M')",
]
_SPARK_DATES = ["yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "dd.MM.yyyy", "dd.MM.yyyy HH:mm"]
_DATE_CASE = "CASE o_orderkey % 6 " + " ".join(f"WHEN {i} THEN {d}" for i, d in enumerate(_DATES)) + " ELSE '31.02.2024' END"


@query(f"SELECT o_orderkey, {s_date('raw')} AS created FROM (SELECT o_orderkey, {_DATE_CASE} AS raw FROM orders)")
def iso_dates(spark, sf_dir):
    raw = F.lit("31.02.2024")
    for i, form in enumerate(_SPARK_DATES):
        raw = F.when(F.col("o_orderkey") % 6 == i, F.date_format("o_orderdate", form)).otherwise(raw)
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return rows.select("o_orderkey", T.iso_date(F.col("raw")).alias("created"))


_DOC_WORDS = (
    "(SELECT doc_id, unnest(regexp_extract_all(text, '[^ \\t\\n\\x0b\\f\\r]+')) AS word FROM documents)"
)


def _doc_words(spark, sf_dir):
    words = F.regexp_extract_all(F.col("text"), F.lit("([^ \\t\\n\\x0b\\f\\r]+)"), F.lit(1))
    return _table(spark, sf_dir, "documents").select("doc_id", F.explode(words).alias("word"))


@query(f"SELECT doc_id, word, {s_email('word')} AS email FROM {_DOC_WORDS} WHERE contains(word, '@')")
def email_norm_docs(spark, sf_dir):
    words = _doc_words(spark, sf_dir).where(F.contains("word", F.lit("@")))
    return words.select("doc_id", "word", T.normalize_email(F.col("word")).alias("email"))


@query(f"SELECT k, {s_email('raw_email')} AS email, {s_email('raw_email')} <> '' AS valid FROM ({C.contacts_sql()})")
def email_norm_contacts(spark, sf_dir):
    rows = C.contacts(spark, sf_dir).select("k", T.normalize_email(F.col("raw_email")).alias("email"))
    return rows.withColumn("valid", T.is_valid_email(F.col("email")))


_DOC_PHONES = (
    "(SELECT doc_id, unnest(regexp_extract_all(text, '[+]?[0-9(][0-9() ./-]{6,20}[0-9]')) AS raw FROM documents)"
)


@query(f"SELECT doc_id, raw, {s_phone('raw')} AS phone FROM {_DOC_PHONES}")
def phone_norm_docs(spark, sf_dir):
    found = F.regexp_extract_all(F.col("text"), F.lit("([+]?[0-9(][0-9() ./-]{6,20}[0-9])"), F.lit(1))
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.explode(found).alias("raw"))
    return rows.select("doc_id", "raw", T.normalize_phone(F.col("raw")).alias("phone"))


@query(
    f"SELECT k, raw_phone, phone, regexp_full_match(phone, '[+][1-9][0-9]{{8,14}}') AND NOT starts_with(phone, '+490') AS valid "
    f"FROM (SELECT k, raw_phone, {s_phone('raw_phone')} AS phone FROM ({C.contacts_sql()}))"
)
def phone_norm_formats(spark, sf_dir):
    rows = C.contacts(spark, sf_dir).select("k", "raw_phone", T.normalize_phone(F.col("raw_phone")).alias("phone"))
    return rows.withColumn("valid", T.is_valid_phone(F.col("phone")))


@query(
    f"SELECT word, base, ratio FROM (SELECT word, base, {s_ratio('base')} AS ratio FROM "
    f"(SELECT word, {s_letters('word')} AS base FROM (SELECT DISTINCT word FROM {_DOC_WORDS})))"
)
def letters_vowel_ratio(spark, sf_dir):
    rows = _doc_words(spark, sf_dir).select("word").distinct().withColumn("base", T.letters(F.col("word")))
    return rows.withColumn("ratio", T.vowel_ratio(F.col("base")))


@query(
    f"SELECT a, b, {s_percent('(a::DOUBLE / b)')} AS share FROM (SELECT DISTINCT l_linenumber AS a, (l_orderkey % 40 + 1)::INT AS b FROM lineitem) WHERE a <= b"
)
def pct_half_even(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").selectExpr("l_linenumber as a", "cast(l_orderkey % 40 + 1 as int) as b").distinct()
    return rows.where("a <= b").select("a", "b", T.percent(F.col("a") / F.col("b")).alias("share"))


@query(
    "SELECT n, regexp_replace(regexp_replace(n::VARCHAR, '([0-9])([0-9]{3})$', '\\1.\\2'), '([0-9])([0-9]{3})[.]', '\\1.\\2.') AS shown "
    "FROM (SELECT DISTINCT (o_custkey * 37)::BIGINT AS n FROM orders)"
)
def thousands_format(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select((F.col("o_custkey") * 37).alias("n")).distinct()
    return rows.select("n", T.thousands(F.col("n")).alias("shown"))


def _s_slug(x: str) -> str:
    spelled = f"replace(replace(replace(replace(lower({x}), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss')"
    return f"regexp_replace(strip_accents({spelled}), '[^a-z0-9]', '', 'g')"


@query(f"SELECT k, {_s_slug('raw_name')} AS slug FROM ({C.contacts_sql()})")
def slug_names(spark, sf_dir):
    return C.contacts(spark, sf_dir).select("k", T.slug(F.col("raw_name")).alias("slug"))


_MARKS = "replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(f"SELECT page_id, replace(replace({_MARKS}, chr(34), '&quot;'), chr(39), '&#x27;') AS escaped FROM pages")
def escape_pages(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", T.escape_html(F.col("html")).alias("escaped"))


# ------------------------------------------------------------------- records


@query(
    f"{_RECORDS} SELECT uid, source, k::INT AS \"row\", name, company, city, created, email, phone FROM t"
)
def source_union_map(spark, sf_dir):
    return C.records(spark, sf_dir).select(
        "uid", "source", "row", "name", "company", "city", "created",
        F.array_join("emails", "|").alias("email"), F.array_join("phones", "|").alias("phone"),
    )


@query(f"{_RECORDS} SELECT k, uid, contains(uid, '@row') AS duplicate FROM u")
def uid_dedup(spark, sf_dir):
    rows = source.with_uids(C.raw_rows(spark, sf_dir))
    return rows.select(F.col("index").alias("k"), "uid", "duplicate")


@query(f"{_RECORDS} SELECT uid, complete::INT AS score FROM t")
def completeness(spark, sf_dir):
    return C.records(spark, sf_dir).select("uid", merge.completeness().cast("int").alias("score"))


@query(f"{_RECORDS} SELECT source || '.csv' AS file, count(*) AS n FROM t GROUP BY 1")
def file_counts(spark, sf_dir):
    return C.records(spark, sf_dir).groupBy("file").agg(F.count("*").alias("n"))


@query(f"{_RECORDS} SELECT uid, array_to_string(reason_codes, ',') AS codes, array_to_string(reason_texts, '; ') AS texts FROM t WHERE len(reason_codes) > 0")
def exclusion_reasons(spark, sf_dir):
    rows = C.records(spark, sf_dir).where(F.size("reasons") > 0)
    return rows.select(
        "uid",
        F.array_join(F.transform("reasons", lambda r: r["code"]), ",").alias("codes"),
        F.array_join(F.transform("reasons", lambda r: r["text"]), "; ").alias("texts"),
    )


@query(f"{_RECORDS} SELECT reason_codes[1] AS reason_code, count(*) AS n FROM t WHERE len(reason_codes) > 0 GROUP BY 1")
def reason_counts(spark, sf_dir):
    rows = C.records(spark, sf_dir).where(F.size("reasons") > 0)
    return rows.groupBy(F.get("reasons", F.lit(0))["code"].alias("reason_code")).agg(F.count("*").alias("n"))


@query(f"{_RECORDS} SELECT uid, array_to_string(flag_codes, ',') AS codes, array_to_string(flag_texts, '; ') AS texts FROM t WHERE len(reason_codes) = 0 AND len(flag_codes) > 0")
def suspect_flags(spark, sf_dir):
    rows = C.records(spark, sf_dir).where(F.size("flags") > 0)
    return rows.select(
        "uid",
        F.array_join(F.transform("flags", lambda r: r["code"]), ",").alias("codes"),
        F.array_join(F.transform("flags", lambda r: r["text"]), "; ").alias("texts"),
    )


@query(f"{_RECORDS} SELECT split_part(x, ' ''', 1) AS kind, count(*) AS n FROM (SELECT unnest(unusable) AS x FROM t) GROUP BY 1")
def unusable_kinds(spark, sf_dir):
    items = C.records(spark, sf_dir).select(F.explode("unusable").alias("u"))
    return items.groupBy(F.col("u.kind").alias("kind")).agg(F.count("*").alias("n"))


# -------------------------------------------------------------- groups, merging


def _kept(spark, sf_dir):
    return C.records(spark, sf_dir).where(F.size("reasons") == 0)


def _contacts(spark, sf_dir):
    return merge.merge_contacts(merge.with_components(_kept(spark, sf_dir)))


def _tables(spark, sf_dir):
    """(records, clean rows, excluded rows) of the contacts."""
    records = C.records(spark, sf_dir)
    kept, out = records.where(F.size("reasons") == 0), records.where(F.size("reasons") > 0)
    clean, _ = materialise(merge.clean_rows(merge.merge_contacts(merge.with_components(kept))), "clean")
    return records, clean, merge.excluded_rows(out)


@query(f"{_GROUPS} SELECT u, v FROM e")
def key_edges(spark, sf_dir):
    return merge.key_edges(_kept(spark, sf_dir))


@query(f"{_GROUPS} SELECT uid, component FROM m")
def components(spark, sf_dir):
    return merge.with_components(_kept(spark, sf_dir)).select("uid", "component")


@query(f"{_GROUPS} SELECT n, count(*) AS groups FROM (SELECT component, count(*) AS n FROM m GROUP BY 1) GROUP BY 1")
def component_sizes(spark, sf_dir):
    sizes = merge.with_components(_kept(spark, sf_dir)).groupBy("component").agg(F.count("*").alias("n"))
    return sizes.groupBy("n").agg(F.count("*").alias("groups"))


@query(f"{_CONTACTS} SELECT id, name, company, city, created, sources, merged_from, n_members::INT AS n_members, notes FROM clean")
def merge_contacts(spark, sf_dir):
    return _contacts(spark, sf_dir).select(
        "id", "name", "company", "city", "created", F.array_join("sources", " | ").alias("sources"),
        F.array_join("merged_from", " | ").alias("merged_from"), "n_members", F.array_join("notes", "; ").alias("notes"),
    )


@query(f"{_CONTACTS} SELECT {_CLEAN_COLUMNS} FROM clean")
def clean_rows(spark, sf_dir):
    return merge.clean_rows(_contacts(spark, sf_dir)).drop("component")


@query(f'{_CONTACTS} SELECT id, source, "row", name, email, phone, email_normalized, phone_normalized, reason_code, reason FROM excluded')
def excluded_rows(spark, sf_dir):
    rows = C.records(spark, sf_dir).where(F.size("reasons") > 0)
    return merge.excluded_rows(rows).drop("index")


@query(
    f"{_CONTACTS}, fc AS (SELECT DISTINCT component, c, x FROM (SELECT component, unnest(flag_codes) AS c, unnest(flag_texts) AS x FROM m)) "
    "SELECT c AS flag, count(*) AS n FROM fc GROUP BY 1"
)
def flag_counts(spark, sf_dir):
    flags = _contacts(spark, sf_dir).select(F.explode("flags").alias("f"))
    return flags.groupBy(F.col("f.code").alias("flag")).agg(F.count("*").alias("n"))


@query(f"{_CONTACTS} SELECT id, n_members::INT AS n_members, leader_index FROM clean WHERE n_members > 1 ORDER BY n_members DESC, leader_index LIMIT 10")
def top_merge_groups(spark, sf_dir):
    rows = _contacts(spark, sf_dir).where("n_members > 1").select("id", "n_members", "leader_index")
    return rows.orderBy(F.desc("n_members"), "leader_index").limit(10)


@query(
    f"""{_CONTACTS} SELECT (SELECT count(*) FROM t) AS n_input, (SELECT count(*) FROM excluded) AS n_excluded, count(*) AS n_output,
    sum(n_members - 1)::BIGINT AS n_absorbed, count(*) FILTER (WHERE suspect = 'yes') AS n_suspect,
    count(*) FILTER (WHERE n_members > 1) AS n_merged, max(n_members)::BIGINT AS largest FROM clean"""
)
def summary_counts(spark, sf_dir):
    records = C.records(spark, sf_dir)
    counts = records.agg(F.count("*").alias("n_input"), F.count_if(F.size("reasons") > 0).alias("n_excluded"))
    merged = merge.merge_contacts(merge.with_components(records.where(F.size("reasons") == 0)))
    of_contacts = merged.agg(
        F.count("*").alias("n_output"), F.sum(F.col("n_members") - 1).alias("n_absorbed"),
        F.count_if(F.size("flags") > 0).alias("n_suspect"), F.count_if(F.col("n_members") > 1).alias("n_merged"),
        F.max("n_members").cast("long").alias("largest"),
    )
    return counts.crossJoin(of_contacts)  # one row each


# -------------------------------------------------------------------- checks


@query(
    f"""{_CONTACTS}, c AS (SELECT (SELECT count(*) FROM t) AS n_input, (SELECT count(*) FROM excluded) AS n_excluded,
    (SELECT sum(n_members - 1)::BIGINT FROM clean) AS n_absorbed, (SELECT count(*) FROM clean) AS n_output)
    SELECT *, n_input = n_excluded + n_absorbed + n_output AS balanced FROM c"""
)
def check_balance(spark, sf_dir):
    records, clean, excluded = _tables(spark, sf_dir)
    absorbed = clean.agg(F.sum(F.size(integrity.split_list("merged_from"))).alias("n_absorbed"), F.count("*").alias("n_output"))
    counts = records.agg(F.count("*").alias("n_input")).crossJoin(excluded.agg(F.count("*").alias("n_excluded"))).crossJoin(absorbed)
    return counts.withColumn("balanced", F.expr("n_input = n_excluded + n_absorbed + n_output"))


@query(f"{_CONTACTS} SELECT uid AS id FROM t UNION ALL SELECT id FROM excluded WHERE false")
def check_accounting(spark, sf_dir):
    """The ids that the output accounts for: exactly those of the input."""
    _, clean, excluded = _tables(spark, sf_dir)
    return integrity.accounted_ids(clean, excluded)


@query(
    f"""{_CONTACTS} SELECT 'E-Mail' AS kind, email AS value FROM kept WHERE email <> '' GROUP BY 2
    UNION ALL SELECT 'Telefonnummer', phone FROM kept WHERE phone <> '' GROUP BY 2 UNION ALL SELECT 'ID', id FROM clean"""
)
def check_unique(spark, sf_dir):
    """All keys of the clean table with their kind; none may be repeated."""
    _, clean, _ = _tables(spark, sf_dir)
    keys = integrity.row_values(clean, "email").select(F.lit("E-Mail").alias("kind"), "value")
    keys = keys.union(integrity.row_values(clean, "phone").select(F.lit("Telefonnummer"), "value"))
    keys = keys.union(clean.select(F.lit("ID"), "id"))
    return keys.join(integrity.repeated_keys(clean).select("kind", "value"), ["kind", "value"], "left_anti")


# ------------------------------------------------- checks of spoiled outputs


def _spoiled(spark, sf_dir):
    """(records, clean rows with the leader's index, excluded rows) for queries that spoil them."""
    records = C.records(spark, sf_dir)
    kept, out = records.where(F.size("reasons") == 0), records.where(F.size("reasons") > 0)
    contacts, _ = materialise(merge.merge_contacts(merge.with_components(kept)), "contacts")
    clean = merge.clean_rows(contacts).join(contacts.select("component", "leader_index"), "component")
    return records, clean, merge.excluded_rows(out)


_LEFT = "SELECT component FROM clean WHERE leader_index % 7 <> 0"


@query(
    f"""{_CONTACTS}, want AS (SELECT 'email' AS kind, email AS value FROM t WHERE email <> '' UNION SELECT 'phone', phone FROM t WHERE phone <> ''
    ), have AS (
      SELECT 'email' AS kind, email AS value FROM m WHERE component IN ({_LEFT}) UNION SELECT 'phone', phone FROM m WHERE component IN ({_LEFT})
      UNION SELECT 'email', email_normalized FROM excluded WHERE k % 3 <> 0 UNION SELECT 'phone', phone_normalized FROM excluded WHERE k % 3 <> 0
    ) SELECT kind, value FROM want EXCEPT SELECT kind, value FROM have"""
)
def check_lost_keys(spark, sf_dir):
    """Addresses and numbers that are lost when some contacts and excluded rows are taken away."""
    records, clean, excluded = _spoiled(spark, sf_dir)
    return integrity.lost_keys(records, clean.where("leader_index % 7 <> 0"), excluded.where("index % 3 <> 0"))


@query(
    f"""{_CONTACTS}, have AS (
      SELECT uid AS id, CASE WHEN l.leader_index % 7 = 0 THEN 0 WHEN l.leader_index % 11 = 0 THEN 2 ELSE 1 END AS times
      FROM m JOIN clean l ON l.component = m.component UNION ALL SELECT id, 1 FROM excluded
    ) SELECT id, (times - 1)::BIGINT AS times FROM have WHERE times <> 1"""
)
def check_ids(spark, sf_dir):
    """Ids that are missing or counted twice when contacts are taken away and others repeated."""
    records, clean, excluded = _spoiled(spark, sf_dir)
    left = clean.where("leader_index % 7 <> 0")
    spoiled = left.union(left.where("leader_index % 11 = 0"))
    return integrity.id_differences(records, spoiled, excluded)


@query(
    f"""{_CONTACTS} SELECT 'E-Mail' AS kind, upper(email) AS value FROM clean WHERE leader_index % 5 = 1 AND email <> ''
    UNION ALL SELECT 'Telefonnummer', '0' || substr(phone, 4) FROM clean WHERE leader_index % 5 = 2 AND phone <> ''
    UNION ALL SELECT 'Datum', '1.1.2024' FROM clean WHERE leader_index % 5 = 3
    UNION ALL SELECT 'suspect', 'no' FROM clean WHERE leader_index % 5 = 4
    UNION ALL SELECT 'ID', ' ' || id FROM clean WHERE leader_index % 13 = 0"""
)
def check_formats(spark, sf_dir):
    """Values that are not in their form when some of each kind are spoiled."""
    _, clean, _ = _spoiled(spark, sf_dir)

    def spoil(column: str, rest: int, value):
        return F.when((F.col("leader_index") % 5 == rest) & (F.col(column) != ""), value).otherwise(F.col(column))

    spoiled = clean.withColumns({
        "email": spoil("email", 1, F.upper("email")),
        "phone": spoil("phone", 2, F.concat(F.lit("0"), F.substr("phone", F.lit(4)))),
        "created": F.when(F.col("leader_index") % 5 == 3, "1.1.2024").otherwise(F.col("created")),
        "suspect": F.when(F.col("leader_index") % 5 == 4, "no").otherwise(F.col("suspect")),
        "id": F.when(F.col("leader_index") % 13 == 0, F.concat(F.lit(" "), "id")).otherwise(F.col("id")),
    })
    return integrity.bad_formats(spoiled)


@query(
    f"""{_CONTACTS}, every AS (
      SELECT 'E-Mail' AS kind, email AS value, component FROM m WHERE email <> '' UNION SELECT 'Telefonnummer', phone, component FROM m WHERE phone <> ''
      UNION SELECT 'ID', id, component FROM clean
    ) SELECT kind, value, 2::BIGINT AS n FROM every WHERE component IN (SELECT component FROM clean WHERE leader_index % 11 = 0)"""
)
def check_repeats(spark, sf_dir):
    """Keys that occur twice when some contacts are repeated."""
    _, clean, _ = _spoiled(spark, sf_dir)
    return integrity.repeated_keys(clean.union(clean.where("leader_index % 11 = 0")))
