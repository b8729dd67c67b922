"""Named queries over files: the contacts written as CSV exports, loaded, cleaned, written and read back."""

from __future__ import annotations

import contextlib
import io
import re
import tempfile
from html import unescape

from pyspark.sql import functions as F

from contactmill import cli, config, storage
from contactmill.operators import merge
from contactmill.plans import catalog, cleanup, synth
from contactmill.plans import contacts as C
from contactmill.session import materialise, scratch_path
from contactmill.sinks import files, report
from contactmill.sources import csv as source

query, _CONTACTS, _CLEAN_COLUMNS = catalog.query, catalog._CONTACTS, catalog._CLEAN_COLUMNS
s_clean, s_email, s_phone, s_name, s_date = catalog.s_clean, catalog.s_email, catalog.s_phone, catalog.s_name, catalog.s_date

_LOADED = f"""WITH v AS ({C.contacts_sql()}
), f AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k) AS rowno, {s_clean('raw_name')} AS cn FROM v
), u0 AS (SELECT *, 'export_' || source || ':' || CASE WHEN given_id <> '' THEN given_id ELSE 'row' || rowno END AS uid0 FROM f
), u AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY uid0 ORDER BY rowno) > 1 THEN uid0 || '@row' || rowno ELSE uid0 END AS uid FROM u0)"""


def _paths(spark, sf_dir, second=True):
    """The exports' paths in order, from patterns that name them out of order and more than once."""
    folder = scratch_path(spark, "exports")
    C.export(spark, sf_dir, folder, second)
    return source.expand_inputs(spark, [f"{folder}/export_b.csv", f"{folder}/*.csv", f"{folder}/./export_a.csv"])


@query(f"""{_LOADED} SELECT 'export_' || source || '.csv' AS file, (CASE WHEN source = 'b' THEN 1099511627776 ELSE 0 END + rowno)::BIGINT AS "index",
    rowno AS "row", given_id AS id, CASE WHEN source = 'a' THEN cn ELSE '' END AS name,
    CASE WHEN source = 'b' THEN split_part(cn, ' ', 1) ELSE '' END AS first_name,
    CASE WHEN source = 'b' AND contains(cn, ' ') THEN substr(cn, instr(cn, ' ') + 1) ELSE '' END AS last_name,
    {s_clean('raw_email')} AS email, {s_clean('raw_email_2')} AS email_2, {s_clean('raw_phone')} AS phone, {s_clean('raw_phone_2')} AS phone_2,
    {s_clean('raw_company')} AS company, {s_clean('raw_city')} AS city, {s_clean('raw_created')} AS created FROM f""")
def csv_scan(spark, sf_dir):
    """Both exports, found by patterns, read by position and united, with row numbers and load order."""
    made = config.from_dict(C.settings())
    return source.raw_rows(spark, _paths(spark, sf_dir), made).select("file", "index", "row", *config.CANONICAL)


_SECOND = """array_to_string(list_filter([{a}, CASE WHEN {b} <> {a} THEN {b} END], lambda x: x IS NOT NULL AND x <> ''), '|')"""
_BAD = "CASE WHEN {given} <> '' AND {normal} = '' THEN '{kind} ''' || {given} || '''' END"


@query(f"""{_LOADED}, n AS (SELECT *, {s_email('raw_email')} AS e1, {s_email('raw_email_2')} AS e2, {s_phone('raw_phone')} AS p1, {s_phone('raw_phone_2')} AS p2,
      {s_date('raw_created')} AS d, {s_clean('raw_email')} AS g1, {s_clean('raw_email_2')} AS g2, {s_clean('raw_phone')} AS h1, {s_clean('raw_phone_2')} AS h2,
      {s_clean('raw_created')} AS gd FROM u)
    SELECT uid, rowno AS "row", {s_name('raw_name')} AS name, d AS created, {_SECOND.format(a='e1', b='e2')} AS emails, {_SECOND.format(a='p1', b='p2')} AS phones,
      array_to_string(list_filter([{_BAD.format(given='g1', normal='e1', kind='unbrauchbare E-Mail')}, {_BAD.format(given='g2', normal='e2', kind='unbrauchbare E-Mail')},
        {_BAD.format(given='h1', normal='p1', kind='unbrauchbare Telefonnummer')}, {_BAD.format(given='h2', normal='p2', kind='unbrauchbare Telefonnummer')},
        {_BAD.format(given='gd', normal='d', kind='nicht lesbares Datum')}], lambda x: x IS NOT NULL), '; ') AS unusable FROM n""")
def csv_records(spark, sf_dir):
    """Records of both exports, with second addresses and numbers, and what could not be read."""
    rows = source.load_records(spark, _paths(spark, sf_dir), config.from_dict(C.settings()))
    return rows.select(
        "uid", "row", "name", "created", F.array_join("emails", "|").alias("emails"), F.array_join("phones", "|").alias("phones"),
        F.array_join(F.transform("unusable", lambda u: u["text"]), "; ").alias("unusable"),
    )


def _failure(run) -> str:
    try:
        run()
    except config.ConfigError as wrong:
        return str(wrong)
    return ""


@query("""SELECT r_regionkey, CASE WHEN r_regionkey % 2 = 1 THEN 'E-Mail' WHEN r_regionkey % 4 = 2 THEN 'Name' ELSE '' END AS missing FROM region""")
def header_check(spark, sf_dir):
    """For an export of each region: the mapped column that its header lacks, in exact case."""
    folder, out = scratch_path(spark, "headers"), []
    mapped = config.from_dict({"source": [{"match": "*.csv", "columns": {"name": "Name", "email": "E-Mail"}}]})
    for r in catalog._table(spark, sf_dir, "region").select("r_regionkey").collect():
        key = r["r_regionkey"]
        head = f"Nr,{'name' if key % 4 == 2 else 'Name'}" + ("" if key % 2 else ",E-Mail")
        storage.write_text(spark, f"{folder}/{key}.csv", [head + "\n1,Anna" + ("" if key % 2 else ",a@example.com") + "\n"])
        told = _failure(lambda: source.raw_rows(spark, [f"{folder}/{key}.csv"], mapped))
        out.append((key, (re.findall(r"\['(.*?)'\] fehlen in der Datei", told) or [""])[0]))
    return spark.createDataFrame(out, "r_regionkey int, missing string")


@query("SELECT r_regionkey, CASE WHEN r_regionkey % 2 = 0 THEN r_regionkey + 2 END::INT AS error_row FROM region")
def separator_guard(spark, sf_dir):
    """For an export of each region: the row that the error names whose id has the list mark."""
    folder, out = scratch_path(spark, "marks"), []
    mapped = config.from_dict({"source": [{"match": "*.csv", "columns": {"id": "Nr", "email": "E-Mail"}}]})
    for r in catalog._table(spark, sf_dir, "region").select("r_regionkey").collect():
        key = r["r_regionkey"]
        ids = [f"{i}|x" if key % 2 == 0 and i == key + 2 else str(i) for i in range(1, 9)]
        storage.write_text(spark, f"{folder}/{key}.csv", ["Nr,E-Mail\n", *(f'"{i}",a{i[0]}@example.com\n' for i in ids)])
        told = _failure(lambda: source.load_records(spark, [f"{folder}/{key}.csv"], mapped))
        out.append((key, int(found[0]) if (found := re.findall(r"Zeile (\d+): Die ID .* enthält '\|'", told)) else None))
    return spark.createDataFrame(out, "r_regionkey int, error_row int")


@query("""SELECT n_name, CASE WHEN regexp_matches(n_name, '^[A-E].*$') THEN '[A-E]*' WHEN ends_with(n_name, 'IA') THEN '*IA'
    WHEN length(n_name) = 5 THEN '?????' ELSE 'none' END AS pattern FROM nation""")
def source_match(spark, sf_dir):
    """The first pattern of the settings that a file named like each nation has."""
    made = config.from_dict({"source": [{"match": p} for p in ("[A-E]*", "*IA", "?????")]})
    out = []
    for r in catalog._table(spark, sf_dir, "nation").select("n_name").collect():
        told = _failure(lambda: out.append((r["n_name"], made.source_for(r["n_name"]).match)))
        if told:
            out.append((r["n_name"], "none"))
    return spark.createDataFrame(out, "n_name string, pattern string")


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey::VARCHAR ELSE '49' END AS code, lower(replace(n_name, ' ', '-')) || '.com' AS domain,
    lower(replace(n_name, ' ', '.')) || '@example.com' AS email, CASE WHEN n_nationkey % 3 = 0 THEN ';' ELSE ',' END AS delimiter,
    CASE WHEN n_nationkey % 5 = 0 THEN 'latin-1' ELSE 'utf-8-sig' END AS encoding, n_name AS header FROM nation""")
def settings_read(spark, sf_dir):
    """Settings from a TOML file for each nation, with what is given and what is not."""
    out = []
    for r in catalog._table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect():
        key, name = r
        text = f'[phone]\ndefault_country_code = "{key}"\n' if key % 2 == 0 else ""
        text += f'[exclude]\ninternal_domains = ["@{name.replace(" ", "-")}.COM"]\ninternal_emails = ["{name.replace(" ", ".")}@Example.com"]\n'
        text += '[[source]]\nmatch = "*.csv"\n' + ('delimiter = ";"\n' if key % 3 == 0 else "")
        text += ('encoding = "latin-1"\n' if key % 5 == 0 else "") + f'[source.columns]\nname = "{name}"\n'
        with tempfile.NamedTemporaryFile("w", suffix=".toml", encoding="utf-8") as file:  # read on the driver alone
            file.write(text)
            file.flush()
            made = config.load(file.name)
        (src,) = made.sources
        out.append((key, made.country_code, *made.internal_domains, *made.internal_emails, src.delimiter, src.encoding, src.columns["name"]))
    return spark.createDataFrame(out, "n_nationkey int, code string, domain string, email string, delimiter string, encoding string, header string")


@query("SELECT n_nationkey, n_nationkey % 7 <> 0 AS refused, CASE WHEN n_nationkey % 7 = 0 THEN 0 ELSE 2 END AS exit_code FROM nation")
def settings_refused(spark, sf_dir):
    """For each nation settings with another mistake, or none: whether they are refused, and the exit
    code of a run whose settings can't be used (0 stands for no run)."""
    fine = {"source": [{"match": "*.csv", "columns": {"name": "Name"}}]}
    mistakes = (
        fine, {}, {"source": [{"columns": {"name": "Name"}}]}, {"source": [{"match": "*", "columns": {"nom": "Name"}}]},
        fine | {"phone": {"default_country_code": "+49"}}, fine | {"exclude": {"test_patterns": ["("]}},
        fine | {"exclude": {"internal_domains": "example.com"}},
    )
    out = []
    for r in catalog._table(spark, sf_dir, "nation").select("n_nationkey").collect():
        raw = mistakes[r["n_nationkey"] % 7]
        refused = bool(_failure(lambda: config.from_dict(raw)))
        with contextlib.redirect_stderr(io.StringIO()):
            code = cli.main(["run", "--input", "x", "--config", f"/nowhere/{r['n_nationkey']}.toml"], spark) if refused else 0
        out.append((r["n_nationkey"], refused, code))
    return spark.createDataFrame(out, "n_nationkey int, refused boolean, exit_code int")


def _result(spark, sf_dir) -> cleanup.Result:
    records = C.records(spark, sf_dir)
    grouped, _ = materialise(merge.with_components(records.where(F.size("reasons") == 0)), "grouped")
    contacts, _ = materialise(merge.merge_contacts(grouped), "contacts")
    return cleanup.Result(records, grouped, contacts, C.CONFIG)


def _written(spark, rows, order, columns):
    """The rows of a table after it was written as one CSV file and read back, with their place in it."""
    path = f"{scratch_path(spark, 'written')}/table.csv"
    files.write_csv(rows, path, order, columns)
    back = files.read_csv(spark, path, columns)
    places = spark.read.option("multiLine", True).option("header", True).option("escape", '"').csv(path)
    places = places.select("id", (F.monotonically_increasing_id() + 1).alias("place"))
    return back.join(places, "id")


@query(f"{_CONTACTS} SELECT {_CLEAN_COLUMNS}, row_number() OVER (ORDER BY component) AS place FROM clean")
def clean_written(spark, sf_dir):
    return _written(spark, _result(spark, sf_dir).clean, ["component"], cleanup.CLEAN)


@query(f"""{_CONTACTS} SELECT id, source, "row"::VARCHAR AS "row", name, email, phone, email_normalized, phone_normalized, reason_code, reason,
    row_number() OVER (ORDER BY k) AS place FROM excluded""")
def excluded_written(spark, sf_dir):
    return _written(spark, _result(spark, sf_dir).excluded, ["index"], cleanup.EXCLUDED)


def _s_dots(n: str) -> str:
    return f"regexp_replace(regexp_replace(({n})::VARCHAR, '([0-9])([0-9]{{3}})$', '\\1.\\2'), '([0-9])([0-9]{{3}})[.]', '\\1.\\2.')"


def _s_labels(labels: dict[str, str], code: str) -> str:
    cases = " ".join(f"WHEN '{c}' THEN '{text} (`{c}`)'" for c, text in labels.items())
    return f"CASE {code} {cases} END"


@query(f"""{_CONTACTS}, totals AS (SELECT (SELECT count(*) FROM t) AS i, (SELECT count(*) FROM excluded) AS x,
      (SELECT sum(n_members - 1)::BIGINT FROM clean) AS a, (SELECT count(*) FROM clean) AS o
    ), fc AS (SELECT c, count(*) AS n FROM (SELECT DISTINCT component, c, x FROM (SELECT component, unnest(flag_codes) AS c, unnest(flag_texts) AS x FROM m)) GROUP BY 1
    ), rc AS (SELECT reason_code AS c, count(*) AS n FROM excluded GROUP BY 1
    ), uc AS (SELECT split_part(x, ' ''', 1) AS c, count(*) AS n FROM (SELECT unnest(unusable) AS x FROM t) GROUP BY 1
    ), gc AS (SELECT n_members AS c, count(*) AS n FROM clean GROUP BY 1), sc AS (SELECT source || '.csv' AS c, count(*) AS n FROM t GROUP BY 1)
    SELECT 'Bilanz' AS section, 1::BIGINT AS place, 'Eingangszeilen' AS label, {_s_dots('i')} AS number FROM totals
    UNION ALL SELECT 'Bilanz', 2, 'ausgeschlossen (`excluded.csv`)', {_s_dots('x')} FROM totals
    UNION ALL SELECT 'Bilanz', 3, 'in einen anderen Datensatz zusammengeführt', {_s_dots('a')} FROM totals
    UNION ALL SELECT 'Bilanz', 4, '**Saubere Kontakte (`clean.csv`)**', '**' || {_s_dots('o')} || '**' FROM totals
    UNION ALL SELECT 'Eingabedateien', row_number() OVER (ORDER BY c), c, {_s_dots('n')} FROM sc
    UNION ALL SELECT 'Ausgeschlossene Zeilen nach Grund', row_number() OVER (ORDER BY n DESC, c), {_s_labels(report.REASON_LABELS, 'c')}, {_s_dots('n')} FROM rc
    UNION ALL SELECT 'Verdächtige Datensätze (behalten, markiert)', row_number() OVER (ORDER BY n DESC, c), {_s_labels(report.FLAG_LABELS, 'c')}, {_s_dots('n')} FROM fc
    UNION ALL SELECT 'Dubletten', row_number() OVER (ORDER BY c), c::VARCHAR, {_s_dots('n')} FROM gc
    UNION ALL SELECT 'Unbrauchbare Werte', row_number() OVER (ORDER BY c), c, {_s_dots('n')} FROM uc""")
def report_tables(spark, sf_dir):
    """All rows of all tables of the report, in order."""
    result = _result(spark, sf_dir)
    out, section, place = [], "", 0
    for line in "".join(report.report(result.metrics, result.warnings())).splitlines():
        if line.startswith("## "):
            section, place = line[3:], -2  # two lines of a table's head
        elif line.startswith("|"):
            place += 1
            if place > 0:
                out.append((section, place, *(c.strip() for c in line.strip("|").split("|"))))
    return spark.createDataFrame(out, "section string, place long, label string, number string")


@query(f"""{_CONTACTS}, sizes AS (SELECT reason_code, count(*) AS n FROM excluded GROUP BY 1
    ), listed AS (SELECT e.*, row_number() OVER (ORDER BY n DESC, reason_code, k) AS place FROM excluded e JOIN sizes USING (reason_code)
    ), suspects AS (SELECT *, row_number() OVER (ORDER BY component) AS place FROM clean WHERE suspect = 'yes'
    ), top AS (SELECT *, row_number() OVER (ORDER BY n_members DESC, leader_index) AS g FROM clean WHERE n_members > 1
    ), members AS (SELECT m.uid, m.name, row_number() OVER (ORDER BY g, rank) AS place FROM m JOIN top USING (component) WHERE g <= 10)
    SELECT reason_code AS part, place, id, name, reason AS pills FROM listed
    UNION ALL SELECT 'suspects', place, id, name, replace(suspect_reasons, '; ', ' + ') FROM suspects
    UNION ALL SELECT 'groups', place, uid, name, CASE WHEN uid IN (SELECT id FROM top) THEN 'führt' ELSE 'zusammengeführt' END FROM members""")
def review_rows(spark, sf_dir):
    """All rows of the review page in order: of each reason, the suspects, the largest groups."""
    result = _result(spark, sf_dir)
    page = "".join(report.review_page(result.metrics, result.contacts, result.excluded, result.grouped))
    out, part, places = [], "", {}
    for mark in re.finditer(r'data-reason="(\w+)"|<h2>(Verd|Größte)|<tr class="row">(.*?)</tr>', page):
        reason, heading, row = mark.groups()
        if row is None:
            part = reason or {"Verd": "suspects", "Größte": "groups"}[heading]
            continue
        cells = [unescape(c) for c in re.findall(r"<td>(.*?)</td>", row)]
        pills = " + ".join(unescape(p) for p in re.findall(r'class="pill">(.*?)</span>', row))
        kind = part if part in ("suspects", "groups") else "reasons"
        places[kind] = places.get(kind, 0) + 1
        out.append((part, places[kind], cells[0], cells[1], pills))
    return spark.createDataFrame(out, "part string, place long, id string, name string, pills string")


@query(f"""{_CONTACTS} SELECT 1 AS line, 'Eingangszeilen' AS label, {_s_dots('(SELECT count(*) FROM t)')} AS number, 0 AS exit_code
    UNION ALL SELECT 2, 'Ausgeschlossen', {_s_dots('(SELECT count(*) FROM excluded)')}, 0
    UNION ALL SELECT 3, 'Zusammengeführt', {_s_dots('(SELECT sum(n_members - 1)::BIGINT FROM clean)')}, 0
    UNION ALL SELECT 4, 'Saubere Kontakte', {_s_dots('(SELECT count(*) FROM clean)')}, 0
    UNION ALL SELECT 5, 'davon verdächtig', {_s_dots("(SELECT count(*) FROM clean WHERE suspect = 'yes')")}, 0""")
def cli_summary(spark, sf_dir):
    """What a whole run from the command line over the exports prints, after both passes of checks."""
    paths, out = _paths(spark, sf_dir, second=False), scratch_path(spark, "run")
    text = ['[exclude]\ninternal_domains = ["@Example.org"]\ninternal_emails = ["Support@example.com"]\n']
    text.append("test_patterns = ['\\btest\\b', '\\bmustermann\\b']\n")
    for name, columns in C.LAYOUTS.items():
        text.append(f'[[source]]\nmatch = "export_{name}.csv"\n[source.columns]\n')
        text += [f'{f} = "{h}"\n' for f, h in columns.items()]
    shown = io.StringIO()
    with tempfile.NamedTemporaryFile("w", suffix=".toml", encoding="utf-8") as file:  # read on the driver alone
        file.writelines(text)
        file.flush()
        with contextlib.redirect_stdout(shown), contextlib.redirect_stderr(io.StringIO()):
            code = cli.main(["run", "--input", *reversed(paths), "--out", out, "--config", file.name], spark)
    lines = [re.match(r"\s*(.*?)\s{2,}([\d.]+)", line) for line in shown.getvalue().splitlines()[:5]]
    return spark.createDataFrame(
        [(i, m.group(1), m.group(2), code) for i, m in enumerate(lines, 1)], "line int, label string, number string, exit_code int"
    )


_SHARES = ", ".join(f"('{k}', {v})" for k, v in synth.SHARES.items())


@query(f"""WITH n AS (SELECT count(*) AS n FROM customer), s(kind, share) AS (VALUES {_SHARES}), c AS (SELECT kind, n * share // 1000 AS n FROM s, n),
    p AS (SELECT (SELECT n FROM n) - sum(n) AS n FROM c)
    SELECT kind, n::BIGINT AS n, n::BIGINT AS entities FROM c WHERE n > 0
    UNION ALL SELECT 'person', n::BIGINT, (n // 138 * 100 + least(n % 138, 70) + CASE WHEN n % 138 > 70 THEN (least(n % 138, 114) - 70 + 1) // 2 ELSE 0 END
      + CASE WHEN n % 138 > 114 THEN (n % 138 - 114 + 2) // 3 ELSE 0 END)::BIGINT FROM p""")
def synth_kinds(spark, sf_dir):
    """Rows and entities of each kind among as many synthetic rows as there are customers."""
    n = catalog._table(spark, sf_dir, "customer").count()
    rows = synth.build(spark, n, 42)
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("entity").alias("entities"))
