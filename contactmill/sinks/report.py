"""The summary report (Markdown) and the review page (HTML), in German."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactmill.operators.merge import with_place

# Labels of reasons and flags, and below the German lines of report and page.
REASON_LABELS = {
    "internal": "Interne Adressen",
    "test_entry": "Testeinträge",
    "keyboard_mash": "Tastatur-Müll",
    "no_contact": "Kein Kontaktweg",
}
FLAG_LABELS = {
    "low_vowel_share": "Wenige Vokale im Namen",
    "cryptic_email": "Zufällig wirkende E-Mail",
    "digits_in_name": "Ziffern im Namen",
    "no_name": "Kein Name",
    "keyboard_pattern": "Tastaturreihen-Muster im Namen",
    "repeated_name": "Vor- und Nachname identisch",
    "odd_phone": "Auffällige Telefonnummer",
}


def number(n: int) -> str:
    return f"{n:,}".replace(",", ".")


def markdown_table(head: list[str], rows: Iterable[list]) -> list[str]:
    return [f"| {' | '.join(head)} |", "|" + "---|" * len(head), *(f"| {' | '.join(map(str, r))} |" for r in rows)]


def _coded(labels: dict[str, str], code: str) -> str:
    return f"{labels[code]} (`{code}`)" if code in labels else f"`{code}`"


def _by_count(counts: dict[str, int]) -> list[tuple[str, int]]:
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))


def _coded_counts(labels: dict[str, str], counts: dict[str, int]) -> list[list[str]]:
    return [[_coded(labels, code), number(n)] for code, n in _by_count(counts)]


#: The report: title of a section, text before its table, columns, and rows from the metrics. Titles and
#: columns are fixed texts that readers of the reports know.
SECTIONS = (
    ("Bilanz", "", ("", "Zeilen"), lambda m: [
        ["Eingangszeilen", number(m["n_input"])],
        ["ausgeschlossen (`excluded.csv`)", number(m["n_excluded"])],
        ["in einen anderen Datensatz zusammengeführt", number(m["n_absorbed"])],
        ["**Saubere Kontakte (`clean.csv`)**", f"**{number(m['n_output'])}**"],
    ]),
    ("Eingabedateien", "", ("Datei", "Zeilen"), lambda m: [[f, number(n)] for f, n in m["files"]]),
    (
        "Ausgeschlossene Zeilen nach Grund", "Alle Zeilen bleiben in `excluded.csv` erhalten; gezählt ist der jeweils erste Grund.",
        ("Grund", "Zeilen"), lambda m: _coded_counts(REASON_LABELS, m["reasons"]),
    ),
    (
        "Verdächtige Datensätze (behalten, markiert)",
        "{n_suspect} von {n_output} Kontakten sind markiert (`suspect = yes`); einzeln stehen sie in `review.html`.",
        ("Markierung", "Datensätze"), lambda m: _coded_counts(FLAG_LABELS, m["flags"]),
    ),
    (
        "Dubletten", "{n_merged} Kontakte entstanden aus mehreren Zeilen. Größte Gruppe: {largest} Zeilen.",
        ("Zeilen je Gruppe", "Ausgabedatensätze"), lambda m: [[s, number(n)] for s, n in sorted(m["group_sizes"].items())],
    ),
    (
        "Unbrauchbare Werte", "Was sich nicht lesen ließ, steht unverändert in der Spalte `notes`.",
        ("Art", "Anzahl"), lambda m: [[k, number(n)] for k, n in sorted(m["unusable"].items())],
    ),
)
#: What has been checked when a report is written.
CHECKS = (
    "Die Summe aus ausgeschlossenen, zusammengeführten und ausgegebenen Zeilen ist die Zahl der Eingangszeilen.",
    "Jede Eingangs-ID kommt im Ergebnis genau einmal vor.",
    "Alle Adressen und Nummern der Eingabe sind im Ergebnis zu finden.",
    "In `clean.csv` wiederholt sich keine Adresse, Nummer oder ID.",
    "Adressen, Nummern und Daten haben ihre Form.",
    "Die gelesenen Dateien bestehen dieselben Prüfungen wie die Tabellen davor.",
)


def report(m: dict, warnings: Iterable[str] = ()) -> Iterator[str]:
    """The report in pieces. m: the metrics of a run (see plans.cleanup)."""
    shown = {k: number(v) for k, v in m.items() if isinstance(v, int)}
    shown["n_merged"] = number(sum(n for size, n in m["group_sizes"].items() if size > 1))
    shown["largest"] = number(max(m["group_sizes"], default=0))
    yield "# Bereinigungsbericht\n"
    for title, text, columns, rows in SECTIONS:
        lines = ["", f"## {title}", "", *([text.format(**shown), ""] if text else []), *markdown_table(list(columns), rows(m))]
        yield "\n".join(lines) + "\n"
    yield "\nProbe: {n_input} = {n_excluded} + {n_absorbed} + {n_output}.\n".format(**shown)
    yield "\n".join(["", "## Prüfungen (alle bestanden)", "", *(f"- {c}" for c in CHECKS)]) + "\n"
    for k, warning in enumerate(warnings):
        yield ("\n## Warnungen\n\n" if not k else "") + f"- {warning}\n"


_STYLE = """
body { font: 15px/1.45 sans-serif; margin: 2rem auto; max-width: 72rem; padding: 0 1rem; color: #222 }
table { border-collapse: collapse; width: 100%; margin: .5rem 0 } td, th { border: 1px solid #ccc; padding: .3rem .5rem; text-align: left }
.numbers { display: flex; gap: 1rem; flex-wrap: wrap } .numbers div { border: 1px solid #ccc; padding: .6rem 1rem }
.numbers b { display: block; font-size: 1.5rem } .pill { background: #eee; border-radius: .6rem; padding: 0 .5rem; margin-right: .3rem }
"""
_SCRIPT = """
document.getElementById('find').oninput = function () {
  var wanted = this.value.toLowerCase();
  for (var row of document.getElementsByClassName('row')) row.style.display = row.innerText.toLowerCase().indexOf(wanted) < 0 ? 'none' : '';
};
"""


def _row(cells: Iterable[str], pills: Iterable[str] = ()) -> str:
    badges = "".join(f'<span class="pill">{escape(p)}</span>' for p in pills)
    return f'<tr class="row">{"".join(f"<td>{escape(c)}</td>" for c in cells)}<td>{badges}</td></tr>\n'


def _head(names: Iterable[str]) -> str:
    return f"<table><thead><tr>{''.join(f'<th>{escape(n)}</th>' for n in names)}</tr></thead><tbody>\n"


_CLOSE = "</tbody></table></details>"


def review_page(m: dict, contacts: DataFrame, excluded: DataFrame, grouped: DataFrame) -> Iterator[str]:
    """The page in pieces. Rows are streamed from the executors partition by partition, so the
    driver never holds a whole table; members are fetched for the largest groups alone."""
    yield '<!doctype html><html lang="de"><head><meta charset="utf-8"><title>Prüfung vor dem Import</title>'
    yield f"<style>{_STYLE}</style></head><body><h1>Prüfung vor dem Import</h1>"
    yield "<p>Ausgeschlossene Zeilen und Grenzfälle zur Prüfung durch einen Menschen. Nichts davon wurde gelöscht. "
    yield 'Diese Seite enthält Kontaktdaten: Bitte veröffentlichen Sie sie nicht.</p><div class="numbers">'
    for label, key in (
        ("Eingangszeilen", "n_input"), ("Ausgeschlossen", "n_excluded"), ("Zusammengeführt", "n_absorbed"),
        ("Verdächtig markiert", "n_suspect"), ("Saubere Kontakte", "n_output"),
    ):
        yield f"<div>{label}<b>{number(m[key])}</b></div>"
    yield '</div><p><label>Alle Tabellen dieser Seite filtern <input id="find" type="search" placeholder="Name, E-Mail, Telefon oder Grund suchen"></label></p>'
    yield "<h2>Freigabe</h2><ul>"
    for line in (
        f"Ich habe die {number(m['n_excluded'])} ausgeschlossenen Zeilen durchgesehen, keine davon ist ein echter Kontakt.",
        f"Ich habe die {number(m['n_suspect'])} verdächtigen Datensätze durchgesehen und jeden korrigiert oder akzeptiert.",
        "Die größten Zusammenführungsgruppen unten sind jeweils dieselbe Person oder Firma.",
    ):
        yield f'<li><label><input type="checkbox"> {line}</label></li>'
    yield f"</ul><h2>Ausgeschlossene Zeilen ({number(m['n_excluded'])})</h2>"
    order = _by_count(m["reasons"])
    section = F.array_position(F.lit([code for code, _ in order] or [""]), F.col("reason_code"))
    rows = excluded.select("index", "id", "name", "email", "phone", "reason", section.alias("section"))
    opened = 0
    for r in rows.orderBy("section", "index").toLocalIterator():
        while opened < r["section"]:
            code, n = order[opened]
            yield _CLOSE * (opened > 0)
            yield f'<details data-reason="{escape(code)}"><summary>{escape(REASON_LABELS.get(code, code))} ({number(n)})</summary>'
            yield _head(["ID", "Name", "E-Mail", "Telefon", "Grund"])
            opened += 1
        yield _row([r["id"], r["name"], r["email"], r["phone"]], [r["reason"]])
    yield _CLOSE * (opened > 0)
    yield f"<h2>Verdächtige Datensätze ({number(m['n_suspect'])})</h2>" + _head(["ID", "Name", "E-Mail", "Telefon", "Warum markiert"])
    suspects = contacts.where(F.size("flags") > 0).select("component", "id", "name", "emails", "phones", "flags")
    for r in suspects.orderBy("component").toLocalIterator():
        yield _row([r["id"], r["name"], next(iter(r["emails"]), ""), next(iter(r["phones"]), "")], [f["text"] for f in r["flags"]])
    yield "</tbody></table><h2>Größte Zusammenführungsgruppen</h2>"
    top = contacts.where("n_members > 1").orderBy(F.desc("n_members"), "leader_index").limit(10).collect()
    known = {c["component"]: c for c in top}
    place = F.array_position(F.lit(list(known) or [0]), F.col("component")).alias("group")
    members = with_place(grouped.where(F.col("component").isin(list(known)))).select(
        place, "place", "component", "uid", "name", "emails", "phones"
    )
    now = None
    for r in members.orderBy("group", "place").toLocalIterator() if top else ():
        c = known[r["component"]]
        if now != r["component"]:
            yield _CLOSE * (now is not None)
            now = r["component"]
            yield f"<details><summary>{c['n_members']} Zeilen zu <code>{escape(c['id'])}</code> ({escape(c['name'])})</summary>"
            yield _head(["Zeile", "Name", "E-Mail", "Telefon", "Rolle"])
        role = "führt" if r["uid"] == c["id"] else "zusammengeführt"
        yield _row([r["uid"], r["name"], ", ".join(r["emails"]), ", ".join(r["phones"])], [role])
    yield _CLOSE * (now is not None)
    if not top:
        yield "<p>Keine Dubletten gefunden.</p>"
    yield f"<script>{_SCRIPT}</script></body></html>\n"
