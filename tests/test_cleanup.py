import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from contactmill import cli, config
from contactmill.plans import cleanup, synth
from contactmill.sources import csv as source
from contactmill.streaming import incoming

HEAD_A, HEAD_B = list(synth.LAYOUTS["a"].values()), list(synth.LAYOUTS["b"].values())
ROWS_A = [
    ["1", "Anna Müller", "anna@example.com", "0151 0000 0001", "Eins", "Köln", "2024-01-02"],
    ["2", "ANNA MÜLLER", "Anna <ANNA@example.com>", "", "", "", ""],
    ["3", "Anna M.", "", "+49 151 00000001", "", "Bonn", "n/a"],
    ["4", "Test Test", "t@example.com", "", "", "", ""],
    ["5", "Kim", "kim@example.org", "0151 00000001", "", "", ""],
    ["6", "Xkjhsd Qwrtpl", "x@example.com", "", "", "", ""],
    ["7", "Niemand", "", "keine", "", "", ""],
    ["8", "<b>Bo 1</b>", "bo@example.com", "", "a, \"b\"\nc", "", "31.12.2023"],
    ["", "Ohne Nummer", "o@example.com", "", "", "", ""],
]
ROWS_B = [["1", "lena", "von stein", "L@example.com", "0151 00000009", "0151 00000010", "", "", "03.02.2024 10:00"]]


def write(path, head, rows, **options):
    with open(path, "w", newline="", **{"encoding": "utf-8-sig"} | options) as f:
        csv.writer(f).writerows([head, *rows])


@pytest.fixture()
def exports(tmp_path):
    write(tmp_path / "export_a.csv", HEAD_A, ROWS_A)
    write(tmp_path / "export_b.csv", HEAD_B, ROWS_B)
    return tmp_path


@pytest.fixture(scope="session")
def settings():
    return config.load(os.path.join(os.path.dirname(__file__), "..", "config.example.toml"))


def test_end_to_end(spark, exports, settings, capsys):
    out = exports / "out"
    code = cli.main(["run", "--input", str(exports / "export_*.csv"), "--out", str(out), "--config",
                     os.path.join(os.path.dirname(__file__), "..", "config.example.toml")], spark)
    assert code == 0
    shown = capsys.readouterr().out.splitlines()
    assert shown[0] == "Eingangszeilen          10" and shown[1].startswith("Ausgeschlossen           4   -> ")
    with open(out / "clean.csv", encoding="utf-8", newline="") as f:
        clean = list(csv.DictReader(f))
    assert [r["id"] for r in clean] == ["export_a:1", "export_a:8", "export_a:row9", "export_b:1"]
    assert clean[0]["merged_from"] == "export_a:2 | export_a:3" or clean[0]["merged_from"] == "export_a:3 | export_a:2"
    assert clean[1]["company"] == 'a, "b" c' and clean[1]["suspect"] == "yes"
    assert clean[3] == clean[3] | {"name": "Lena von Stein", "phone_2": "+4915100000010", "created": "2024-02-03"}
    raw = (out / "clean.csv").read_bytes()
    assert raw.startswith(",".join(cleanup.CLEAN).encode() + b"\n") and b"\r" not in raw
    with open(out / "excluded.csv", encoding="utf-8", newline="") as f:
        assert [(r["id"], r["reason_code"], r["row"]) for r in csv.DictReader(f)] == [
            ("export_a:4", "test_entry", "4"), ("export_a:5", "internal", "5"), ("export_a:6", "keyboard_mash", "6"),
            ("export_a:7", "no_contact", "7"),
        ]
    page = (out / "review.html").read_text(encoding="utf-8")
    assert "&lt;b&gt;Bo 1&lt;/b&gt;" in page and "<b>Bo 1" not in page and 'data-reason="internal"' in page
    report = (out / "report.md").read_text(encoding="utf-8")
    assert "Probe: 10 = 4 + 2 + 4." in report and "| Testeinträge (`test_entry`) | 1 |" in report
    assert "| unbrauchbare Telefonnummer | 1 |" in report and sorted(os.listdir(out)) == ["clean.csv", "excluded.csv", "report.md", "review.html"]


def test_load_errors_and_ids(spark, tmp_path, settings):
    write(tmp_path / "export_a1.csv", HEAD_A, [["7", "A B"] + [""] * 5, ["7", "C D"] + [""] * 5, ["x|y", "E"] + [""] * 5])
    with pytest.raises(config.ConfigError, match="export_a1.csv, Zeile 3"):
        source.load_records(spark, [str(tmp_path / "export_a1.csv")], settings)
    write(tmp_path / "export_a1.csv", HEAD_A, [["7", "A B"] + [""] * 5, ["7", "C D"] + [""] * 5])
    for folder in ("p", "q", "r"):
        os.makedirs(tmp_path / folder)
        write(tmp_path / folder / "export_a.csv", HEAD_A, [["7", "A B"] + [""] * 5])
    rows = source.load_records(spark, [str(tmp_path / "export_a1.csv")], settings).orderBy("index").collect()
    assert [(r["uid"], r["duplicate"]) for r in rows] == [("export_a1:7", False), ("export_a1:7@row2", True)]
    paths = source.expand_inputs(spark, [str(tmp_path / "r/*.csv"), str(tmp_path / "?/export_a.csv"), str(tmp_path / "p/../p/export_a.csv")])
    assert len(paths) == 3 and paths == sorted(paths)
    uids = [r["uid"] for r in source.load_records(spark, paths, settings).collect()]
    assert len(set(uids)) == 3
    write(tmp_path / "export_a2.csv", HEAD_A[:3], [])
    write(tmp_path / "other.csv", HEAD_A, [])
    for name, text in (("export_a2.csv", "fehlen in der Datei"), ("other.csv", "Kein"), ("none.csv", "Keine Eingabedatei")):
        with pytest.raises(config.ConfigError, match=text):
            source.load_records(spark, source.expand_inputs(spark, [str(tmp_path / name)]), settings)


def test_encodings_and_odd_rows(spark, tmp_path):
    made = config.from_dict({"source": [{"match": "*.csv", "delimiter": ";", "encoding": "cp1252", "columns": {"name": "N", "email": "M"}}]})
    (tmp_path / "x.csv").write_bytes("N;M;N\nzuerst;a@example.com;Jürgen €\n\n ;;\nkurz\n".encode("cp1252"))
    rows = source.load_records(spark, [str(tmp_path / "x.csv")], made).orderBy("index").collect()
    assert [(r["row"], r["name"], r["emails"]) for r in rows] == [(1, "Jürgen €", ["a@example.com"]), (2, "", []), (3, "", [])]


@pytest.mark.parametrize("raw, text", [
    ({}, "keinen"), ({"source": [{"columns": {}}]}, "match"), ({"source": [{"match": "*", "columns": {"x": "Y"}}]}, "Unbekannte"),
    ({"phone": {"default_country_code": "+49"}}, "Ziffern"), ({"exclude": {"test_patterns": ["("]}, "source": [{"match": "*"}]}, "Testmuster"),
])
def test_config_errors(raw, text):
    with pytest.raises(config.ConfigError, match=text):
        config.from_dict(raw)


def test_exit_codes(spark, tmp_path, capsys):
    assert cli.main(["run", "--input", "x", "--config", str(tmp_path / "none.toml")], spark) == 2
    (tmp_path / "bad.toml").write_text("= x")
    assert cli.main(["run", "--input", "x", "--config", str(tmp_path / "bad.toml")], spark) == 2
    assert "Fehler:" in capsys.readouterr().err


def test_nothing_kept(spark, tmp_path, settings):
    write(tmp_path / "export_a.csv", HEAD_A, [["1", "Niemand"] + [""] * 5])
    result = cleanup.run(spark, [str(tmp_path / "export_a.csv")], settings, str(tmp_path / "out"))
    assert result.metrics["n_output"] == 0 and "Größte Gruppe: 0 Zeilen" in (tmp_path / "out/report.md").read_text(encoding="utf-8")


@pytest.mark.parametrize("n, seed", [(800, 7), (1500, 3)])
def test_known_outcome(spark, tmp_path, settings, n, seed):
    known = synth.write(spark, n, seed, str(tmp_path))
    assert json.loads((tmp_path / "truth.json").read_text()) == known
    result = cleanup.process(spark, source.expand_inputs(spark, [str(tmp_path / "*.csv")]), settings)
    m = result.metrics
    assert {k: m[k] for k in known} == known
    before = (tmp_path / "export_a.csv").read_bytes()
    synth.write(spark, n, seed, str(tmp_path))
    assert (tmp_path / "export_a.csv").read_bytes() == before


def test_stream(spark, tmp_path, settings):
    rows = spark.createDataFrame([("a", 1, "7", "ANNA MEIER", "A@example.com"), ("a", 2, "", "Test Test", "")],
                                 "source string, row int, id string, name string, email string")
    rows.write.parquet(str(tmp_path / "in"))
    schema = "source string, row int, id string, name string, email string"
    for _ in range(2):  # the second start finds nothing new
        query = incoming.watch(spark, str(tmp_path / "in"), schema, settings, str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("row").collect()
    assert [(r["uid"], r["name"], [x["code"] for x in r["reasons"]]) for r in got] == [
        ("a:7", "Anna Meier", []), ("a:row2", "Test Test", ["test_entry", "no_contact"]),
    ]
    assert got[0]["emails"] == ["a@example.com"] and spark.read.parquet(str(tmp_path / "out")).select(F.count("*")).first()[0] == 2
