import os

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from contactmill.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, tiny, name):
    con = duckdb.connect()
    for file in os.listdir(tiny):
        con.sql(f"create view {file.split('.')[0]} as select * from read_parquet('{tiny}/{file}')")
    got, want = queries.QUERIES[name](spark, tiny), con.sql(queries.SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    order = ", ".join(f'"{c}"' for c in columns)
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want.project(order).fetchall()))


def test_decontamination_in_several_passes(spark, monkeypatch):
    """A benchmark dealt into many table sets finds the same as one set does."""
    from contactmill.llm import decontaminate as dc

    text = " ".join(f"w{i % 37}" for i in range(60))
    items = spark.createDataFrame(
        [("1", text), ("2", "only three words"), ("3", None), (None, "x y"), ("4", "W1, w2! w3"), ("5", "zz")], "item_id string, text string"
    )
    docs = spark.createDataFrame(
        [(1, f"a b {text} c"), (2, None), (2, ""), (3, "Only  THREE-words and w1 w2 w3 zz"), (3, "Only  THREE-words and w1 w2 w3 zz"),
         (None, "zz zz"), (5, "clean text only three word")],
        "doc_id long, text string",
    )
    whole = sorted(map(str, dc.contamination(docs, items).collect()))
    split = sorted(map(str, dc.contamination(docs, items, table_bytes=20).collect()))
    assert whole == split
    got = {r["doc_id"]: r for r in dc.contamination(docs, items).collect()}
    assert (got[1]["n_hit"], got[3]["n_hit"], got[3]["n_items"], got[None]["n_hit"], got[5]["n_hit"]) == (60, 7, 3, 2, 0)
    assert dc.contamination(docs.limit(0), items).count() == 0
    assert dc.contamination(docs, items.limit(0)).where("contaminated").count() == 0
    assert sorted(r["doc_id"] or 0 for r in dc.drop_contaminated(docs, items).collect()) == [2, 2, 5]


def test_url_edges(spark):
    from contactmill.llm import url_filter as uf

    rules = spark.createDataFrame([*uf.RULES, ("b.com", "", "allow"), (None, "/", "block"), ("x.y", "/p", "allow"), ("x.y", "/p", "block")],
                                  "host string, path string, verdict string")
    cases = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme": ("", "", None, "allow"),
        "http://A.COM/en/7?x#y": ("a.com", "/en/7", "com/en/", "block"), "http://example.com/en/77": ("example.com", "/en/77", "example.com/en/7", "allow"),
        "http://notexample.com/en/77": ("notexample.com", "/en/77", "com/en/", "block"), "x://com/en/": ("com", "/en/", "com/en/", "block"),
        "x://com": ("com", "", None, "allow"), "x://q.b.com?a=/en/": ("q.b.com", "", "b.com", "allow"), "x://x.y/p": ("x.y", "/p", "x.y/p", "block"),
        "x://a.net/de#/": ("a.net", "/de", None, "allow"), "x:///en/": ("", "/en/", None, "allow"),
    }
    pages = spark.createDataFrame([(u, "r") for u in [*cases, ""]], "url string, rule string")
    rows = uf.judge(pages, rules).collect()
    assert len(rows) == len(cases) + 1
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == cases[r["url"]], r
    assert uf.judge(pages, rules.limit(0)).where("verdict = 'allow'").count() == len(cases) + 1
    assert uf.judge(pages.limit(0), rules).count() == 0


def test_tables_are_small():
    """A set of tables takes some bytes for each of the benchmark, and a prefix of all items costs no more."""
    import pickle
    import random

    from contactmill.llm import decontaminate as dc

    rng = random.Random(3)
    words = [f"w{i}" for i in range(20_000)]
    prefix = " ".join(rng.choices(words, k=60))
    items = [(str(i), prefix + " " + " ".join(rng.choices(words, k=100))) for i in range(1_500)]
    size = sum(len(t) for _, t in items)
    tables = dc.build_tables(items)
    assert size > 1_000_000 and len(pickle.dumps(tables)) < 20 * size
    prefixes = [t for t in tables.tables if t.length == 10][0]
    assert np.diff(prefixes.held).max() == 1_500 and len(prefixes.first) < 1_500 * 110


def test_search_against_plain_one():
    from contactmill.llm import decontaminate as dc
    from contactmill.llm import textkernel as K

    rng = np.random.default_rng(4)
    for _ in range(60):
        texts = [" ".join(rng.choice(["a", "B", "c", "ä"], rng.integers(0, 30))) for _ in range(12)]
        items = [(str(i), t) for i, t in enumerate(texts[:5])]
        known = dc.build_tables(items, window=3)
        w = K.words(*K.string_buffer(pa.array(texts)), K.ALNUM)
        got = set()
        for table in known.tables:
            for at, pattern in dc.search(known, table, w):
                got |= {(at, table.length, int(i)) for i in table.holders[table.held[pattern] : table.held[pattern + 1]]}
        want, split = set(), [t.lower().split() for t in texts]
        for i, ws in enumerate(split[:5]):
            m = min(3, len(ws))
            for p in range(len(ws) - m + 1 if m else 0):
                for d, other in enumerate(split):
                    want |= {(int(w.offsets[d]) + q, m, i) for q in range(len(other) - m + 1) if other[q : q + m] == ws[p : p + m]}
        assert got == want


def test_words_across_pieces():
    """Pieces of any size give the same words and hashes."""
    from contactmill.llm import textkernel as K

    texts = ["one two  three", "", "x" * 50 + " y\tz", None, "ä b", " ", "end"]
    buf, offsets = K.string_buffer(pa.array(texts))
    whole = K.words(buf, offsets, K.NONSPACE)
    assert len(whole.hash) == 9
    for piece in (1, 2, 3, 7, 1000):
        cut = K.words(buf, offsets, K.NONSPACE, piece)
        for name in ("start", "end", "hash", "offsets"):
            assert getattr(cut, name).tolist() == getattr(whole, name).tolist()
