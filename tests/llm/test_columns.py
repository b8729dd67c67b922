"""Operators that keep the columns of their input do so whatever those are called."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from contactmill.llm import decontaminate, html_extract, ngram_join, packing, pii, shards, toxicity, url_filter

#: Names that some operator uses inside, and some that they add (those are replaced, as they say).
NAMES = (
    "id key row n order number cut room parts part place often begin count salt bucket_ hashed gone_id gone_key mine other "
    "lead best short whole digest lengths expression rank ranks text_digest type canonical new member payload kind first "
    "label y0 features sketch class check cluster shingles known leads block component_id node component total value"
).split()


def chain():
    models = (toxicity.Linear(np.zeros(0), -1.0),)
    return toxicity.Chain(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int), ("toxic",), models)


OPERATORS = {
    "near copies": (lambda spark, df: ngram_join.one_of_each_group(df), set()),
    "decontamination": (
        lambda spark, df: decontaminate.drop_contaminated(df, spark.createDataFrame([("1", "no such words")], "item_id string, text string")),
        set(),
    ),
    "pii": (lambda spark, df: pii.pseudonymise(df), {"n_entities", "entity_types"}),
    "packing": (
        lambda spark, df: packing.pack(df, tokens=lambda c: F.length(F.coalesce(c, F.lit("")))),
        {"n_tokens", "bucket", "boundary", "batch", "slot"},
    ),
    "sharding": (lambda spark, df: shards.external_shuffle(df), {"shard", "grown_shard", "slot"}),
    "toxicity": (lambda spark, df: toxicity.predict(df, chain()), {"p_toxic", "is_toxic"}),
    "urls": (
        lambda spark, df: url_filter.judge(df, spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string"), "text"),
        {"host", "path", "rule", "verdict"},
    ),
    "html": (lambda spark, df: html_extract.extract(df, "text", "extracted"), {"extracted"}),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_of_any_name(spark, name):
    operator, added = OPERATORS[name]
    texts = ["a plain text of some words", None, "", "Mr. Smith 1.2.3.4 http://a.com/en/x", "x://b.net/de/1"]
    names = [*NAMES, *added]
    rows = [(i, t, *[f"{c}{i}" for c in names]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, f"doc_id long, text string, {', '.join(f'`{c}` string' for c in names)}")
    got = {r["doc_id"]: r for r in operator(spark, df).collect()}
    assert sorted(got) == list(range(len(texts)))
    for i, r in got.items():
        assert all(r[c] == f"{c}{i}" for c in NAMES)
        assert all(r[c] != f"{c}{i}" for c in added)
    empty = operator(spark, df.limit(0))
    assert empty.count() == 0 and set(NAMES) | added <= set(empty.columns)
