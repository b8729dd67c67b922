import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contactmill.llm import toxicity as tx


@pytest.fixture(scope="module")
def data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality", "toxic")
    return docs, labels


def test_held_out(spark):
    """Trained on two thirds of the labels, the chain is right on the others."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    third = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    chain = tx.train(docs, labels.where(~third))
    rows = tx.predict(docs.join(labels.where(third), "doc_id"), chain).collect()
    clean = [r["is_toxic"] for r in rows if r["toxic"] == 0]
    toxic = [r["is_toxic"] for r in rows if r["toxic"] == 1]
    assert len(toxic) > 100 and np.mean(clean) < 0.02 and np.mean(toxic) >= 0.9
    assert {"p_quality", "p_toxic"} <= set(rows[0].asDict())


def test_fit_against_plain_gradient_steps():
    """Newton steps end where the penalised likelihood has no slope."""
    rng = np.random.default_rng(2)
    x = (rng.random((300, 6)) < 0.4).astype(float)
    y = (x @ np.array([2.0, -1, 0, 1, 0, 0]) + rng.normal(size=300) > 0.7).astype(float)
    model = tx.fit(x, y)
    w, bias = np.zeros(6), 0.0
    for _ in range(60_000):
        p = 1 / (1 + np.exp(-(bias + x @ w)))
        w -= 0.01 * (x.T @ (p - y) + tx.RIDGE * w)
        bias -= 0.01 * (p - y).sum()
    assert np.allclose(model.weights, w, atol=0.01) and abs(model.bias - bias) < 0.01


def test_same_however_partitioned(spark, data):
    docs, labels = data
    a = tx.train(docs, labels)
    b = tx.train(docs.repartition(7), labels.repartition(3))
    assert a.features.tolist() == b.features.tolist()
    assert all(np.allclose(m.weights, n.weights) for m, n in zip(a.models, b.models))


def test_edges(spark, data):
    docs, labels = data
    chain = tx.train(docs, labels)
    df = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (None, "IDIOT! Moron, stupid clown scum", "x")], "doc_id long, text string, p_toxic string")
    rows = tx.predict(df, chain).collect()
    assert [r["is_toxic"] for r in rows] == [False, False, True] and rows[0]["p_toxic"] == rows[1]["p_toxic"]
    alone = tx.train(docs, labels.select("doc_id", "toxic"))
    assert alone.categories == ("toxic",) and tx.train(docs, labels.withColumn("quality", F.lit(None).cast("int"))).categories == tx.CATEGORIES
    assert tx.predict(df.limit(0), chain).count() == 0
    for known in (labels.limit(0), labels.withColumn("toxic", F.lit(0)), labels.withColumn("toxic", F.lit(None).cast("int"))):
        flat = tx.train(docs, known)
        assert not len(flat.features) and not tx.predict(df, flat).where("is_toxic").count()


def test_chain_uses_earlier_categories():
    rng = np.random.default_rng(0)
    x = (rng.random((600, 4)) < 0.3).astype(float)
    y = ((x[:, 0] + x[:, 1]) > 0).astype(float)
    models = tx.fit_chain(x, [x[:, 0], x[:, 1], y])
    assert [len(m.weights) for m in models] == [4, 5, 6]
    p = tx.Chain(np.zeros(4, np.uint64), np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), ("a", "b", "toxic"), models).probabilities(x)
    assert ((p[:, 2] > 0.5) == (y > 0)).mean() > 0.98


def test_only_near_copies_are_left_out():
    """Rows that share a passage all count; of rows that differ in a word only the first."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choice(words, 80))
    texts = [passage + " " + " ".join(rng.choice(words, 120)) for _ in range(60)]
    copies = [t.rsplit(" ", 1)[0] + " other" for t in texts]
    batch = pa.RecordBatch.from_pydict({"row": list(range(122)), "text": texts + copies + ["", ""]})
    sketches = [x for out in tx._sketches([batch]) for x in out.column(1).to_pylist()]
    assert tx.first_of_copies(sketches) == [*range(60), 120, 121]
