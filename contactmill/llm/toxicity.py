"""Toxicity: a classifier chain of linear models over words and beginnings of words.

The labelled categories are predicted one after the other, the target last; each model sees the
features of a document and the probabilities of the categories before its own. In training those
come from models that have not seen the document (out-of-fold), so that later models learn from
predictions as good as they will get.

A feature is a word, or the first bytes of words, that occurs at least once, twice or three times
in a text. All features count that at least SUPPORT labelled rows have and that tell more of the
target, for or against it, than the best of as many random ones would; the fit is a logistic
regression with a ridge, by Newton steps. Models are fitted on the driver, on at most SAMPLE
labelled rows, chosen by a hash of their id; prediction covers every row, and all that tasks get is
the chain with its features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactmill.llm import textkernel as K
from contactmill.session import bounded_batches, discard, materialise

U64 = np.uint64
#: Labelled rows that the chain is fitted on, at most.
SAMPLE = 8_000
#: Rows that a feature must occur in.
SUPPORT = 3
#: Lengths in bytes of beginnings of words; 0: whole words.
HEADS = (0, 4, 5, 6, 7, 8)
#: A feature asks for this many occurrences.
TIMES = 3
FOLDS = 5
RIDGE = 0.1
THRESHOLD = 0.5
#: Least hashes by which near copies among the labelled rows are known.
SKETCH = 64
#: So many of them agree, at least, where two rows are near copies: a Jaccard similarity of about 0.8.
AGREE = 52
#: Columns of labels that the chain predicts, in this order, where the labels have them.
CATEGORIES = ("quality", "toxic")


def _words(texts) -> Iterator[tuple[int, int, K.Words]]:
    """(first row, row after the last, words) for each chunk of a column, in lower case."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    buf, offsets = K.string_buffer(pc.utf8_lower(texts))
    for lo, hi in K.chunks(offsets, rows=2_000):
        yield lo, hi, K.words(buf, offsets[lo : hi + 1], K.ALNUM)


def tokens(found: K.Words) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash) of all words and beginnings of words."""
    at, values = [], []
    for size in HEADS:
        word, value = found.heads(size) if size else (np.arange(len(found.hash)), found.hash)
        at.append(word)
        values.append(K.mix(value + U64(size)))
    return np.concatenate(at), np.concatenate(values)


def counted(found: K.Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs without repeats: feature = token, plus its count up to TIMES."""
    word, value = tokens(found)
    row = np.searchsorted(found.offsets, word, side="right") - 1
    order = np.argsort(value)
    order = order[np.argsort(row[order].astype(np.uint16), kind="stable")]
    row, value = row[order], value[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    begin = np.flatnonzero(first)
    times = np.diff(np.append(begin, len(row)))
    row, value = row[begin], value[begin]
    rows, features = [], []
    for k in range(TIMES):
        some = times > k
        rows.append(row[some])
        features.append(feature(value[some], k))
    return np.concatenate(rows), np.concatenate(features)


def feature(token: np.ndarray, times: int) -> np.ndarray:
    return K.mix(token ^ U64((times + 1) * 0x9E3779B97F4A7C15 % 2**64))


@dataclass(frozen=True)
class Linear:
    weights: np.ndarray  # of the features, then of the categories before
    bias: float

    def probability(self, x: np.ndarray, before: np.ndarray) -> np.ndarray:
        z = self.bias + x @ self.weights[: x.shape[1]] + before @ self.weights[x.shape[1] :]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass(frozen=True)
class Chain:
    features: np.ndarray  # ascending
    tokens: np.ndarray  # ascending: those that the features ask for
    place: np.ndarray  # of each feature: its token
    times: np.ndarray  # and how often it must occur
    categories: tuple[str, ...]
    models: tuple[Linear, ...]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """A column for each category, in the order of the chain."""
        out = np.zeros((len(x), 0))
        for model in self.models:
            out = np.column_stack([out, model.probability(x, out)])
        return out

    def presence(self, found: K.Words) -> np.ndarray:
        """1 where a text has a feature."""
        rows, width = len(found.offsets) - 1, len(self.tokens)
        if not width or not rows:
            return np.zeros((rows, len(self.features)))
        word, value = tokens(found)
        at = np.minimum(np.searchsorted(self.tokens, value), width - 1)
        hit = np.flatnonzero(self.tokens[at] == value)
        row = np.searchsorted(found.offsets, word[hit], side="right") - 1
        counts = np.bincount(row * width + at[hit], minlength=rows * width).reshape(rows, width)
        return (counts[:, self.place] >= self.times).astype(float)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> Linear:
    """Logistic regression with a ridge on all weights but the bias, by Newton steps."""
    n, width = x.shape
    rate = (y.sum() + 0.5) / (n + 2)
    w = np.append(np.zeros(width), np.log(rate / (1 - rate)))
    if 0 < y.sum() < n:
        full = np.column_stack([x, np.ones(n)])
        penalty = np.append(np.full(width, ridge), 0)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(full @ w, -40, 40)))
            slope = full.T @ (p - y) + penalty * w
            curve = (full * (p * (1 - p) + 1e-9)[:, None]).T @ full + np.diag(penalty + 1e-6)
            step = np.linalg.solve(curve, slope)
            w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-4:
                break
    return Linear(w[:-1], float(w[-1]))


def evidence(has, toxic, n: int, t: int) -> np.ndarray:
    """Likelihood ratios (2 log) of features that `has` texts have, `toxic` of them toxic, among n
    texts, t of them toxic."""

    def part(a, expected):
        return np.where(a > 0, a * np.log(np.maximum(a, 1e-9) / np.maximum(expected, 1e-9)), 0)

    return 2 * (
        part(toxic, has * t / n)
        + part(has - toxic, has * (n - t) / n)
        + part(t - toxic, (n - has) * t / n)
        + part(n - t - has + toxic, (n - has) * (n - t) / n)
    )


def fit_chain(x: np.ndarray, labels: list[np.ndarray], folds: int = FOLDS) -> tuple[Linear, ...]:
    """A model for each category, in the order of the chain."""
    fold = np.arange(len(x)) % folds
    models, before = [], np.zeros((len(x), 0))
    for target in labels:
        full = np.column_stack([x, before])
        out = np.zeros(len(x))
        for k in range(folds):
            rest, held = fold != k, fold == k
            if held.any():
                out[held] = fit(full[rest], target[rest]).probability(x[held], before[held])
        models.append(fit(full, target))
        before = np.column_stack([before, out])
    return tuple(models)


def first_of_copies(sketches: list[bytes]) -> list[int]:
    """Places of the sketches that agree with none kept before in AGREE least hashes; empty ones are
    all kept. A group of near copies has one label, right or wrong, and would make its words look
    telling.

    Where two agree so far, at most SKETCH - AGREE hashes differ, so that of one part more than that
    some part is equal; only sketches with an equal part are compared.
    """
    kept: dict[tuple[int, bytes], list[int]] = {}
    keep, rows = [], np.zeros((len(sketches), SKETCH), U64)
    cuts = np.linspace(0, SKETCH, SKETCH - AGREE + 2).astype(int).tolist()
    for i, raw in enumerate(sketches):
        if not raw:
            keep.append(i)
            continue
        rows[i] = np.frombuffer(raw, U64)
        parts = [(a, rows[i, a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
        near = list({j for part in parts for j in kept.get(part, ())})
        if not ((rows[near] == rows[i]).sum(1) >= AGREE).any():
            keep.append(i)
            for part in parts:
                kept.setdefault(part, []).append(i)
    return keep


def _sketches(batches):
    for batch in batches:
        for lo, hi, found in _words(batch.column(1)):
            hashes, offsets = K.shingle_hashes(found)
            out = np.zeros((hi - lo, SKETCH), U64)
            some = np.flatnonzero(np.diff(offsets))
            for k in range(SKETCH if len(some) else 0):
                salted = K.mix(hashes ^ U64((k + 1) * 0xD6E8FEB86659FD93 % 2**64))
                out[some, k] = np.minimum.reduceat(salted, offsets[some])
            raw = [row.tobytes() if size else b"" for row, size in zip(out, np.diff(offsets))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(raw, pa.binary())], ["row", "sketch"]
            )


def _feature_counts(kept):
    """Batches of (row, text, label) -> (feature, token, times, has, toxic) of the kept rows."""

    def run(batches):
        wanted = kept.value
        for batch in batches:
            use = np.array([r in wanted for r in batch.column(0).to_pylist()], bool)
            if not use.any():
                continue
            batch = batch.filter(pa.array(use))
            label = batch.column(2).to_numpy() > 0
            for lo, _, found in _words(batch.column(1)):
                rows, features = counted(found)
                names, place = np.unique(features, return_inverse=True)
                has = np.bincount(place)
                toxic = np.bincount(place, label[lo + rows].astype(float)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.view(np.int64)), pa.array(has), pa.array(toxic)], ["feature", "has", "toxic"]
                )

    return run


def _chosen_features(kept, chosen: np.ndarray):
    """Batches of (row, text) -> (row, its chosen features) of the kept rows."""

    def run(batches):
        wanted = kept.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, found in _words(batch.column(1)):
                rows, features = counted(found)
                hit = np.isin(features, chosen)
                rows, features = rows[hit], features[hit]
                features = features[np.argsort(rows, kind="stable")]
                ends = np.cumsum(np.bincount(rows, minlength=hi - lo)).tolist()
                use = [i for i in range(hi - lo) if ids[lo + i] in wanted]
                raw = [features[ends[i - 1] if i else 0 : ends[i]].tobytes() for i in use]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[lo + i] for i in use], pa.int64()), pa.array(raw, pa.binary())], ["row", "features"]
                )

    return run


def _tokens_of(chosen: np.ndarray):
    """Batches of text -> (feature, token, times) of the chosen features."""

    def run(batches):
        for batch in batches:
            for _, _, found in _words(batch.column(0)):
                value = np.unique(tokens(found)[1])
                for k in range(TIMES):
                    hit = np.isin(feature(value, k), chosen)
                    if hit.any():
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(feature(value[hit], k).view(np.int64)),
                                pa.array(value[hit].view(np.int64)),
                                pa.array(np.full(int(hit.sum()), k + 1, np.int32)),
                            ],
                            ["feature", "token", "times"],
                        )

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    categories: tuple[str, ...] = CATEGORIES,
    sample: int = SAMPLE,
) -> Chain:
    """A chain fitted on the rows of labels (id, and 0 or 1 for each category) that docs has.

    The last of the categories is the target, which labels must have; of the others those are
    predicted that labels has. At most about `sample` rows are used, chosen by a hash of the id. Rows
    with a null id or target are left out; a null in an earlier category counts as 0; a null text has
    no words. An id with several labels or texts counts each time, but of rows that are near copies
    only the first. Without any labelled row, or with labels of one kind, the chain has no features
    and its probabilities are the smoothed share of positive rows (a quarter without labels, so that
    nothing is called toxic).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    target = categories[-1]
    names = [c for c in categories if c in labels.columns]
    places = [F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(f"y{k}") for k, c in enumerate(names)]
    known = labels.where(F.col(id_col).isNotNull() & F.col(target).isNotNull()).select(F.col(id_col).alias("id"), *places)
    total = known.count()
    if total > sample:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < (sample << 30) // total)
    # at most about `sample` rows, so the broadcast is bounded
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id")
    # rows have a number of their own, the same however the table is read
    marks = [f"y{k}" for k in range(len(names))]
    rows = chosen.select(F.xxhash64("id", "text", *marks).alias("row"), "text", F.col(marks[-1]).alias("label"), *marks)
    rows, path = materialise(rows.dropDuplicates(["row"]), "labelled")

    sketches = {r["row"]: bytes(r["sketch"]) for r in
                rows.select("row", "text").mapInArrow(_sketches, "row long, sketch binary").collect()}
    order = sorted(sketches)
    kept = spark.sparkContext.broadcast({order[i] for i in first_of_copies([sketches[r] for r in order])})
    given = {r["row"]: [float(r[m] > 0) for m in marks] for r in rows.select("row", *marks).collect() if r["row"] in kept.value}

    n, t = len(given), int(sum(y[-1] for y in given.values()))
    counts = rows.select("row", "text", "label").mapInArrow(_feature_counts(kept), "feature long, has long, toxic long")
    counts = counts.groupBy("feature").agg(F.sum("has").alias("has"), F.sum("toxic").alias("toxic"))
    counts = counts.where(F.col("has") >= SUPPORT).collect() if 0 < t < n else []
    value = np.array([r["feature"] for r in counts], np.int64)
    has, toxic = (np.array([r[c] for r in counts], float) for c in ("has", "toxic"))
    features = np.zeros(0, U64)
    if len(value):
        # what chance alone reaches among so many features is left out
        features = np.sort(value[evidence(has, toxic, n, t) > 2 * np.log(len(value)) + 4].view(U64))

    found = rows.select("row", "text").mapInArrow(_chosen_features(kept, features), "row long, features binary").collect()
    found.sort(key=lambda r: r["row"])
    x = np.zeros((len(found), len(features)))
    for i, r in enumerate(found):
        x[i, np.searchsorted(features, np.frombuffer(r["features"], U64))] = 1
    y = np.array([given[r["row"]] for r in found]).reshape(len(found), len(names))
    models = fit_chain(x, list(y.T))

    origin = rows.select("text").mapInArrow(_tokens_of(features), "feature long, token long, times int")
    origin = {r["feature"]: r for r in origin.distinct().collect()}
    of = np.array([origin[f]["token"] for f in features.view(np.int64).tolist()], np.int64).view(U64)
    times = np.array([origin[f]["times"] for f in features.view(np.int64).tolist()], np.int64)
    distinct, place = np.unique(of, return_inverse=True)
    discard(spark, path)
    return Chain(features, distinct, place, times, tuple(names), models)


def predict(docs: DataFrame, chain: Chain, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of docs, p_<category> for each category of the chain, and is_<the last one>.

    A null or empty text has no words: it gets the chain's probabilities for none. Repeated rows
    get equal results. Columns of docs with the added names are replaced. An empty table gives an
    empty result.
    """
    bounded_batches(docs.sparkSession)
    added = [f"p_{c}" for c in chain.categories] + [f"is_{chain.categories[-1]}"]
    docs = docs.select(*[c for c in docs.columns if c.lower() not in added])
    names = [*docs.columns, *added]
    at = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    schema = docs.select("*", *[F.lit(0.0).alias(c) for c in added[:-1]], F.lit(True).alias(added[-1])).schema

    def run(batches):
        model = shared.value
        for batch in batches:
            parts = [np.zeros((0, len(added) - 1))]
            for _, _, found in _words(batch.column(at)):
                parts.append(model.probabilities(model.presence(found)))
            p = np.concatenate(parts)
            columns = [pa.array(p[:, k]) for k in range(p.shape[1])] + [pa.array(p[:, -1] >= threshold)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names)

    return docs.mapInArrow(run, schema)
