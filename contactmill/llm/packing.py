"""Packing: optimal length buckets and token-budget batches.

The histogram of token lengths of the whole corpus decides the bucket boundaries: dynamic
programming over its lengths finds the boundaries with the least padding, exactly. Every document
is padded to its bucket's boundary; a bucket's batches hold as many documents as the token budget
has room for. Documents beyond the budget are batches of their own, without padding.

Tokens are counted once, by a byte-level BPE whose ranks are read from a file on the driver; the
rows with their lengths are then a table that all further steps read.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactmill.session import bounded_batches, broadcast_if_small, materialise

BUDGET = 16_384
BUCKETS = 8
#: Documents that one task numbers at once.
NUMBERED = 20_000
SEED = 7
#: Lines of a token's bytes in base64 and its rank.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how byte-level BPE of this vocabulary splits a text before merging.
SPLITS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ADDED = ("n_tokens", "bucket", "boundary", "batch", "slot")


@lru_cache(maxsize=2)
def _encoder(ranks: bytes):
    import tiktoken

    merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=SPLITS, mergeable_ranks=merges, special_tokens={})


def bpe_tokens(spark: SparkSession, ranks: str = RANKS):
    """A function from a text column to its number of tokens, with one for the end of the text; null
    counts as empty. The file is read on the driver; workers get its content."""
    with open(ranks, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        encode = _encoder(shared.value).encode_ordinary
        return pd.Series([len(encode(t)) + 1 if t else 1 for t in texts], dtype="int32")

    return count


def optimal_boundaries(histogram: dict[int, int], buckets: int) -> tuple[list[int], int]:
    """(ascending boundaries, padding): at most `buckets` of them, the last one the greatest length.

    best[j]: least padding of the j + 1 least lengths when the last boundary is the j-th. Choosing
    the boundary before it is a minimum over lines in the length, whose slopes fall, so that a
    lower hull with a moving pointer makes each layer linear in the number of lengths.
    """
    lengths = sorted(histogram)
    if not lengths:
        return [], 0
    number, total = [0], [0]
    for n in lengths:
        number.append(number[-1] + histogram[n])
        total.append(total[-1] + n * histogram[n])
    size = len(lengths)
    best = [lengths[j] * number[j + 1] - total[j + 1] for j in range(size)]
    came: list[list[int]] = []
    for _ in range(1, min(buckets, size)):
        hull: list[tuple[int, int, int]] = []  # (slope, intercept, index)
        at, layer, back = 0, list(best), [-1] * size
        for j in range(1, size):
            i = j - 1
            slope, cut = -number[i + 1], best[i] + total[i + 1]
            while len(hull) >= 2:
                (s1, c1, _), (s2, c2, _) = hull[-2], hull[-1]
                if (cut - c1) * (s1 - s2) <= (c2 - c1) * (s1 - slope):
                    hull.pop()
                else:
                    break
            hull.append((slope, cut, i))
            at = min(at, len(hull) - 1)
            x = lengths[j]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                at += 1
            cost = hull[at][0] * x + hull[at][1] + x * number[j + 1] - total[j + 1]
            if cost < layer[j]:
                layer[j], back[j] = cost, hull[at][2]
        came.append(back)
        best = layer
    cuts, j = [], size - 1
    for back in reversed(came):
        if j >= 0 and back[j] >= 0:
            cuts.append(lengths[j])
            j = back[j]
    cuts.append(lengths[j])
    return sorted(cuts), best[size - 1]


def with_lengths(docs: DataFrame, text_col: str = "text", tokens=None) -> DataFrame:
    """docs with n_tokens. tokens: a function from the text column to its length column; the
    byte-level BPE if none is given."""
    bounded_batches(docs.sparkSession)
    tokens = tokens or bpe_tokens(docs.sparkSession)
    return docs.drop("n_tokens").withColumn("n_tokens", tokens(F.col(text_col)).cast("int"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens=None, **options) -> DataFrame:
    """pack_lengths of docs whose lengths are counted by `tokens` (see with_lengths)."""
    return pack_lengths(with_lengths(docs, text_col, tokens), id_col, **options)


def pack_lengths(
    docs: DataFrame, id_col: str = "doc_id", budget: int = BUDGET, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """All columns of docs, which has n_tokens, and bucket, boundary, batch and slot.

    bucket counts from 0 in order of boundaries; documents longer than the budget have the bucket
    after the last and are their own boundary. batch is a number that no other batch of any bucket
    has, slot counts from 0 within the batch. In each bucket documents come in order of a seeded
    hash of id and length, dealt out over parts that one task numbers; rows that repeat an id and a
    length very often are dealt out one by one.

    A null length counts as 0, a null id is an id like others; repeated rows are placed each for
    itself. Columns of docs called bucket, boundary, batch or slot are replaced, others may have any
    name. An empty table gives an empty result. Nothing is dropped or cut.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c.lower() not in _ADDED]
    length = F.coalesce(F.col("n_tokens").cast("int"), F.lit(0))
    order = F.xxhash64(F.lit(seed), F.col(id_col), length)
    # columns of docs stay in a struct, so that their names meet no other
    rows = docs.select(
        F.struct(*own).alias("row"), length.alias("n"), order.alias("order"), F.monotonically_increasing_id().alias("number")
    )
    rows, _ = materialise(rows, "lengths")

    # lengths up to the budget and one row for all beyond: at most budget + 2 rows
    counted = rows.groupBy(F.least("n", F.lit(budget + 1)).alias("n")).count().collect()
    histogram = {r["n"]: r["count"] for r in counted}
    beyond = histogram.pop(budget + 1, 0)
    cuts, _ = optimal_boundaries(histogram, buckets)
    held = [sum(c for n, c in histogram.items() if a < n <= b) for a, b in zip([-1, *cuts], cuts)]

    plan, batches = [], 0
    for k, (cut, count) in enumerate([*zip(cuts, held), (0, beyond)]):
        room = max(1, budget // max(cut, 1)) if k < len(cuts) else 1
        plan.append((k, cut, room, batches, max(1, -(-count // NUMBERED))))
        batches += -(-count // room)
    plan = spark.createDataFrame(plan, "bucket int, cut int, room int, first_batch long, parts int")
    bucket = F.lit(len(cuts))
    for k in reversed(range(len(cuts))):
        bucket = F.when(F.col("n") <= cuts[k], k).otherwise(bucket)

    often = rows.groupBy("order").count().where(F.col("count") > max(1, NUMBERED // 4)).select("order")
    often, _ = materialise(often.withColumn("often", F.lit(True)), "often")
    rows = rows.join(broadcast_if_small(often, often.count(), 32), "order", "left")
    dealt = F.xxhash64("order", F.when(F.col("often"), F.col("number")))
    placed = rows.withColumn("bucket", bucket.cast("int")).join(F.broadcast(plan), "bucket")
    placed = placed.withColumn("part", F.pmod(dealt, F.col("parts")).cast("int"))
    counts = placed.groupBy("bucket", "part").count()
    earlier = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("bucket", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("begin"))
    parts = sum(histogram.values()) // NUMBERED + beyond // NUMBERED + len(cuts) + 1
    placed = placed.join(broadcast_if_small(begins, parts, 32), ["bucket", "part"])
    inside = F.row_number().over(Window.partitionBy("bucket", "part").orderBy("order", "number"))
    placed = placed.withColumn("place", F.col("begin") + inside - 1)
    return placed.select(
        *[F.col("row")[c].alias(c) for c in own],
        F.col("n").alias("n_tokens"),
        "bucket",
        F.when(F.col("bucket") == len(cuts), F.col("n")).otherwise(F.col("cut")).alias("boundary"),
        (F.col("first_batch") + F.floor(F.col("place") / F.col("room"))).alias("batch"),
        F.pmod("place", "room").cast("int").alias("slot"),
    )
