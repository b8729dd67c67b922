"""Benchmark decontamination: Wu-Manber search for runs of benchmark words in documents.

The alphabet is words, not bytes. Every window of WINDOW consecutive words of a benchmark item is a
pattern; an item with fewer words, but not none, is one pattern. Patterns of one length make one
table: the shift table tells for the hash of a block of BLOCK words how far the search may move
without passing an occurrence, the suffix table lists the patterns that end in a block whose shift
is 0, and the words themselves are compared last. Documents are cut into lanes that overlap by a
pattern's length less one, and all lanes of a chunk move together, each by its own shift.

The tables hold the benchmark, not the corpus. Items are dealt into table sets of at most
TABLE_BYTES of text; each set is one pass over the documents, and the hits of all passes meet per
document. So a benchmark of any size is searched whole, with bounded memory in the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactmill.llm import textkernel as K
from contactmill.session import bounded_batches

U64 = np.uint64
WINDOW = 10
BLOCK = 2
#: Words that a lane covers.
LANE = 512
#: Benchmark text that one set of tables holds.
TABLE_BYTES = 8 << 20
_FACTOR = U64(0xD1342543DE82EF95)


@dataclass(frozen=True)
class Table:
    """Wu-Manber tables for the distinct patterns of `length` words, as arrays.

    shift: of each slot of block hashes. Of each pattern, in order of the block it ends in and then of
    its hash: suffix, that block's hash; whole, the pattern's; first, its first word among those of
    the items; held[i]:held[i + 1], its part of holders, the numbers of the items that have it."""

    length: int
    block: int
    shift: np.ndarray
    suffix: np.ndarray
    whole: np.ndarray
    first: np.ndarray
    held: np.ndarray
    holders: np.ndarray

    def slot(self, blocks: np.ndarray) -> np.ndarray:
        return (blocks & U64(len(self.shift) - 1)).astype(np.int64)


@dataclass(frozen=True)
class Tables:
    """Items (ids as strings, and their words in lower case, as one buffer) and the tables for them."""

    items: list[str]
    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    tables: list[Table]

    def same(self, first: int, w: K.Words, lower: np.ndarray, at: int, size: int) -> bool:
        """Whether `size` words of the items from `first` on are those of w (in lower case) from `at` on."""
        a, b = self.start[first : first + size], w.start[at : at + size]
        lengths = self.end[first : first + size] - a
        if (lengths != w.end[at : at + size] - b).any():
            return False
        return all(
            self.buf[x : x + n].tobytes() == lower[y : y + n].tobytes()
            for x, y, n in zip(a.tolist(), b.tolist(), lengths.tolist())
        )


def _lower(text: np.ndarray) -> np.ndarray:
    return np.where((text >= ord("A")) & (text <= ord("Z")), text + np.uint8(32), text)


def _blocks(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the block of `size` words that ends at each word; the first size - 1 are unused."""
    out = hashes.copy()
    for j in range(1, size):
        out[j:] = out[j:] * _FACTOR + hashes[:-j]
    return K.mix(out)


def _whole(hashes: np.ndarray, first: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """The hash of the `size` words from each of the places on."""
    out = np.zeros(len(first), U64)
    for j in range(size):
        out += K.mix(hashes[first + j] * U64(2 * (j + salt) + 1))
    return out


def build_tables(items: list[tuple], window: int = WINDOW, block: int = BLOCK) -> Tables:
    """The tables for (item id, text) pairs, one for each pattern length that occurs."""
    w = K.words(*K.string_buffer(pa.array([t for _, t in items], pa.large_string())), K.ALNUM)
    counts = np.diff(w.offsets)
    tables = []
    for size in np.unique(np.minimum(counts[counts > 0], window)).tolist():
        mine = np.flatnonzero(counts >= window if size == window else counts == size)
        places = counts[mine] - size + 1
        item = np.repeat(mine, places)
        first = np.repeat(w.offsets[mine], places) + np.arange(places.sum()) - np.repeat(np.cumsum(places) - places, places)
        whole, other = _whole(w.hash, first, size), _whole(w.hash, first, size, window)
        b = min(block, size)
        blocks = _blocks(w.hash, b)
        # equal patterns are one, which all items that have it hold
        order = np.lexsort((item, other, whole, blocks[first + size - 1]))
        item, first, whole, other = item[order], first[order], whole[order], other[order]
        new = np.ones(len(item), bool)
        new[1:] = (whole[1:] != whole[:-1]) | (other[1:] != other[:-1])
        holds = new.copy()
        holds[1:] |= item[1:] != item[:-1]
        pattern = np.cumsum(new) - 1
        held = np.searchsorted(pattern[holds], np.arange(pattern[-1] + 2))
        first, whole = first[new], whole[new]
        slots = 1 << max(12, (8 * len(w.hash) - 1).bit_length())
        shift = np.full(slots, min(size - b + 1, 255), np.uint8)
        table = Table(size, b, shift, blocks[first + size - 1], whole, first, held, item[holds].astype(np.int32))
        for j in range(b - 1, size):
            np.minimum.at(shift, table.slot(blocks[first + j]), min(size - 1 - j, 255))
        tables.append(table)
    return Tables([i for i, _ in items], _lower(w.buf), w.start, w.end, tables)


def search(known: Tables, table: Table, w: K.Words) -> list[tuple[int, int]]:
    """(position of the first word, pattern) of every occurrence within the texts of w."""
    m, n = table.length, len(w.hash)
    if n < m:
        return []
    blocks = _blocks(w.hash, table.block)
    # a lane's cursor is the last word of the pattern's place; lanes end where the next one begins
    step = max(LANE, 4 * m)
    begin = np.arange(m - 1, n, step)
    stop = np.minimum(begin + step, n)
    cursor, hits = begin.copy(), []
    while len(cursor):
        shift = table.shift[table.slot(blocks[cursor])]
        zero = cursor[shift == 0]
        if len(zero):
            lo = np.searchsorted(table.suffix, blocks[zero])
            hits.append(zero[table.suffix[np.minimum(lo, len(table.suffix) - 1)] == blocks[zero]] - m + 1)
        cursor = cursor + np.maximum(shift, 1)
        on = cursor < stop
        cursor, stop = cursor[on], stop[on]
    first = np.sort(np.concatenate(hits)) if hits else np.zeros(0, np.int64)
    doc = np.searchsorted(w.offsets, first, side="right") - 1
    first = first[first + m <= w.offsets[doc + 1]]  # not across two texts
    if not len(first):
        return []
    lower = _lower(w.buf)
    ends, whole = blocks[first + m - 1], _whole(w.hash, first, m)
    lo, hi = np.searchsorted(table.suffix, ends), np.searchsorted(table.suffix, ends, side="right")
    out = []
    for at, a, b, h in zip(first.tolist(), lo.tolist(), hi.tolist(), whole):
        # the patterns of a bucket are in order of their hashes
        entry = a + int(np.searchsorted(table.whole[a:b], h))
        while entry < b and table.whole[entry] == h:
            if known.same(int(table.first[entry]), w, lower, at, m):
                out.append((at, entry))
            entry += 1
    return out


_HITS = "id {kind}, n_words long, spans array<struct<start:int,stop:int>>, items array<string>"


def _scan(table_set, only_hits: bool):
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches):
        known = table_set.value
        for batch in batches:
            ids = batch.column(0)
            buf, offsets = K.string_buffer(batch.column(1))
            for lo, hi in K.chunks(offsets):
                w = K.words(buf, offsets[lo : hi + 1], K.ALNUM)
                spans: dict[int, list] = {}
                items: dict[int, set] = {}
                for table in known.tables:
                    for at, pattern in search(known, table, w):
                        doc = int(np.searchsorted(w.offsets, at, side="right")) - 1
                        start = at - int(w.offsets[doc])
                        spans.setdefault(doc, []).append((start, start + table.length))
                        items.setdefault(doc, set()).update(table.holders[table.held[pattern] : table.held[pattern + 1]].tolist())
                rows = sorted(spans) if only_hits else range(hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([lo + i for i in rows], pa.int64())),
                        pa.array(np.diff(w.offsets)[list(rows)] if only_hits else np.diff(w.offsets), pa.int64()),
                        pa.array([_union(spans.get(i, [])) for i in rows], spans_type),
                        pa.array([sorted({known.items[k] for k in items.get(i, ())}) for i in rows], pa.list_(pa.string())),
                    ],
                    ["id", "n_words", "spans", "items"],
                )

    return run


def _union(spans: list[tuple[int, int]]) -> list[dict]:
    """Spans [start, stop) in order, with those that touch or overlap made one."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [{"start": a, "stop": b} for a, b in out]


def _table_sets(benchmark: DataFrame, table_bytes: int):
    """Lists of (item id as string, text), each of about table_bytes of text; one at a time."""
    sized = benchmark.select(
        F.col("item").cast("string").alias("item"), F.coalesce("text", F.lit("")).alias("text")
    ).where("item is not null and text <> ''")
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    sets = max(1, -(-total // table_bytes))
    for k in range(sets):
        part = sized.where(F.pmod(F.xxhash64("item", "text"), F.lit(sets)) == k) if sets > 1 else sized
        yield [(r["item"], r["text"]) for r in part.orderBy("item", "text").collect()]


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """(id, n_words, spans, items) for every row of docs: word spans inside benchmark passages.

    Words are runs of ASCII letters and digits and of any non-ASCII characters, with A-Z
    lower-cased. spans are the united word ranges [start, stop) of all occurrences, items the
    benchmark items with occurring windows, as sorted strings.

    Null or empty texts have no words and no spans; an item without words has no pattern, an item
    with a null id is left out. Repeated rows are judged each for itself when the benchmark is one
    table set. With several sets, rows that share id and text get the same result. Extra columns
    are ignored. An empty benchmark leaves every document without spans.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = _HITS.format(kind=kind)
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    passes = [spark.sparkContext.broadcast(build_tables(t, window)) for t in _table_sets(items, table_bytes)]
    if len(passes) == 1:
        found = source.mapInArrow(_scan(passes[0], False), schema)
    else:
        # each pass gives rows for hits alone; they meet per text, and every document looks itself up
        keyed = source.select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"), "text")
        hits = None
        for table_set in passes:
            one = keyed.mapInArrow(_scan(table_set, True), _HITS.format(kind="string"))
            hits = one if hits is None else hits.union(one)
        hits = hits.dropDuplicates(["id", "n_words", "spans", "items"]).groupBy("id").agg(
            F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        merged = F.aggregate(
            "spans",
            F.expr("cast(array() as array<struct<start:int,stop:int>>)"),
            lambda done, s: F.when(
                (F.size(done) > 0) & (s["start"] <= F.element_at(done, -1)["stop"]),
                F.concat(
                    F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                    F.array(
                        F.struct(
                            F.element_at(done, -1)["start"].alias("start"),
                            F.greatest(F.element_at(done, -1)["stop"], s["stop"]).alias("stop"),
                        )
                    ),
                ),
            ).otherwise(F.concat(done, F.array(s))),
        )
        hits = hits.select(F.col("id").alias("key"), merged.alias("spans"), "items")
        rows = source.select("id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"))
        words = _word_counts(source)
        found = (
            rows.join(hits, "key", "left")
            .join(words, "key", "left")
            .select(
                "id",
                "n_words",
                F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,stop:int>>)")).alias("spans"),
                F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
            )
        )
    return found.withColumnRenamed("id", id_col)


def _word_counts(source: DataFrame) -> DataFrame:
    """(key, n_words) of each distinct text."""

    def run(batches):
        for batch in batches:
            buf, offsets = K.string_buffer(batch.column(1))
            for lo, hi in K.chunks(offsets):
                counts = np.diff(K.words(buf, offsets[lo : hi + 1], K.ALNUM).offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(counts)], ["key", "n"])

    keyed = source.select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"), "text")
    return keyed.mapInArrow(run, "key string, n long").groupBy("key").agg(F.first("n").alias("n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of docs."""
    found = find_passages(docs, benchmark, **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        found.columns[0],
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without any benchmark passage; all columns kept, order of rows undefined.

    A null id or text never matches a passage by itself: the text alone decides, row by row.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.select(F.col("item_id").alias("item"), F.col("text"))
    passes = [spark.sparkContext.broadcast(build_tables(t)) for t in _table_sets(items, TABLE_BYTES)]
    at = docs.columns.index(text_col)

    def keep(table_set):
        def run(batches):
            for batch in batches:
                buf, offsets = K.string_buffer(batch.column(at))
                clean = np.ones(len(offsets) - 1, bool)
                for lo, hi in K.chunks(offsets):
                    w = K.words(buf, offsets[lo : hi + 1], K.ALNUM)
                    for table in table_set.value.tables:
                        for place, _ in search(table_set.value, table, w):
                            clean[lo + int(np.searchsorted(w.offsets, place, side="right")) - 1] = False
                yield batch.filter(pa.array(clean))

        return run

    for table_set in passes:
        docs = docs.mapInArrow(keep(table_set), docs.schema)
    return docs
