"""Exact Jaccard join of texts' shingle sets in metric space.

The distance 1 - |x & y| / |x | y| obeys the triangle inequality, so what two sets are to a pivot bounds what they are
to each other. Equal sets are one class. Two classes that link share shingles among the first of both under any common
order of shingles: one among as many as may be missing and one more, and with ``SPARE`` percent more places as many again. Classes that
share fewer of those with any other are alone. For the rest the order puts shingles that many first places hold last, so passages that are
everywhere bring nobody together. The first class that has a shingle is the pivot of all that share it: a region is the pivot with
them, and each pair that links is in one.

How regions are joined, recursively and exactly, is told in ``regions``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.llm.common import bitmap, collected, discard, free_name, in_bitmap, stored, texts_of
from rainledger.llm.regions import BLOCK, region_links
from rainledger.llm.simhash import shingle_hashes

HEAVY = 16  # classes that have a shingle among their first: with more, it is ordered last
SPARE = 10  # percent of a set that two sets that link share among their first shingles, or of the smaller one
BITS = 1 << 24  # of the bitmaps of documents and late shingles
SHARED_BITS = 1 << 26  # of the bitmap of shared first shingles
SEEN = 1 << 20  # digests that a task remembers
DOCS_AT_ONCE = 256


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """The distinct shingles' hashes, ascending."""
    return np.unique(np.array(shingle_hashes(text, width), np.uint64))


def prefix_length(n: int, percent: int, spare: int = 0) -> int:
    """So many first shingles that two sets that link share one of them, or ``spare`` percent more of each for ``least_shared``."""
    return n - (percent * n + 99) // 100 + 1 + spare * n // 100 if n else 0


def least_shared(n: np.ndarray, percent: int, spare: int) -> np.ndarray:
    """How many of its first shingles a set of ``n`` shares with any set it links with, which has ``percent`` of ``n`` at least."""
    return spare * ((percent * n + 99) // 100) // 100 + 1


def first_keys(shingles: np.ndarray, length: int, late: np.ndarray | None = None) -> np.ndarray:
    """Keys (48 bits) of the first shingles: the smallest hashes, those in the bitmap ``late`` after all others."""
    keys = (shingles >> np.uint64(16)).view(np.int64)
    if late is not None:
        last = in_bitmap(keys, late)
        keys = np.concatenate([keys[~last], keys[last]])
    return keys[:length]


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def prints(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``id, low, high`` (a digest of the set), ``n, keys`` of ``id, text``; of copies in a task only one has keys, the first shingles by hash."""
    names = ["id", "low", "high", "n", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                digests, sizes, keys = [], [], []
                for text in texts_of(part, "text"):
                    found = shingle_set(text, width)
                    digests.append(xxhash.xxh3_128_intdigest(found.tobytes()))
                    sizes.append(len(found))
                    length = 0 if digests[-1] in seen else prefix_length(len(found), percent, SPARE)
                    keys.append(first_keys(found, length))
                    if len(seen) < SEEN:
                        seen.add(digests[-1])
                yield pa.RecordBatch.from_arrays([part.column(0), *_halves(digests), pa.array(sizes, pa.int64()), _lists(keys)], names)

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, low bigint, high bigint, n bigint, keys array<bigint>")


def _halves(digests: list[int]) -> list[pa.Array]:
    parts = [d & (1 << 64) - 1 for d in digests], [d >> 64 for d in digests]
    return [pa.array(np.array(x, np.uint64).view(np.int64)) for x in parts]


def shared_places(table: DataFrame, shared, percent: int) -> DataFrame:
    """``low, n, key`` of the first shingles that the bitmap ``shared`` may hold, of the sets that have enough of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            lists = batch.column(2)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            keys = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(low)), sizes)
            hit = in_bitmap(keys, shared.value)
            enough = np.bincount(row[hit], minlength=len(low)) >= least_shared(n, percent, SPARE)
            kept = np.flatnonzero(hit & enough[row])
            for at in range(0, len(kept), 1 << 16):
                cut = kept[at : at + (1 << 16)]
                columns = [low[row[cut]], n[row[cut]], keys[cut]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["low", "n", "key"])

    return table.select("low", "n", "keys").where(F.size("keys") > 0).mapInArrow(run, "low bigint, n bigint, key bigint")


def sets_of(docs: DataFrame, wanted, late, width: int, percent: int) -> DataFrame:
    """``id, low, high, shingles, keys`` of the documents of ``id, text, at`` whose ``at`` is in the bitmap ``wanted``."""
    names = ["id", "low", "high", "shingles", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = np.flatnonzero(in_bitmap(batch.column(2).to_numpy(zero_copy_only=False), wanted.value))
            for at in range(0, len(hits), DOCS_AT_ONCE):
                part = batch.take(pa.array(hits[at : at + DOCS_AT_ONCE]))
                sets = [shingle_set(t, width) for t in texts_of(part, "text")]
                halves = _halves([xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets])
                keys = [first_keys(s, prefix_length(len(s), percent), late.value) for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), *halves, _lists(sets), _lists(keys)], names)

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, low bigint, high bigint, shingles array<bigint>, keys array<bigint>")


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    block: int = BLOCK,
    heavy: int = HEAVY,
) -> DataFrame:
    """``id_col, n_shingles, component_id`` of every row of ``docs``.

    A text's set is that of its distinct shingles of ``width`` words (runs of anything but ASCII white space, A-Z in lower case); with fewer
    words, the whole sequence. Texts link when 100 * |x & y| >= ``percent`` * |x | y|; ``component_id`` is the smallest non-null id
    reachable by links, the own included, and null if there is none. A null text, or one without words, has the empty set and links with
    nothing. Repeated rows are copies; an empty table gives no rows; other columns are left out. Shingles are
    told apart by 64-bit hashes. A very long text is one set of 8 bytes a word, which a task holds.
    """
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    made: list[str] = []
    with collected(made):
        table = stored(prints(rows, width, percent), "prints")
    each = stored(table.select("id", "low", "high", "n"), "rows")
    places = table.select("low", F.explode("keys").alias("key"))
    lows = F.min("low").alias("low"), F.max("low").alias("other"), F.count(F.lit(1)).alias("many")
    shared = stored(places.groupBy("key").agg(*lows).where("low <> other").select("key", "many"), "shared")
    late = share(bitmap(shared.where(F.col("many") > heavy), "key", BITS))
    meet = shared_places(table, share(bitmap(shared, "key", SHARED_BITS)), percent).distinct().join(shared.select("key"), "key", "left_semi")
    least = F.floor(F.lit(SPARE) * F.floor((percent * F.col("n") + 99) / 100) / 100) + 1  # as ``least_shared``
    meet = stored(meet.groupBy("low", "n").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") >= least).select("low"), "meet")
    discard(spark, made)
    grouped = each.where("n > 0").groupBy("low", "high").agg(F.min("id").alias("least"), F.first("n").alias("n"))
    classes = stored(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")
    some = stored(classes.join(meet, "low", "left_semi"), "some")
    at = F.xxhash64("id")
    wanted = share(bitmap(some.select(F.xxhash64(F.col("least")).alias("at")), "at", BITS))
    found = sets_of(rows.select("id", "text", at.alias("at")), wanted, late, width, percent)
    same = (found.low == some.low) & (found.high == some.high) & found.id.eqNullSafe(some.least)
    sets = stored(found.join(some, same).select("node", "n", "shingles", "keys"), "sets")  # repeated rows are repeated; cells hold each node once
    postings = sets.select("node", "n", F.explode("keys").alias("key"))
    firsts = stored(postings.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("many")).where("many > 1"), "firsts")
    members = postings.join(firsts, "key").select("pivot", "node", "n").distinct()
    roots = region_links(members, sets.select("node", "shingles"), percent, block)
    labelled = classes.select("node", "low", "high", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    labelled = stored(labelled, "labelled")
    smallest = stored(labelled.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    labels = labelled.join(smallest, "root").select("low", "high", "component_id")
    empty = each.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    linked = each.where("n > 0").join(labels, ["low", "high"]).select("id", "n", "component_id")
    name = id_col if id_col not in ("n_shingles", "component_id") else free_name(linked, id_col)
    return linked.unionAll(empty).select(F.col("id").alias(name), F.col("n").alias("n_shingles"), "component_id")
