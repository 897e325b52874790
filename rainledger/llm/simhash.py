"""SimHash near-duplicates, found through anchors of a covering code.

A 64-bit fingerprint is cut into three segments. Fingerprints that differ in at most 4 bits differ in
at most 1 bit (4 // 3) of some segment. In each segment the anchors are the words of a covering
code of radius 1: a Hamming code over 15 of the bits, with the other bits taken as they are.
Every fingerprint has a home, an anchor within the radius, and is replicated to every anchor
within the radius plus the segment's threshold. If two fingerprints are that close in a segment, then the
home of either is among the replicas of the other; so per anchor, homes are compared with
replicas. Comparison is of all 64 bits, so what links is exact, and no link can be missed.

Only distinct fingerprints travel. Links of an anchor are reduced to a spanning forest before they leave
the task; anchors with many fingerprints are dealt to several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.llm.common import bitmap, free_name, in_bitmap, stored, texts_of
from rainledger.llm.components import components, forest
from rainledger.llm.regions import BLOCK, region_links

BITS = 64
SEED = 42  # of XXH64
COARSE = 15  # bits of a segment that the Hamming code covers
ANCHOR_BLOCK = 4096  # homes, or replicas, of one anchor that meet in a task at once
PAIRS_AT_ONCE = 1 << 21
ROWS_AT_ONCE = 1 << 18


def shingle_hashes(text: bytes, width: int) -> list[int]:
    """XXH64 of the text's lower-cased word shingles joined by spaces, repeats included; of all words if they are fewer."""
    words = text.lower().split()
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(end + 1 for end in ends)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :], strict=False)]


def simhash(hashes: list[int]) -> int:
    """A bit is 1 if more than half of the hashes have it; 0 without hashes."""
    if not hashes:
        return 0
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text_col: str, width: int, name: str) -> DataFrame:
    """``docs`` without the text, with its fingerprint as a signed 64-bit integer."""
    others = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([simhash(shingle_hashes(t, width)) for t in texts_of(batch, text_col)], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(prints.view(np.int64))], [*others, name])

    return docs.mapInArrow(run, docs.select(*others).schema.add(name, T.LongType()))


def segments(threshold: int) -> tuple[list[tuple[int, int]], int]:
    """((lowest bit, bits) of each segment, bits that may differ in the closest of them)."""
    count = 3
    cuts = [round(i * BITS / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)], threshold // count


def syndromes(values: np.ndarray) -> np.ndarray:
    """Of the Hamming code over ``COARSE`` bits: the exclusive or of the numbers, from 1, of the bits set.

    0 for a word of the code, else the number of the one bit to flip to reach it.
    """
    out = np.zeros(len(values), np.uint64)
    for bit in range(COARSE):
        out ^= np.where(values >> np.uint64(bit) & np.uint64(1), np.uint64(bit + 1), np.uint64(0))
    return out


def nearest(segment: np.ndarray) -> np.ndarray:
    """The anchor within the covering radius: the coarse bits decoded, the others as they are."""
    wrong = syndromes(segment)
    flip = np.where(wrong > 0, np.uint64(1) << (np.maximum(wrong, np.uint64(1)) - np.uint64(1)), np.uint64(0))
    return segment ^ flip


def flips(bits: int, radius: int) -> list[int]:
    """All ways to change at most ``radius`` of ``bits`` bits."""
    return [sum(1 << i for i in chosen) for n in range(radius + 1) for chosen in combinations(range(bits), n)]


def anchors(prints: np.ndarray, low: int, bits: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``prints``, anchor) for every anchor within ``radius`` of the segment."""
    segment = prints >> np.uint64(low) & np.uint64((1 << bits) - 1)
    where, found = [], []
    base = syndromes(segment)
    for flip in flips(bits, radius):
        hit = np.flatnonzero(base == syndromes(np.array([flip], np.uint64))[0])  # then the changed word is in the code
        where.append(hit)
        found.append(segment[hit] ^ np.uint64(flip))
    return np.concatenate(where), np.concatenate(found)


def spread(prints: DataFrame, threshold: int) -> DataFrame:
    """``anchor, home`` and the columns of ``prints`` (``fp`` first): each row at its home (1) and as a replica (0), in every segment."""
    parts, near = segments(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            fps = columns[0].view(np.uint64)
            for number, (low, bits) in enumerate(parts):
                own = nearest(fps >> np.uint64(low) & np.uint64((1 << bits) - 1))
                where, found = anchors(fps, low, bits, 1 + near)
                keys = (np.concatenate([own, found]) | np.uint64(number << 32)).view(np.int64)
                rows = np.concatenate([np.arange(len(own)), where])
                home = (np.arange(len(keys)) < len(own)).astype(np.int8)
                for at in range(0, len(keys), ROWS_AT_ONCE):
                    cut = slice(at, at + ROWS_AT_ONCE)
                    out = [keys[cut], home[cut], *(c[rows[cut]] for c in columns)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["anchor", "home", *batch.schema.names])

    return prints.mapInArrow(run, "anchor bigint, home tinyint" + "".join(f", {c} bigint" for c in prints.columns))


def dealt(spread_out: DataFrame, block: int) -> DataFrame:
    """``spread_out`` with ``cell`` after the anchor: anchors with over ``block`` homes or replicas become cells of at most about that many of each.

    Each home meets each replica of its anchor in exactly one cell. Fingerprints are
    distinct, so their hash deals them evenly.
    """
    sizes = spread_out.groupBy("anchor").agg(F.sum("home").alias("homes"), F.count(F.lit(1)).alias("n"))
    parts = lambda n: F.ceil(n / block).cast("int")
    large = sizes.where((F.col("homes") > block) | (F.col("n") - F.col("homes") > block)).select(
        "anchor", F.greatest(F.lit(1), parts(F.col("homes"))).alias("across"), F.greatest(F.lit(1), parts(F.col("n") - F.col("homes"))).alias("down")
    )
    large = stored(large, "large-anchors")
    joined = spread_out.join(large, "anchor", "left")
    x = F.pmod(F.xxhash64("fp"), F.col("across")).cast("int")
    y = F.pmod(F.xxhash64("fp"), F.col("down")).cast("int")
    own_row = F.transform(F.sequence(F.lit(0), F.col("down") - 1), lambda i: x * F.col("down") + i)
    own_column = F.transform(F.sequence(F.lit(0), F.col("across") - 1), lambda i: i * F.col("down") + y)
    cells = F.when(F.col("across").isNull(), F.array(F.lit(0))).when(F.col("home") == 1, own_row).otherwise(own_column)
    return joined.select("anchor", F.explode(cells).alias("cell"), *spread_out.columns[1:])


def close_pairs(group: np.ndarray, home: np.ndarray, fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links, as a forest, between fingerprints within ``threshold`` bits that are a home and a replica of the same, sorted ``group``."""
    prints = fp.view(np.uint64)
    r, h = np.flatnonzero(home == 0), np.flatnonzero(home == 1)
    first = np.searchsorted(group[r], group[h], "left")
    many = np.searchsorted(group[r], group[h], "right") - first
    ends = np.cumsum(many)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    start = 0
    while start < len(h):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, "right")))
        count = many[start:stop]
        one = np.repeat(h[start:stop], count)
        offset = np.arange(len(one)) - np.repeat(np.cumsum(count) - count, count)
        two = r[np.repeat(first[start:stop], count) + offset]
        close = np.bitwise_count(prints[one] ^ prints[two]) <= threshold
        a, b = fp[one[close]], fp[two[close]]
        if (up := a < b).any():
            found.append(forest(a[up], b[up]))
        start = stop
    if len(found) == 1:
        return found[0]
    both = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [fp[:0], fp[:0]]
    return forest(*both) if found else tuple(both)


def links(prints: DataFrame, threshold: int, block: int = ANCHOR_BLOCK) -> DataFrame:
    """``a, b``: a spanning forest, per task, of all pairs of distinct fingerprints ``fp`` within ``threshold`` bits."""
    prints = prints.select("fp")
    cells = dealt(spread(prints, threshold), block).repartition("anchor", "cell").sortWithinPartitions("anchor", "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows += batch.num_rows
            if rows < ROWS_AT_ONCE:
                continue
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            new = np.flatnonzero((np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0))
            cut = int(new[-1]) + 1 if len(new) else 0  # the last cell may go on
            if cut:
                yield from found([c[:cut] for c in columns])
            held = [[c[cut:] for c in columns]]
            rows -= cut
        if rows:
            yield from found([np.concatenate(c) for c in zip(*held, strict=True)])

    def found(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        anchor, cell, home, fp = columns
        steps = (np.diff(anchor, prepend=anchor[:1]) != 0) | (np.diff(cell, prepend=cell[:1]) != 0)
        a, b = close_pairs(np.cumsum(steps), home, fp, threshold)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return cells.mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, threshold: int = 4, block: int = ANCHOR_BLOCK
) -> DataFrame:
    """``docs`` without the text, with ``fingerprint`` (16 hex digits) and ``component_id``.

    Words are runs of anything but ASCII white space, A-Z in lower case; a text without words, or a null one, has
    fingerprint 0, which links like any other. ``component_id`` is the smallest non-null id
    reachable over fingerprints within ``threshold`` bits; it is null if there is none. Repeated rows
    are copies; an empty table gives no rows; columns of the two names are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("fingerprint", "component_id") and c not in (text_col, id_col)])
    fp = free_name(docs, "fp")
    table = stored(with_fingerprint(docs.withColumn(text_col, F.col(text_col).cast("string")), text_col, width, fp), "fingerprints")
    classes = stored(table.groupBy(F.col(fp).alias("fp")).agg(F.min(id_col).alias("least")), "classes")
    roots = components(links(classes, threshold, block=block)).withColumnRenamed("node", "fp")
    rooted = stored(classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots")
    smallest = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    labelled = rooted.join(smallest, "root").select(F.col("fp").alias(fp), "component_id")
    digits = F.lower(F.lpad(F.hex(fp), 16, "0"))
    return table.join(labelled, fp).select(*[c for c in docs.columns if c != text_col], digits.alias("fingerprint"), "component_id")


BANDS, MINIMA = 16, 4  # at a Jaccard similarity of 0.8 a pair shares no band with probability (1 - 0.8 ** 4) ** 16 = 0.0002
MINIMA_AT_ONCE = 4096  # shingles of a text
_random = np.random.default_rng(SEED)
_MASKS, _ODDS = _random.integers(0, 1 << 64, (2, BANDS * MINIMA), np.uint64) | np.array([[0], [1]], np.uint64)
WANTED_BITS = 1 << 24  # of the bitmap of rows whose shingles are compared


def band_keys(hashes: list[int]) -> list[int]:
    """A key for each band: a hash of the smallest shingles under ``MINIMA`` orders of its own."""
    values = np.array(hashes or [0], np.uint64)[:, None]
    parts = [((values[i : i + MINIMA_AT_ONCE] ^ _MASKS) * _ODDS).min(axis=0) for i in range(0, len(values), MINIMA_AT_ONCE)]
    bands = np.minimum.reduce(parts).astype("<u8").reshape(BANDS, MINIMA)
    return [xxhash.xxh64_intdigest(band.tobytes(), seed) for seed, band in enumerate(bands)]


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """``row, id`` with ``low, high``, a 128-bit digest of the words, the number of shingles, the fingerprint and the band keys of ``row, id, text``."""
    names = ["low", "high", "n", "fp", *(f"key{k}" for k in range(BANDS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in texts_of(batch, "text"):
                whole = xxhash.xxh3_128_intdigest(b" ".join(text.lower().split()))
                hashes = shingle_hashes(text, width)
                found.append([whole & (1 << 64) - 1, whole >> 64, len(hashes), simhash(hashes), *band_keys(hashes)])
            columns = np.array(found, np.uint64).reshape(-1, len(names)).view(np.int64)
            arrays = [pa.array(columns[:, k].copy()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["row", "id", *names])

    return docs.mapInArrow(run, "row bigint, id bigint" + "".join(f", {n} bigint" for n in names))


def shingle_sets(docs: DataFrame, wanted, width: int) -> DataFrame:
    """``node, shingles`` (distinct hashes) of the rows of ``node, text, at`` whose ``at`` is in the bitmap ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = np.flatnonzero(in_bitmap(batch.column(2).to_numpy(zero_copy_only=False), wanted.value))
            for at in range(0, len(hits), 256):  # sets of long texts are large
                part = batch.take(pa.array(hits[at : at + 256]))
                sets = [np.unique(np.array(shingle_hashes(t, width), np.uint64)).view(np.int64) for t in texts_of(part, "text")]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return docs.mapInArrow(run, "node bigint, shingles array<bigint>")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, bits: int = 4, block: int = BLOCK
) -> DataFrame:
    """One document of each group of near copies, that of the smallest id; columns as they were.

    Texts are copies if their sets of shingles of ``width`` words have a Jaccard similarity of ``similarity``; groups are connected
    components. Candidates are texts whose SimHash fingerprints are connected within ``bits`` bits, found through the anchors, and,
    as fingerprints of texts at that similarity are often further apart, texts that share one of ``BANDS`` bands of
    ``MINIMA`` smallest shingles (MinHash). Candidates form regions around their first text, in which the sets
    themselves decide (``regions``); no pair leaves a task.

    Null texts are empty, and texts without words are copies of each other. Rows that share the smallest id, or a group without
    ids, keep the first row as stored. An empty table gives no rows. A very long text is one set of 8 bytes a word, which a task holds.
    """
    row = free_name(docs, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    text = F.col(text_col).cast("string").alias("text")
    sketches = sketched(rows.select(F.col(row).alias("row"), F.col(id_col).cast("bigint").alias("id"), text), width)
    keys = [f"key{k}" for k in range(BANDS)]
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    classes = sketches.groupBy("low", "high", "n", "fp", *keys).agg(F.min(rank).alias("first"))  # equal words: one node
    classes = stored(classes.select(F.col("first.row").alias("node"), "first", "n", "fp", F.array(*keys).alias("keys")), "classes")
    prints = stored(classes.select("fp").distinct(), "prints")
    close = components(links(prints, bits)).select(F.col("node").alias("fp"), F.col("root").alias("near"))
    by_print = classes.join(close, "fp", "left").select("node", "n", F.coalesce("near", "fp").alias("key"))
    every = classes.select("node", "n", F.explode("keys").alias("key")).unionAll(by_print)
    shared = stored(every.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("many")).where("many > 1"), "shared-keys")
    members = stored(every.join(shared, "key").select("pivot", "node", "n").distinct(), "candidates")
    at = F.xxhash64("node").alias("at")
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(members.select(at), "at", WANTED_BITS))
    texts = rows.select(F.col(row).alias("node"), text).select("node", "text", at)
    sets = stored(shingle_sets(texts, wanted, width), "shingles")
    roots = region_links(members, sets, round(100 * similarity), block)
    kept = classes.select("node", "first").join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
    return rows.join(kept.select(F.col("first.row").alias(row)), row, "left_semi").select(docs.columns)
