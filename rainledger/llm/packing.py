"""Best-fit packing of documents into training sequences by the sum-of-squares rule.

Documents are tokenized once and cut into pieces; only lengths and places are then moved between
tasks. Pieces as long as a sequence stand alone. The others are dealt by hash to groups of
about ``group_rows`` and each group is packed by itself, so neither a task nor the driver
ever holds more than one group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.llm.common import chunks, stored
from rainledger.llm.tokens import encoder

TEXT_BATCH = 1 << 20  # characters that are encoded at a time
_PIECES = "row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint"
_NEVER = np.iinfo(np.int64).max


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences, but for the first, which takes the rest."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n_tokens, capacity)]


def _choose(open_bins: np.ndarray, size: int, capacity: int) -> int | None:
    """The gap to put ``size`` into, or None for a new bin: the sum of squares of open bins per gap gets smallest."""
    if size == capacity:
        return None
    here, after = open_bins[size:capacity], open_bins[: capacity - size]
    cost = 2 * (after - here) + 2  # one bin fewer at the gap, one more at what is left of it
    cost[0] = 1 - 2 * here[0]  # a bin that gets full is no longer open
    cost[here == 0] = _NEVER
    best = int(cost.argmin())
    fresh = 2 * int(open_bins[capacity - size]) + 1
    return None if cost[best] > fresh else size + best


def _best_fit(open_bins: np.ndarray, size: int, capacity: int) -> int | None:
    fits = open_bins[size:capacity] > 0
    best = int(fits.argmax()) if len(fits) else 0
    return size + best if len(fits) and fits[best] else None


def _place(lengths: list[int], order: list[int], capacity: int, rule) -> list[list[int]]:
    open_bins = np.zeros(capacity + 1, np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    for i in order:
        size = lengths[i]
        gap = rule(open_bins, size, capacity)
        if gap is None:
            gap, where = capacity, len(bins)
            bins.append([])
        else:
            where = by_gap[gap].pop()
            open_bins[gap] -= 1
        bins[where].append(i)
        if left := gap - size:
            by_gap[left].append(where)
            open_bins[left] += 1
    return bins


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions in ``lengths``, each at most ``capacity`` long in all.

    Longest first, each goes where the sum of squares becomes smallest (ties: the smallest
    gap, then an open bin). That rule keeps bins open for what is to come; when nothing
    comes any more, the contents of bins with a gap are placed anew, longest first, into the
    smallest gap that holds them, and the better result stays.
    """
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins = _place(lengths, order, capacity, _choose)
    filled = [sum(lengths[i] for i in b) == capacity for b in bins]
    rest = sorted((i for b, f in zip(bins, filled, strict=True) if not f for i in b), key=lambda i: -lengths[i])
    again = [b for b, f in zip(bins, filled, strict=True) if f] + _place(lengths, rest, capacity, _best_fit)
    return again if len(again) < len(bins) else bins


def pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """A numbered row per piece; those that fill a sequence already have their ``sequence_id`` (negative)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks([len(t) for t in texts], TEXT_BATCH):
                rows, payload = [], []
                for doc_id, ids in zip(doc_ids[a:b], encode(texts[a:b]), strict=True):
                    ids += end
                    for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        part = ids[4 * start : 4 * (start + length)]
                        row += 1
                        rows.append((row, doc_id, k, start, length, zlib.crc32(part), -row if length == capacity else None))
                        payload.append(part)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW, strict=True)]
                if with_ids:
                    ends = np.cumsum([0] + [len(p) // 4 for p in payload]).astype(np.int32)
                    values = pa.array(np.frombuffer(b"".join(payload), "<u4").astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), values))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [c.split()[0] for c in _PIECES.split(", ")] + ["ids"] * with_ids
    schema = _PIECES + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(run, schema)


_ARROW = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 2,
    with_ids: bool = False,
    group_rows: int = 50_000,
) -> DataFrame:
    """Pack documents into sequences of at most ``capacity`` tokens; a row per piece.

    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, if asked for, the
    piece's ``ids``. A null or empty text is a document of the end token alone; a null id stays
    null; repeated rows are documents of their own; other columns are not looked at; an
    empty table gives no rows.
    """
    table = stored(pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids), "pieces")
    open_pieces = table.where("sequence_id is null")
    groups = -(-open_pieces.count() // group_rows) or 1

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row")
        lengths = group["length"].tolist()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        first = int(group["part"].iloc[0]) << 32
        for k, members in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in members:
                sequence[i], offset[i], at = first + k, at, at + lengths[i]
        return pd.DataFrame({"row": group["row"].to_numpy(), "sequence_id": sequence, "offset": offset})

    part = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")
    placed = (
        open_pieces.select("row", "length", part.alias("part"))
        .groupBy("part")
        .applyInPandas(place, "row bigint, sequence_id bigint, offset bigint")
    )
    packed = open_pieces.drop("sequence_id").join(placed, "row")
    alone = table.where("sequence_id is not null").withColumn("offset", F.lit(0).cast("bigint"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    return alone.select(columns).unionAll(packed.select(columns))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids`` of pieces packed ``with_ids``; a group is one sequence long."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.flatten(F.transform(inside, lambda p: p["ids"])).alias("ids")
    )
