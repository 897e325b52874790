"""Benchmark decontamination by Wu-Manber search over words.

The letters of the search are whole words. For patterns of one length, a table gives for each block
of two words how far the search may jump, which for most blocks is the whole pattern less one
word; blocks that end a pattern lead to the patterns with that suffix, which are then compared
directly. Benchmarks are searched in blocks of bounded size, each sent to the tasks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.llm.common import alnum_words, free_name, stored, texts_of

BLOCK_BYTES = 2 << 20  # benchmark text that is searched for at once
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
ITEMS = pa.list_(pa.int64())


class WuManber:
    """Patterns of one length over words; ``find`` yields (position, item numbers) of each occurrence."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[int]], length: int):
        self.length = length
        self.block = min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.suffix: dict[tuple[bytes, ...], dict] = defaultdict(dict)
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                part = pattern[end - self.block : end]
                self.shift[part] = min(self.shift.get(part, self.far), length - end)
            self.suffix[pattern[length - self.block :]][pattern] = items

    def find(self, words: list[bytes]) -> Iterator[tuple[int, set[int]]]:
        end, block, length, far, shift = self.length, self.block, self.length, self.far, self.shift
        while end <= len(words):
            part = tuple(words[end - block : end])
            jump = shift.get(part, far)
            if jump:
                end += jump
                continue
            items = self.suffix[part].get(tuple(words[end - length : end]))
            if items:
                yield end - length, items
            end += 1


def searchers(items: list[tuple[int | None, str | None]], window: int) -> list[WuManber]:
    """One searcher per pattern length: all windows of an item's words, or all its words if they are fewer."""
    patterns: dict[int, dict] = defaultdict(lambda: defaultdict(set))
    for number, (_, text) in enumerate(items):
        words = alnum_words((text or "").encode())
        length = min(window, len(words))
        for i in range(len(words) - length + 1 if length else 0):
            patterns[length][tuple(words[i : i + length])].add(number)
    return [WuManber(found, length) for length, found in sorted(patterns.items())]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def find_occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    keep_text: bool = True,
    prefix: str = "",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (word ranges inside any occurrence, merged) and ``items``.

    ``items`` are the distinct ids of items with an occurring window, ascending. Null or empty texts have no
    words and no spans; an item without words is found nowhere; one whose id is null marks
    words but is not listed; equal windows of several items count for each. The three columns replace any
    of the same name; ``prefix`` before their names avoids that. Without benchmark items nothing is found.
    """
    bench = benchmark.select(F.col(item_col).cast("bigint").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    names = [prefix + n for n in ("n_words", "spans", "items")]
    clash = {n.lower() for n in names}
    found = docs.drop(*[c for c in docs.columns if c.lower() in clash and c != text_col])
    if text_col.lower() in clash:
        raise ValueError(f"the text column may not be called {text_col}; set prefix")
    found = found.withColumn(names[0], F.lit(None).cast("bigint"))
    found = found.withColumn(names[1], F.lit(None).cast("array<struct<start:int,end:int>>"))
    found = found.withColumn(names[2], F.lit(None).cast("array<bigint>"))
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block
        items = [tuple(r) for r in bench.where(mine).distinct().collect()]  # at most about block_bytes
        if block:
            found = stored(found, "decontaminate")
        found = _search(found, items, text_col, names, window)
    return found if keep_text else found.drop(text_col)


def _search(docs: DataFrame, items: list, text_col: str, names: list[str], window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = searchers(items, window)
        for batch in batches:
            counts, all_spans, all_items = [], [], []
            before = zip(batch.column(names[1]).to_pylist(), batch.column(names[2]).to_pylist(), strict=True)
            for text, (spans, ids) in zip(texts_of(batch, text_col), before, strict=True):
                words = alnum_words(text)
                hits = [(at, t.length, found) for t in tables for at, found in t.find(words)]
                counts.append(len(words))
                old = [(s["start"], s["end"]) for s in spans or ()]
                new = merged(old + [(at, at + length) for at, length, _ in hits])
                all_spans.append([{"start": a, "end": b} for a, b in new])
                known = {items[i][0] for _, _, found in hits for i in found} - {None}
                all_items.append(sorted(known.union(ids or ())))
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns |= {names[0]: pa.array(counts, pa.int64()), names[1]: pa.array(all_spans, SPANS), names[2]: pa.array(all_items, ITEMS)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, docs.schema)


def uncontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = 10) -> DataFrame:
    """The documents in which no window of an item occurs, with their own columns."""
    mark = free_name(docs, "hit_")
    while any(c.lower().startswith(mark.lower()) for c in docs.columns):
        mark = f"_{mark}"
    found = find_occurrences(docs, benchmark, text_col, window=window, prefix=mark)
    return found.where(F.size(f"{mark}spans") == 0).select(docs.columns)
