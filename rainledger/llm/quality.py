"""Quality rules: counts of one document, and lines that too many documents of a host share.

A first pass over the texts leaves counts and line hashes. Lines are then counted per host, a line
above the host's limit is removed, and documents with too little left are rejected.

Copies are not boilerplate. A line of the menu stands in documents with lines of their own; all lines of a
text that was copied a thousand times, or such lines with an edit, stand in a thousand documents. So documents are told
apart by their own lines: those of which no sketch value (smallest shingles under several orders) is
frequent on the host. A document without own lines is told by its smallest frequent value, which
near copies share: however many they are, they count once or a few times. The documents
of a host are counted in the same way.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.llm.common import free_name, stored, texts_of

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50  # of a document
MAX_REPEATED = 50  # per cent of words in repeated windows
HOST_SHARE = 0.05  # a line may stand in this share of a host's documents,
HOST_DOCS = 10  # and in so many in any case
LEFT_WORDS = 20  # what must be left of a document from which lines are removed
LEFT_SHARE = 0.3

_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_LINES = pa.list_(pa.struct([("hash", pa.int64()), ("least", pa.list_(pa.int64())), ("words", pa.int32())]))


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that stand in a window of so many words which occurs at least twice."""
    grams = list(zip(*(words[i:] for i in range(window)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    counts = Counter(grams)
    twice = np.fromiter((counts[g] > 1 for g in grams), bool, len(grams))
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[i : i + len(grams)] |= twice
    return int(covered.sum())


def normal_line(line: bytes) -> bytes:
    """A-Z in lower case, white space as single spaces; empty for a line without a word."""
    return b" ".join(line.lower().split())


def line_hash(normal: bytes) -> int:
    return xxhash.xxh64_intdigest(normal) - (1 << 63)


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, lines equal to an earlier one, words in repeated windows."""
    words = text.split()
    joined = b"".join(words)
    chars = len(joined) - sum(map(joined.count, _CONTINUATION)) if not joined.isascii() else len(joined)
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return len(words), chars, sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


_SYMBOLS = [bytes([s]) for s in SYMBOLS]
_CONTINUATION = [bytes([b]) for b in range(0x80, 0xC0)]


def _shingles(lines: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all lines and of the three-word shingles that begin with them, place of each line, and its words."""
    sizes = np.array([len(words) for words in lines])
    starts = np.cumsum(sizes) - sizes
    words = np.fromiter((xxhash.xxh64_intdigest(w) for line in lines for w in line), np.uint64, int(sizes.sum()))
    grams = np.full(len(words), _LARGEST)
    if len(words) > 2:
        mixed = words[:-2] * _ODD[0] + words[1:-1] * _ODD[1] + words[2:]
        grams[:-2] = (mixed ^ mixed >> np.uint64(29)) * _ODD[2]
    for back in (1, 2):  # those that run into the next line
        grams[(starts + sizes - back)[sizes >= back]] = _LARGEST
    return words, grams, starts, sizes


def least_shingles(lines: list[list[bytes]]) -> list[int]:
    """The smallest hash among the three-word shingles of each line, or among its words if they are fewer."""
    words, grams, starts, sizes = _shingles(lines)
    least = np.where(sizes > 2, np.minimum.reduceat(grams, starts), np.minimum.reduceat(words, starts))
    return (least ^ np.uint64(1 << 63)).view(np.int64).tolist()


def sketches(lines: list[list[bytes]]) -> list[list[int]]:
    """Of each line the smallest of its shingles, or of its words if they are fewer than three, under each of ``ORDERS`` orders.

    Of a line of 18 shingles, an edit of one word changes all four once in 140 times.
    """
    words, grams, starts, sizes = _shingles(lines)
    whole = grams != _LARGEST
    own = np.where(whole | np.repeat(sizes > 2, sizes), grams, words)
    counts = whole | np.repeat(sizes < 3, sizes)
    out = np.empty((len(lines), ORDERS), np.uint64)
    for k in range(ORDERS):
        mixed = (own ^ _MASKS[k]) * _ODDS[k]
        out[:, k] = np.minimum.reduceat(np.where(counts, mixed ^ mixed >> np.uint64(32), _LARGEST), starts)
    return out.view(np.int64).tolist()


_LARGEST = np.uint64((1 << 64) - 1)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
ORDERS = 4
_MASKS, _ODDS = np.random.default_rng(4).integers(0, 1 << 64, (2, ORDERS), np.uint64) | np.array([[0], [1]], np.uint64)


def distinct_lines(text: bytes) -> list[dict]:
    """Each normalised line once: hash, sketch, words in all its occurrences."""
    words: Counter[int] = Counter()
    lines: dict[int, list[bytes]] = {}
    for line in text.split(b"\n"):
        if parts := line.lower().split():
            key = line_hash(b" ".join(parts))
            lines[key] = parts
            words[key] += len(parts)
    if not lines:
        return []
    least = dict(zip(lines, sketches(list(lines.values())), strict=True))
    return [{"hash": h, "least": least[h], "words": n} for h, n in words.items()]


def profile(docs: DataFrame, row: str, host_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """Row, host (null: empty), the measures, the distinct lines and the columns to carry (``carry0``, ...) of each document."""
    carried = [f"carry{i}" for i in range(len(carry))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, "text")
            counts = [measures(t) for t in texts]
            columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)] or [pa.array([], pa.int64())] * 5
            lines = pa.array([distinct_lines(t) for t in texts], _LINES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns, lines, *batch.columns[3:]], ["row", "host", *_MEASURES, "lines", *carried]
            )

    narrow = docs.select(
        F.col(row).alias("row"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        F.col(text_col).cast("string").alias("text"),
        *(F.col(c).alias(new) for c, new in zip(carry, carried, strict=True)),
    )
    counts = "".join(f", {m} bigint" for m in _MEASURES)
    schema = T.StructType.fromDDL(f"row bigint, host string{counts}, lines array<struct<hash:bigint,least:array<bigint>,words:int>>")
    for field in narrow.select(*carried).schema if carried else ():
        schema = schema.add(field)
    return narrow.mapInArrow(run, schema)


def told_apart(profiles: DataFrame, share: float, docs: int) -> DataFrame:
    """``host, told, hashes``: by what each document is told apart from others of its host, null without a line, and its lines.

    Frequent are sketch values of more than ``docs`` documents, copies included, and more than ``share`` of
    the host's distinct ones, taken here from the smallest value of the whole text: few if much is shared,
    so that more values count as frequent.
    """
    first = F.array_min(F.transform("lines", lambda x: x["least"][0]))
    hosts = profiles.select("host", first.alias("whole")).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"))
    values = F.array_distinct(F.flatten(F.transform("lines", lambda x: x["least"])))
    every = profiles.select("row", "host", F.explode(values).alias("value"))
    counts = every.groupBy("host", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > docs)
    frequent = counts.join(hosts, "host").where(F.col("n") > F.col("n_docs") * share).select("host", "value")
    frequent = stored(frequent, "frequent-values")
    shared = every.join(frequent, ["host", "value"]).groupBy("row").agg(F.collect_set("value").alias("shared"))  # a document's at most
    own = F.filter("lines", lambda x: F.col("shared").isNull() | ~F.arrays_overlap(x["least"], "shared"))
    told = F.coalesce(F.array_min(F.transform(own, lambda x: x["least"][0])), F.array_min("shared"))
    lines = profiles.select("row", "host", "lines").join(shared, "row", "left")
    return lines.select("host", told.alias("told"), F.col("lines.hash").alias("hashes"))


def frequent_lines(profiles: DataFrame, share: float, docs: int) -> DataFrame:
    """``host, hash`` of lines that stand in more than ``docs`` documents and more than ``share`` of the host's, copies counted once on both sides."""
    told = stored(told_apart(profiles, share, docs), "told-apart")
    lines = told.select("host", "told", F.explode("hashes").alias("hash"))
    counts = lines.distinct().groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    hosts = told.select("host", "told").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"))
    limit = F.greatest(F.lit(float(docs)), F.col("n_docs") * share)
    return counts.where(F.col("n") > docs).join(hosts, "host").where(F.col("n") > limit).select("host", "hash")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def verdicts(
    docs: DataFrame,
    row: str,
    host_col: str = "source",
    text_col: str = "text",
    share: float = HOST_SHARE,
    least_docs: int = HOST_DOCS,
    left_words: int = LEFT_WORDS,
    left_share: float = LEFT_SHARE,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``row``, the columns to ``carry``, the measures, ``removed`` (hashes of lines above the limit), ``base_failed`` and ``kept``.

    ``row`` names a column that tells the rows apart. A null text has no words, a null host
    is a host of its own, repeated rows are copies, and an empty table gives no rows. A document from which lines
    are removed is depleted with fewer than ``left_words`` words or less than ``left_share`` of them left.
    """
    profiles = stored(profile(docs, row, host_col, text_col, list(carry)), "line-profiles")
    frequent = stored(frequent_lines(profiles, share, least_docs), "frequent-lines")  # a join with it can be split
    lines = profiles.select("row", "host", F.explode("lines").alias("line")).select("row", "host", "line.hash", "line.words")
    removed = (
        lines.join(frequent, ["host", "hash"])
        .groupBy("row")
        .agg(F.collect_set("hash").alias("removed"), F.sum("words").alias("removed_words"))
    )  # a document's lines at most
    joined = profiles.drop("lines", "host").join(removed, "row", "left")
    left = F.col("n_words") - F.col("removed_words")
    carried = [F.col(f"carry{i}").alias(c) for i, c in enumerate(carry)]
    depleted = F.col("removed_words").isNotNull() & ((left < left_words) | (left < left_share * F.col("n_words")))
    return joined.withColumn("base_failed", base_failed()).select(
        F.col("row").alias(row), *carried, *_MEASURES, "removed", "base_failed", (~F.col("base_failed") & ~depleted).alias("kept")
    )


def filtered(docs: DataFrame, host_col: str = "source", text_col: str = "text", **limits) -> DataFrame:
    """The documents that are kept, without the lines above the limit; columns as they were."""
    row = free_name(docs, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    verdict = verdicts(rows, row, host_col, text_col, **limits).where("kept")
    mark = free_name(rows, "removed")
    joined = rows.join(verdict.select(row, F.col("removed").alias(mark)), row)
    place, names = docs.columns.index(text_col), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                _without(t, set(r)) if r else t
                for t, r in zip(batch.column(place).to_pylist(), batch.column(len(names)).to_pylist(), strict=True)
            ]
            columns = list(batch.columns[: len(names)])
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.select(*names, mark).mapInArrow(run, docs.schema)


def _without(text: str, removed: set[int]) -> str:
    lines = text.split("\n")
    return "\n".join(x for x in lines if not (n := normal_line(x.encode())) or line_hash(n) not in removed)
