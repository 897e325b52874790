"""Substring dedup by hashed units: lines, cut further where sentences begin.

A passage that was pasted into the middle of a line starts with a capital after a lower-case word
and ends with a full stop, so its sentences are units of their own wherever it stands. Digests of
normalised units are grouped over the whole table and the first occurrence, by document and
place, stays. Short units repeat by chance ("See also."); so a repeat is removed where units that
follow each other, all seen before, have at least ``min_words`` words together. Offsets
are those in the original text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.llm.common import alnum_words, free_name, stored

MIN_WORDS = 25
_LISTS = ["digests", "starts", "ends", "words"]
#: Ends of lines, white space after the end of a sentence, and before a capital
#: unless the word before it is all capitals.
BOUNDARY = regex.compile(r"\n|(?<=[.!?…。])[^\S\n]+|(?<=[\p{Ll}\p{N},;:])[^\S\n]+(?=\p{Lu})")

def units(text: str) -> list[tuple[int, int, int, int]]:
    """(digest, start, end, words) of each unit with a word; units differ if their words do."""
    out, at = [], 0
    for cut in [*BOUNDARY.finditer(text), None]:
        end, after = (cut.start(), cut.end()) if cut else (len(text), len(text))
        words = alnum_words(text[at:end].encode())
        if words:
            out.append((xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63), at, end, len(words)))
        at = after
    return out


def runs(starts: list[int], ends: list[int], words: list[int], seen: dict[int, int | None], min_words: int) -> list[dict]:
    """Neighbouring units that were all seen before, as one span each, if they have words enough."""
    spans, i = [], 0
    while i < len(starts):
        j = i
        while j < len(starts) and j in seen:
            j += 1
        if (n := sum(words[i:j])) >= min_words:
            spans.append({"start": starts[i], "end": ends[j - 1], "n_units": j - i, "n_words": n, "first_doc_id": seen[i]})
        i = max(j, i + 1)
    return spans


_SPANS = pa.list_(
    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("n_units", pa.int32()), ("n_words", pa.int32()), ("first_doc_id", pa.int64())])
)
SPANS = T.ArrayType(
    T.StructType([T.StructField(f.name, T.LongType() if f.type == pa.int64() else T.IntegerType()) for f in _SPANS.value_type])
)


def without(text: str, spans: list[dict]) -> str:
    """The text without the spans; what stood around one is joined by its first white space, if there is any."""
    out, at = [], 0
    for span in spans:
        out.append(text[at : span["start"]])
        at = span["end"]
        if at < len(text) and text[at].isspace() and (span["start"] == 0 or text[span["start"] - 1].isspace()):
            at += 1
    return "".join([*out, text[at:]])


def repeated_spans(docs: DataFrame, row: str, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """``row, n_units, removed`` for documents with something to remove.

    ``row`` tells the rows apart. Documents rank by id (null last), then by row.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [units(t or "") for t in batch.column(2).to_pylist()]
            cuts = pa.array(accumulate(map(len, found), initial=0), pa.int32())
            flat = list(zip(*(u for one in found for u in one), strict=True)) or [()] * 4
            lists = [
                pa.ListArray.from_arrays(cuts, pa.array(c, t))
                for c, t in zip(flat, (pa.int64(), pa.int32(), pa.int32(), pa.int32()), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["row", "doc_id", *_LISTS])

    narrow = docs.select(F.col(row).alias("row"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "row bigint, doc_id bigint, digests array<bigint>, starts array<int>, ends array<int>, words array<int>"
    table = stored(narrow.mapInArrow(split, schema), "units")

    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row"), F.col("place"))
    every = table.select("row", "doc_id", F.posexplode("digests").alias("place", "digest"))
    first = every.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = stored(first, "first-units")  # a table, so that Spark can split the join of a digest that is everywhere
    repeats = every.join(first.select("digest", "first"), "digest").where(
        (F.col("row") != F.col("first.row")) | (F.col("place") != F.col("first.place"))
    )
    seen = repeats.groupBy("row").agg(F.collect_list(F.struct("place", F.col("first.doc_id").alias("first_doc_id"))).alias("seen"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4)), strict=True)
            found = [runs(a, b, w, {s["place"]: s["first_doc_id"] for s in seen}, min_words) for a, b, w, seen in rows]
            sizes = pa.array([len(a) for a in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(found, _SPANS)], ["row", "n_units", "removed"])

    out = T.StructType.fromDDL("row bigint, n_units bigint").add("removed", SPANS)
    spans = table.select("row", "starts", "ends", "words").join(seen, "row").mapInArrow(join, out)
    return spans.where(F.size("removed") > 0).withColumnRenamed("row", row)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, span_col: str = "removed") -> DataFrame:
    """``docs`` with the texts that are left and the removed spans, in the original text's characters, in ``span_col``.

    A span tells its words and the document that keeps them. Null and empty texts stay as they are, ties in
    id are broken by row, repeated rows lose what the first of them keeps, an empty table gives no
    rows. A column called ``span_col`` is replaced.
    """
    docs = docs.drop(span_col)
    row = free_name(docs, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    spans = repeated_spans(rows, row, id_col, text_col, min_words)
    mark = free_name(rows, span_col)
    joined = rows.join(spans.select(row, F.col("removed").alias(mark)), row, "left")
    place, names = docs.columns.index(text_col), docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            spans = columns[-1].to_pylist()
            texts = columns[place].to_pylist()
            columns[place] = pa.array([without(t, s) if s else t for t, s in zip(texts, spans, strict=True)], pa.string())
            columns[-1] = pa.array([s or [] for s in spans], _SPANS)
            yield pa.RecordBatch.from_arrays(columns, [*names, span_col])

    schema = T.StructType([*docs.schema.fields, T.StructField(span_col, SPANS)])
    return joined.select(*names, mark).mapInArrow(cut, schema)
