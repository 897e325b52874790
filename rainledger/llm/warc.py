"""WARC archives of captured pages and a globally ordered index of what is in them.

Spark's text writer writes the archives: a record is a string, and the two line ends that close a
record are the writer's line separator. Each file is as long as its limit at most and sorted by URL key
and time, so the index read from it is a sorted run. Runs are merged as in an external sort: the keys are cut into
ranges, and each range merges its parts of all runs with a loser tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rainledger.llm.common import stored

RECORD_END = "\r\n\r\n"
FILE_BYTES = 16 << 20  # at most; a reader holds a whole file
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = (
    "run string, place bigint, offset bigint, length bigint, page_id bigint, url string, captured string, "
    "record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"
)
_NAMES = [c.split()[0] for c in INDEX.split(", ")]


def url_key(url: Column) -> Column:
    """Host parts from the last to the first, then the path and query in lower case, without scheme, ``www`` and fragment."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    rest = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)", 1))
    parts = F.reverse(F.split(F.regexp_replace(host, r"^www\d*\.", ""), r"\."))
    return F.when(host == "", F.lower(url)).otherwise(F.concat(F.array_join(parts, ","), F.lit(")"), rest))


def _record_id(page_id: Column, digest: Column) -> Column:
    name = F.md5(F.concat_ws("|", page_id.cast("string"), digest))
    parts = [F.substring(name, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; none for a null. Line ends inside a value are percent-encoded."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, time_col: Column, min_bytes: int) -> DataFrame:
    """A WARC record per page, as text, beside what it is sorted by.

    The smallest id of a payload is its response, the others revisit it. Only payloads that
    occur more than once are joined, on their digest, and Spark splits a digest with very many pages.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    narrow = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.date_format(F.coalesce(time_col, F.timestamp_seconds(F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
    )
    full = narrow.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload")})
    groups = full.where(F.col("size") >= min_bytes).groupBy("digest")
    first = groups.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = stored(first, "first-pages")
    marked = full.join(first, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit(RECORD_END)
    )
    block = F.when(revisit, head).otherwise(F.concat(head, "payload"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.coalesce("page_id", F.xxhash64("url")), F.col("digest"))),
        _line("WARC-Date", F.col("captured")),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _line("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("first"), F.col("digest")))),
        _line("X-Page-ID", F.col("page_id")),
        _line("X-Refers-To-Page-ID", F.when(revisit, F.col("first"))),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
    )
    return marked.select(F.coalesce(url_key(F.col("url")), F.lit("")).alias("url_key"), "captured", "page_id", record.alias("value"))


def write_archives(
    pages: DataFrame,
    path: str,
    time_col: Column,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 100,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write a record per page; payloads of at least ``min_bytes`` are stored once and revisited.

    Archives lie in folders by their number within the task that wrote them. None is longer than ``file_bytes``, unless a single
    record is, whatever sizes the pages of a host have; a very long page is a file of its own.

    A null payload is empty, a null URL or id leaves its header line out, and a null time is 1970. Pages with a
    null id revisit but are never revisited. Rows that repeat the smallest id of their payload are
    responses too. Other columns are not looked at. An empty table writes no record.
    """
    made = records(pages, id_col, url_col, payload_col, time_col, min_bytes)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema)
    numbered = made.mapInArrow(_into_files(file_bytes), f"{fields}, file bigint")
    ordered = numbered.sortWithinPartitions("file", "url_key", "captured", "page_id").select("value", "file")
    ordered.write.option("lineSep", RECORD_END).partitionBy("file").text(path)


def _into_files(file_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds to each record the number of the task's file it goes into: the next one when this one would pass the limit."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, filled = 0, 0
        for batch in batches:
            files = []
            for size in pc.binary_length(batch.column("value")).to_pylist():
                size += len(RECORD_END)
                if filled and filled + size > file_bytes:
                    file, filled = file + 1, 0
                filled += size
                files.append(file)
            yield batch.append_column("file", pa.array(files, pa.int64()))

    return number


def parse_archive(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of each record; blocks are as long as their headers say."""
    at = 0
    while at < len(data):
        split = data.index(b"\r\n\r\n", at)
        lines = data[at:split].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        end = split + 4 + int(headers["Content-Length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} is cut short")
        yield at, end + 4 - at, headers, data[split + 4 : end]
        at = end + 4


def _entry(run: str, place: int, record: tuple[int, int, dict[str, str], bytes]) -> tuple:
    offset, length, headers, block = record
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload at {offset} of {run} is not what was archived")
    page, refers = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
    numbers = [None if x is None else int(x) for x in (page, refers)]
    return run, place, offset, length, numbers[0], headers.get("WARC-Target-URI"), headers["WARC-Date"], kind, size, digest, numbers[1]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives below ``path``; each file is a run sorted by key, time and page.

    Payloads are checked against their digests. The size and digest of a revisit are those of
    the full payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                archive = data.as_buffer().to_pybytes()
                file = "/".join(name.rsplit("/", 2)[-2:])  # tasks number their files alike, and a task's names repeat
                rows = [_entry(file, i, r) for i, r in enumerate(parse_archive(archive))]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    entries = files.select("path", "content").mapInArrow(run, INDEX)
    return entries.withColumn("url_key", F.coalesce(url_key(F.col("url")), F.lit("")))


_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]


def loser_tree(runs: list[list]) -> Iterator[tuple[int, int]]:
    """(run, position) in ascending order of the runs' values; equal values in order of the runs.

    Inner nodes of the tournament keep the loser of their match, so each step replays one path to the root.
    """
    k = len(runs)
    at = [0] * k
    heads = [(not run, run[0] if run else None, i) for i, run in enumerate(runs)]
    tree = [-1] * k  # tree[0] is the winner

    def wins(a: int, b: int) -> bool:
        x, y = heads[a], heads[b]
        if x[0] or y[0]:
            return not x[0]
        return x[1:] < y[1:]

    for leaf in range(k):
        winner, node = leaf, (leaf + k) // 2
        while node and winner >= 0:
            if tree[node] < 0:  # the first to come waits for its match
                tree[node], winner = winner, -1
            elif wins(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2
        if winner >= 0:
            tree[0] = winner
    while k and not heads[tree[0]][0]:
        winner = tree[0]
        yield winner, at[winner]
        at[winner] += 1
        done = at[winner] == len(runs[winner])
        heads[winner] = (done, None if done else runs[winner][at[winner]], winner)
        node = (winner + k) // 2
        while node:
            if wins(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2
        tree[0] = winner


def merge_runs(index: DataFrame) -> DataFrame:
    """Merge sorted runs into capture histories in ascending order of URL key, time and page.

    Ranges of all three columns are cut by their values, so captures of one URL may span many
    tasks; the result's partitions follow each other in order. A null page comes first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        received = list(batches)
        if not received:
            return
        part = pa.Table.from_batches(received)
        keys = list(
            zip(
                part["url_key"].to_pylist(),
                part["captured"].to_pylist(),
                ((p is not None, p or 0) for p in part["page_id"].to_pylist()),
                strict=True,
            )
        )
        cuts, names = [0], part["run"].to_pylist()
        cuts += [i for i in range(1, len(names)) if names[i] != names[i - 1]] + [len(names)]
        runs = [keys[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        order = [cuts[r] + i for r, i in loser_tree(runs)]
        yield from part.take(pa.array(order)).combine_chunks().to_batches()

    ranges = index.repartitionByRange("url_key", "captured", "page_id").sortWithinPartitions("run", "place")
    return ranges.mapInArrow(run, index.schema)
