"""A bigram language model with deleted interpolation, counted over the whole corpus.

    p(w | v) = l2(b) c(v w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1),   b = bucket of c(v)

The weights of each bucket of context frequency are learned by expectation-maximisation on counts of
documents that were left out of the maximum-likelihood estimates; after that, the estimates use
all training documents.

Nothing holds the whole model. Documents are put together in units of bounded size; a unit states each
word and pair it has once, with its count, and is told the corpus totals of just those. Words and pairs
are dealt to buckets by 64-bit hashes, so a frequent one costs a bucket one entry per unit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainledger.llm.common import stored, texts_of

UNIT_BYTES = 5 << 20  # of words; a task holds a unit, about thirty times that
EM_ROUNDS = 40
EM_CLOSE = 1e-4
LEAST_UNIFORM = 1e-6  # so that an unseen word never has probability 0
COUNT, TUNE, HELD_OUT = 0, 1, 2
EDGE = b"\n"  # stands before the first word and is the end token; no word holds it
_MIX = np.uint64(0x9E3779B97F4A7C15)


def part_of(id_col: Column, folds: int = 7, held_out: int = 2, tune: int = 3) -> Column:
    """Held-out, tuning or counted, by the id's crc32; a null id is counted."""
    fold = F.crc32(id_col.cast("string").cast("binary")) % folds
    return F.when(fold == held_out, HELD_OUT).when(fold == tune, TUNE).otherwise(COUNT).cast("int")


def units(docs: DataFrame, unit_bytes: int) -> DataFrame:
    """``unit, part, n_tokens, doc_ids, words``: documents of one part, their words compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: dict[int, tuple[list, list]] = {p: ([], [EDGE]) for p in (COUNT, TUNE, HELD_OUT)}
        sizes = dict.fromkeys(held, 0)

        def flush(part: int) -> pa.RecordBatch:
            nonlocal number
            ids, words = held[part]
            data, n_tokens = zlib.compress(b" ".join(words), 1), len(words) - 1
            held[part], sizes[part], number = ([], [EDGE]), 0, number + 1
            values = ([number], [part], [n_tokens], [ids], [data])
            types = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            columns = [pa.array(v, t) for v, t in zip(values, types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["unit", "part", "n_tokens", "doc_ids", "words"])

        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch, "text"), strict=True)
            for doc_id, part, text in rows:
                ids, words = held[part]
                ids.append(doc_id)
                words += text.lower().split()
                words.append(EDGE)
                sizes[part] += len(text) + 1
                if sizes[part] >= unit_bytes:
                    yield flush(part)
        for part, (ids, _) in held.items():
            if ids:
                yield flush(part)

    return docs.select("doc_id", "part", "text").mapInArrow(
        run, "unit bigint, part int, n_tokens bigint, doc_ids array<bigint>, words binary"
    )


@dataclass
class Unit:
    """Words by number, and the sorted distinct words and pairs with their counts."""

    tokens: np.ndarray  # numbers in order of first occurrence; 0 is the edge
    word_of: np.ndarray  # token number -> position in word_hashes
    word_hashes: np.ndarray
    word_counts: np.ndarray
    pair_of: np.ndarray  # event -> position in pair_hashes; event i goes from token i to i + 1
    pair_hashes: np.ndarray
    pair_counts: np.ndarray


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def read_unit(data: bytes) -> Unit:
    words = zlib.decompress(data).split(b" ")
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    tokens = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
    del words
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
    word_hashes, word_of = np.unique(hashes, return_inverse=True)
    counts = np.bincount(word_of[tokens[1:]], minlength=len(word_hashes))  # the first edge is no token
    left, right = _scramble(hashes * np.uint64(3) + _MIX), _scramble(hashes)  # the order of a pair counts
    pairs = _scramble(left[tokens[:-1]] + right[tokens[1:]])
    pair_hashes, pair_of, pair_counts = np.unique(pairs, return_inverse=True, return_counts=True)
    return Unit(tokens, word_of, word_hashes, counts, pair_of, pair_hashes, pair_counts)


def _cuts(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket, the leading bits of a hash, begins."""
    starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(hashes, starts), len(hashes))


def statements(table: DataFrame, bits: int) -> DataFrame:
    """What each unit has: per kind (0 words, 1 pairs) and bucket, sorted hashes with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, part, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                unit = read_unit(data)
                for kind, hashes, counts in ((0, unit.word_hashes, unit.word_counts), (1, unit.pair_hashes, unit.pair_counts)):
                    cuts = _cuts(hashes, bits)
                    full = np.flatnonzero(np.diff(cuts))
                    offsets = pa.array(np.append(cuts[full], len(hashes)).astype(np.int32))
                    n = len(full)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(full * 2 + kind, pa.int64()),
                            pa.array(np.full(n, number)),
                            pa.array(np.full(n, part, np.int32)),
                            pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64))),
                            pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32))),
                        ],
                        ["bucket", "unit", "part", "hashes", "counts"],
                    )

    narrow = table.select("unit", "part", "words")
    return narrow.mapInArrow(run, "bucket bigint, unit bigint, part int, hashes array<bigint>, counts array<int>")


_ANSWER = "bucket bigint, unit bigint, part int, counted array<bigint>, tuned array<bigint>, n_known bigint, n_counted bigint"


def answers(stated: DataFrame) -> DataFrame:
    """For each statement the corpus totals of its entries, in its order: in counted and in tuning documents.

    A row with a null unit tells how many entries the bucket knows, from both parts and from the counted one.
    """

    def total(group: pa.Table) -> pa.Table:
        hashes, counts = group["hashes"].combine_chunks(), group["counts"].combine_chunks()
        lengths = np.diff(hashes.offsets.to_numpy())
        parts = np.repeat(group["part"].to_numpy(), lengths)
        values = counts.flatten().to_numpy()
        known, where = np.unique(hashes.flatten().to_numpy(), return_inverse=True)
        sums = [np.bincount(where, np.where(parts == p, values, 0), len(known)).astype(np.int64) for p in (COUNT, TUNE)]
        cuts = np.append(0, np.cumsum(lengths))
        offsets = pa.array(np.append(cuts, cuts[-1]).astype(np.int32))
        rows = len(lengths)
        told = [pa.ListArray.from_arrays(offsets, pa.array(s[where])) for s in sums]
        none = [None] * rows
        return pa.table(
            {
                "bucket": pa.array([group["bucket"][0].as_py()] * (rows + 1), pa.int64()),
                "unit": pa.array([*group["unit"].to_pylist(), None], pa.int64()),
                "part": pa.array([*group["part"].to_pylist(), None], pa.int32()),
                "counted": told[0],
                "tuned": told[1],
                "n_known": pa.array([*none, int((sums[0] + sums[1] > 0).sum())], pa.int64()),
                "n_counted": pa.array([*none, int((sums[0] > 0).sum())], pa.int64()),
            }
        )

    return stated.groupBy("bucket").applyInArrow(total, _ANSWER)


def _totals(answer: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Totals of a unit's words and pairs in the order of their hashes: (counted, tuned) of words, then of pairs."""
    answer = answer.sort_by("bucket")
    kind = answer["bucket"].to_numpy() % 2
    out = []
    for k in (0, 1):
        own = answer.filter(pa.array(kind == k))
        out += [own[c].combine_chunks().flatten().to_numpy() for c in ("counted", "tuned")]
    return tuple(out)


def frequency_bucket(count):
    """0 for an unseen context, then one more with each doubling."""
    return np.ceil(np.log2(np.asarray(count) + 1)).astype(np.int64)


def tuning_events(table: DataFrame, told: DataFrame) -> DataFrame:
    """``bucket, pair, context, word, n``: how often tuning documents have a pair with such counts in the counted ones.

    Beyond its bucket, the context only matters where the pair was counted; else it is given as 0.
    """

    def run(unit: pa.Table, answer: pa.Table) -> pa.Table:
        data = read_unit(unit["words"][0].as_py())
        words, _, pairs, _ = _totals(answer)
        first = np.unique(data.pair_of, return_index=True)[1]  # an event of each pair
        events = np.stack(
            [pairs, words[data.word_of[data.tokens[first]]], words[data.word_of[data.tokens[first + 1]]]], axis=1
        )
        bucket = frequency_bucket(events[:, 1])
        events[events[:, 0] == 0, 1] = 0
        names = ["bucket", "pair", "context", "word"]
        columns = [pa.array(np.ascontiguousarray(c)) for c in (bucket, *events.T)]
        made = pa.table([*columns, pa.array(data.pair_counts.astype(np.int64))], names=[*names, "n"])
        return made.group_by(names).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select([*names, "n"])

    schema = "bucket bigint, pair bigint, context bigint, word bigint, n bigint"
    mine = table.where(F.col("part") == TUNE).select("unit", "words").groupBy("unit")
    events = mine.cogroup(told.where(F.col("part") == TUNE).groupBy("unit")).applyInArrow(_both(run, schema), schema)
    return events.groupBy("bucket", "pair", "context", "word").agg(F.sum("n").alias("n"))


def _both(run, schema: str):
    """``run`` for units with answers; answers to other units than asked for give nothing."""
    names = [c.split()[0] for c in schema.split(", ")]

    def called(unit: pa.Table, answer: pa.Table) -> pa.Table:
        return run(unit, answer) if unit.num_rows else pa.table({n: pa.array([], _ARROW_OF.get(n, pa.int64())) for n in names})

    return called


_ARROW_OF = {"held_out": pa.bool_(), "base_score": pa.float64(), "score": pa.float64()}


def learn_weights(events: DataFrame, n_tokens: int, n_words: int) -> dict[int, tuple[float, float, float]]:
    """Weights (pair, word, uniform) per bucket of context frequency, by expectation-maximisation.

    A round is one aggregation over all tuning events; the driver sees three sums per bucket, and
    buckets are as many as the largest count has binary digits.
    """
    pair = F.when(F.col("context") > 0, F.col("pair") / F.col("context")).otherwise(0.0)
    word = F.col("word") / F.lit(float(max(n_tokens, 1)))
    shares = stored(events.select("bucket", pair.alias("pair"), word.alias("word"), "n"), "tuning").persist()
    try:
        return _weights(shares, n_words)
    finally:
        shares.unpersist()


def _weights(shares: DataFrame, n_words: int) -> dict[int, tuple[float, float, float]]:
    buckets = sorted(r[0] for r in shares.select("bucket").distinct().collect())
    weights = {b: (1 / 3, 1 / 3, 1 / 3) if b else (0.0, 0.5, 0.5) for b in buckets}
    uniform = 1 / (n_words + 1)
    for _ in range(EM_ROUNDS if buckets else 0):
        known = [F.create_map(*[F.lit(x) for b in buckets for x in (b, weights[b][k])])[F.col("bucket")] for k in range(3)]
        parts = [known[0] * F.col("pair"), known[1] * F.col("word"), known[2] * uniform]
        whole = parts[0] + parts[1] + parts[2]
        sums = shares.groupBy("bucket").agg(*[F.sum(F.col("n") * p / whole).alias(f"s{k}") for k, p in enumerate(parts)]).collect()
        new = {r["bucket"]: (r["s0"], r["s1"], r["s2"]) for r in sums}
        new = {b: tuple(x / sum(s) for x in s) for b, s in new.items()}
        change = max(abs(x - y) for b in buckets for x, y in zip(new[b], weights[b], strict=True))
        weights = new
        if change < EM_CLOSE:
            break
    return {b: _floored(w) for b, w in weights.items()}


def _floored(weights: tuple[float, float, float]) -> tuple[float, float, float]:
    rest = weights[0] + weights[1]
    uniform = max(weights[2], LEAST_UNIFORM)
    return (weights[0] * (1 - uniform) / rest, weights[1] * (1 - uniform) / rest, uniform) if rest else (0.0, 0.0, 1.0)


def weight_table(weights: dict[int, tuple[float, float, float]]) -> np.ndarray:
    """A row per bucket up to 64; a bucket without tuning events takes the weights of the next lower one that has some."""
    out, last = np.empty((65, 3)), (1 / 3, 1 / 3, 1 / 3)
    for b in range(1, 65):
        last = weights.get(b, last)
        out[b] = last
    unseen = weights.get(0, out[1])
    out[0] = _floored((0.0, unseen[1], unseen[2]))  # an unseen context tells nothing
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """Train on the documents that are not held out and score all of them.

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``. Tokens are runs of
    anything but ASCII white space with A-Z in lower case, and one end token per document. A null text is
    empty, a null id is trained on, repeated rows are documents of their own, other columns are not
    looked at, an empty table gives no rows. Without training tokens every word has the uniform probability.
    """
    narrow = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        part_of(F.col(id_col)).alias("part"),
        F.col(text_col).cast("string").alias("text"),
    )
    table = stored(units(narrow, unit_bytes), "lm-units")
    count = table.count()
    bits = min(24, max(4, (2 * count).bit_length()))  # a bucket holds about as many entries as half a unit
    told = stored(answers(statements(table, bits)), "lm-totals")
    known = told.where("unit is null and bucket % 2 = 0").agg(F.sum("n_known"), F.sum("n_counted")).first()
    n_words, n_counted_words = known[0] or 0, known[1] or 0
    tokens = {r["part"]: r["n"] for r in table.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    counted, tuned = tokens.get(COUNT, 0), tokens.get(TUNE, 0)
    told = told.where("unit is not null").select("unit", "part", "bucket", "counted", "tuned")
    weights = learn_weights(tuning_events(table, told), counted, n_counted_words)
    return _scored(table, told, weight_table(weights), counted + tuned, n_words)


def _scored(table: DataFrame, told: DataFrame, weights: np.ndarray, n_tokens: int, n_words: int) -> DataFrame:
    def run(unit: pa.Table, answer: pa.Table) -> pa.Table:
        data = read_unit(unit["words"][0].as_py())
        word_a, word_b, pair_a, pair_b = _totals(answer)
        words, pairs = word_a + word_b, pair_a + pair_b
        by_number = words[data.word_of]
        context, word = by_number[data.tokens[:-1]], by_number[data.tokens[1:]]
        pair = pairs[data.pair_of]
        mix = weights[frequency_bucket(context)]
        p = mix[:, 0] * pair / np.maximum(context, 1) + mix[:, 1] * word / max(n_tokens, 1) + mix[:, 2] / (n_words + 1)
        if not n_tokens:
            p = np.ones(len(word))
        ends = np.flatnonzero(data.tokens[1:] == 0)
        starts = np.append(0, ends[:-1] + 1)
        ids = unit["doc_ids"][0].values
        part = unit["part"][0].as_py()
        base = np.log10((word + 1) / (n_tokens + n_words + 1))
        return pa.table(
            {
                "doc_id": ids,
                "held_out": pa.array(np.full(len(ids), part == HELD_OUT)),
                "n_tokens": ends - starts + 1,
                "n_known": np.add.reduceat((word > 0).astype(np.int64), starts),
                "train_tokens": np.full(len(ids), n_tokens, np.int64),
                "base_score": np.add.reduceat(base, starts),
                "score": np.add.reduceat(np.log10(p), starts),
            }
        )

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    mine = table.select("unit", "part", "doc_ids", "words").groupBy("unit")
    return mine.cogroup(told.groupBy("unit")).applyInArrow(_both(run, schema), schema)
