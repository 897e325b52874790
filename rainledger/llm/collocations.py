"""Phrases whose words stand together more often than apart, from sorted suffixes.

Words become 64-bit codes, tried for collisions. Every place of a text where two frequent words stand together points to
a suffix, of which up to ``width`` words matter. Equal suffixes of a task are one pointer with a weight before
they travel. First their leading two words alone are routed globally, and suffixes whose leading words
are not frequent together are abandoned there. The others are routed whole by their leading two words, and by more of them where those
lead too many. In each part a multikey three-way quicksort splits pointers by one word after the other, down to ``width``: the sizes
of equal partitions are the phrases' counts, and partitions below the threshold are abandoned.

Bitmaps of fixed size tell tasks which words and pairs are frequent, and which leading words have to be routed
deeper. They may say yes wrongly, which costs work and changes nothing. The number of parts follows the corpus, so a part's
pointers are bounded. Phrases are counted whole in one part, except those that are routed deeper:
their partial counts are added up.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainledger.llm.common import bitmap, in_bitmap, stored, texts_of

WIDTH = 5
PART_POINTERS = 1 << 22  # of a part, before its hottest leading words are taken out
BITS = 1 << 24  # of each bitmap
ROW_CODES = 1 << 18  # codes of a stored row, at least, and then up to the end of a document
FLUSH_CODES = 1 << 20  # codes that are sorted in a task at once
SLICE = 1 << 22  # bytes of a text that become words at once
MEMO_WORDS = 150_000  # of a language, in a task
_GAP = b"\xff"  # between pieces: no byte of UTF-8
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else 0xFF if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _slices(text: bytes) -> Iterator[bytes]:
    """``text`` in slices that end at spaces or between pieces."""
    at = 0
    while len(text) - at > SLICE:
        ends = [e for e in (text.find(b" ", at + SLICE), text.find(_GAP, at + SLICE)) if e >= 0]
        if not ends:
            break
        yield text[at : min(ends)]
        at = min(ends)
    yield text[at:]


class Coder:
    """Codes of a language's words, remembered, and the words' counts."""

    def __init__(self, lang: str, seed: int):
        self.prefix, self.seed = lang.encode() + b"\0", seed
        self.counts: Counter[bytes] = Counter()
        self._memo = {_GAP: 0}

    def code(self, word: bytes) -> int:
        return xxhash.xxh64_intdigest(self.prefix + word, self.seed)

    def codes(self, words: list[bytes]) -> np.ndarray:
        if len(self._memo) > MEMO_WORDS:
            self._memo = {_GAP: 0}
        memo = self._memo
        for word in set(words).difference(memo):
            memo[word] = self.code(word)
        self.counts.update(words)
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def encoded(docs: DataFrame, seed: int) -> DataFrame:
    """Of ``lang, text``: rows of ``codes``, 0 between pieces, and rows of ``lang, word, code, n`` with a task's counts."""
    names = ["codes", "lang", "word", "code", "n"]
    types = [pa.list_(pa.int64()), pa.string(), pa.binary(), pa.int64(), pa.int64()]

    def table(rows: int, **given) -> pa.RecordBatch:
        columns = [given.get(n, pa.nulls(rows, t)) for n, t in zip(names, types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    def counted(coder: Coder) -> Iterator[pa.RecordBatch]:
        del coder.counts[_GAP]
        every = list(coder.counts.items())
        coder.counts = Counter()
        for at in range(0, len(every), 1 << 16):
            words, n = zip(*every[at : at + (1 << 16)], strict=True)
            code = np.array([coder.code(w) for w in words], np.uint64).view(np.int64)
            lang = pa.array([coder.prefix[:-1].decode()] * len(words))
            yield table(len(words), lang=lang, word=pa.array(words, pa.binary()), code=pa.array(code), n=pa.array(n, pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders: dict[str, Coder] = {}
        held: list[np.ndarray] = []
        size, gap = 0, np.zeros(1, np.uint64)

        def flush() -> pa.RecordBatch:
            nonlocal held, size
            column = np.concatenate(held).view(np.int64)
            held, size = [], 0
            return table(1, codes=pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), pa.array(column)))

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
                if lang not in coders:
                    if len(coders) >= 64:  # many languages: what was counted goes out
                        for coder in coders.values():
                            yield from counted(coder)
                        coders = {}
                    coders[lang] = Coder(lang, seed)
                for part in _slices(text.translate(_LETTERS)):
                    held.append(coders[lang].codes(part.replace(_GAP, b" \xff ").split()))
                    size += len(held[-1])
                held.append(gap)
                if size >= ROW_CODES:
                    yield flush()
                if len(coders[lang].counts) > MEMO_WORDS:
                    yield from counted(coders[lang])
        if held:
            yield flush()
        for coder in coders.values():
            yield from counted(coder)

    return docs.mapInArrow(run, "codes array<bigint>, lang string, word binary, code bigint, n bigint")


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[np.ndarray]:
    """The codes of neighbouring rows together, about ``limit`` at a time."""
    held, size = [], 0
    for batch in batches:
        for row in batch.column(0):
            codes = row.values.to_numpy(zero_copy_only=False).view(np.uint64)
            if held and size + len(codes) > limit:
                yield np.concatenate(held)
                held, size = [], 0
            held.append(codes)
            size += len(codes)
    if held:
        yield np.concatenate(held)


def suffixes(codes: np.ndarray, frequent: np.ndarray, width: int, pairs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct codes, the first of them 0; distinct suffixes as numbers of them, sorted, one row per depth; their weights).

    A suffix begins where two frequent words stand together and ends before the first word that is not frequent; with
    ``pairs``, before the first word that is not frequent behind its neighbour.
    """
    kept = np.where(in_bitmap(codes, frequent), codes, np.uint64(0))
    words, at = np.unique(np.concatenate([np.zeros(1, np.uint64), kept, np.zeros(width, np.uint64)]), return_inverse=True)
    goes_on = np.append((at[:-1] > 0) & (at[1:] > 0), False)
    if pairs is not None:
        both = np.flatnonzero(goes_on)
        goes_on[both] = in_bitmap(pair_key(words[at[both]], words[at[both + 1]]), pairs)
    starts = np.flatnonzero(goes_on)
    columns, on = [at[starts].astype(np.int64)], np.ones(len(starts), bool)
    for depth in range(1, width):
        on = on & goes_on[starts + depth - 1]
        columns.append(np.where(on, at[starts + depth], 0))
    half = (width + 1) // 2
    keys = []
    for part in (columns[:half], columns[half:]):
        key = np.zeros(len(starts), np.int64)
        for column in part:
            key = key * len(words) + column
        keys.append(key)
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= np.diff(key[order]) != 0
    first = np.flatnonzero(new)
    weights = np.diff(np.append(first, len(order)))
    return words, np.array([c[order[first]] for c in columns]), weights


def prefix_key(prefix: list[np.ndarray]) -> np.ndarray:
    """A number for the leading words' codes; equal numbers of different words only share a route."""
    key = np.zeros(len(prefix[0]), np.uint64)
    for column in prefix:
        key = (key ^ column) * _MIX
        key ^= key >> np.uint64(29)
    return key


def pair_key(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """40 bits of two neighbours' codes; pairs with equal keys are taken for one, so each seems as frequent as both."""
    return prefix_key([one, two]) >> np.uint64(24)


def frequent_pairs(codes: DataFrame, frequent, parts: int, least: int) -> DataFrame:
    """``key, n`` of the pairs of neighbours that occur ``least`` times or more."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, FLUSH_CODES):
            words, rows, weights = suffixes(chunk, frequent.value, 2)
            keys, at = np.unique(pair_key(words[rows[0]], words[rows[1]]), return_inverse=True)
            n = np.bincount(at, weights, len(keys)).astype(np.uint32)
            part = (keys * np.uint64(parts) >> np.uint64(40)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(part) else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                blob = zstandard.ZstdCompressor(3).compress(np.diff(keys[a:b], prepend=np.uint64(0)).tobytes() + n[a:b].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([int(part[a])], pa.int64()), pa.array([int(b - a)], pa.int64()), pa.array([blob], pa.binary())], ["part", "size", "blob"])

    def add(group: pa.Table) -> pa.Table:
        keys, n = [], []
        for size, blob in zip(group.column("size").to_pylist(), group.column("blob").to_pylist(), strict=True):
            data = zstandard.ZstdDecompressor().decompress(blob)
            keys.append(np.cumsum(np.frombuffer(data, np.uint64, size)))
            n.append(np.frombuffer(data, np.uint32, size, 8 * size))
        every, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, np.concatenate(n), len(every)).astype(np.int64)
        many = total >= least
        return pa.table([pa.array(every[many].view(np.int64)), pa.array(total[many])], ["key", "n"])

    return codes.mapInArrow(send, "part bigint, size bigint, blob binary").groupBy("part").applyInArrow(add, "key bigint, n bigint")


def routes(columns: list[np.ndarray], hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key that each suffix is routed by, number of its words in it): two words, or as many as are needed to be no hot prefix."""
    key, depths = prefix_key(columns[:2]), np.full(len(columns[0]), 2)
    open_rows = np.flatnonzero(in_bitmap(key, hot))
    for depth in range(3, len(columns) + 1):
        if not len(open_rows):
            break
        key[open_rows] = deeper = prefix_key([c[open_rows] for c in columns[:depth]])
        depths[open_rows] = depth
        open_rows = open_rows[in_bitmap(deeper, hot)]
    return key, depths


def hot_prefixes(codes: DataFrame, frequent, hot_words, width: int, limit: int) -> DataFrame:
    """``key`` of the prefixes of 2 to ``width - 1`` words that lead more than ``limit`` places; each of their words does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, FLUSH_CODES):
            words, rows, weights = suffixes(chunk, hot_words.value, width)
            columns = [words[r] for r in rows]
            for depth in range(2, width):
                has = columns[depth - 1] > 0
                key, at = np.unique(prefix_key([c[has] for c in columns[:depth]]), return_inverse=True)
                n = np.bincount(at, weights[has], len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    counts = codes.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") > limit).select("key")


def _pack(words: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> bytes:
    used, at = np.unique(rows, return_inverse=True)
    small = at.reshape(rows.shape).astype(np.uint16 if len(used) <= 1 << 16 else np.uint32)
    head = np.array([len(used), rows.shape[1], small.itemsize], np.int64)
    parts = (head, words[used], small, weights.astype(np.uint32))
    return zstandard.ZstdCompressor(1).compress(b"".join(p.tobytes() for p in parts))


def _unpack(blob: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n_words, n_rows, size = np.frombuffer(data, np.int64, 3)
    words = np.frombuffer(data, np.uint64, n_words, 24)
    rows = np.frombuffer(data, np.uint16 if size == 2 else np.uint32, width * n_rows, 24 + 8 * n_words)
    return words, rows.reshape(width, n_rows), np.frombuffer(data, np.uint32, n_rows, 24 + 8 * n_words + int(size) * width * n_rows)


def quicksorted(rows: np.ndarray, weights: np.ndarray, least: int, spread: int = 0) -> Iterator[tuple[tuple[int, ...], int]]:
    """(prefix, weight) of the prefixes of two and more words, by multikey three-way quicksort of pointers to the columns of ``rows``.

    Partitions that weigh less than ``least`` are abandoned, but not while they tell apart the first ``spread`` words:
    prefixes of so many words have weight in other parts too. 0 ends a suffix.
    """
    stack = [(np.arange(rows.shape[1]), 0, ())]
    while stack:
        at, depth, prefix = stack.pop()
        values = rows[depth][at]
        pivot = np.sort(values[:: max(1, len(at) // 9)])[min(len(at), 9) // 2]
        equal, less = values == pivot, values < pivot
        for side in (at[less], at[~(equal | less)]):
            if len(side) and (depth < spread or weights[side].sum() >= least):
                stack.append((side, depth, prefix))
        same, longer = at[equal], (*prefix, int(pivot))
        weight = int(weights[same].sum())
        if pivot == 0 or weight < least and depth >= spread:
            continue
        if depth > 0:
            yield longer, weight
        if depth + 1 < len(rows):
            stack.append((same, depth + 1, longer))


def phrase_counts(codes: DataFrame, frequent, pairs, hot, parts: int, width: int, least: int) -> DataFrame:
    """``phrase`` (codes), ``f``: all phrases of 2 to ``width`` words that occur ``least`` times."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, FLUSH_CODES):
            words, rows, weights = suffixes(chunk, frequent.value, width, pairs.value)
            key, _ = routes([words[r] for r in rows], hot.value)
            part = (key >> np.uint64(7)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1)) if len(part) else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                own = order[a:b]
                blob = _pack(words, rows[:, own], weights[own])
                yield pa.RecordBatch.from_arrays([pa.array([int(part[own[0]])], pa.int64()), pa.array([blob], pa.binary())], ["part", "blob"])

    def sort(group: pa.Table) -> pa.Table:
        every = [_unpack(blob, width) for blob in group.column("blob").to_pylist()]
        words = np.unique(np.concatenate([np.zeros(1, np.uint64), *(w for w, _, _ in every)]))
        columns = np.concatenate([np.searchsorted(words, w).astype(np.uint32)[r] for w, r, _ in every], axis=1)
        weights = np.concatenate([w for _, _, w in every]).astype(np.int64)
        del every

        _, depths = routes([words[c] for c in columns], hot.value)
        found: list[tuple[tuple[int, ...], int]] = []
        for depth in np.unique(depths).tolist():  # all suffixes of a prefix of so many words are here
            own = depths == depth
            found += quicksorted(columns[:, own], weights[own], least, depth - 1 if depth > 2 else 0)
        phrases = pa.array([words[list(p)].view(np.int64) for p, _ in found], pa.list_(pa.int64()))
        return pa.table([phrases, pa.array([n for _, n in found], pa.int64())], ["phrase", "f"])

    counts = codes.mapInArrow(send, "part bigint, blob binary").groupBy("part").applyInArrow(sort, "phrase array<bigint>, f bigint")
    return counts.groupBy("phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 100,
    width: int = WIDTH,
    top: int = 2000,
    absorbed: int = 100,
    part_pointers: int = PART_POINTERS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of 2 to ``width`` words.

    A-Z count as lower case; ``.,;:!?`` and line ends cut texts into pieces, spaces and tabs pieces into words. ``a`` is how often a
    phrase stands inside pieces, overlaps included, at least ``least``; ``n`` all words of the language. Cut after k words,
    ``l`` and ``r`` are the counts of the two parts and the score is floor(1000 a n / (l r)); the cut of the lowest score counts, of
    equals that after fewer words. A phrase inside a longer one that has ``absorbed`` percent of its count is left out.
    Ranked by score, then ``a``, both descending, then by the phrase's bytes.

    A null text is empty and a null language ``und``; repeated rows count each. An empty table, or one without such phrases,
    gives no rows. Very long texts become words a slice at a time; their codes, 8 bytes a word, are one row. Other columns are left out.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    for seed in range(8):
        table = stored(encoded(rows, seed), "codes")
        counted = table.where(F.col("codes").isNull()).groupBy("lang", "word", "code").agg(F.sum("n").alias("f"))
        words = stored(counted, "words")
        same = words.groupBy("code").agg(F.count(F.lit(1)).alias("words")).where((F.col("words") > 1) | (F.col("code") == 0))
        if same.isEmpty():
            break
    else:
        raise RuntimeError("words share codes under every seed")
    codes = table.where(F.col("codes").isNotNull()).select("codes")
    frequent = stored(words.where(F.col("f") >= least), "frequent")
    share = spark.sparkContext.broadcast
    known = share(bitmap(frequent, "code", BITS))
    pointers = frequent.agg(F.sum("f")).first()[0] or 0
    pairs = stored(frequent_pairs(codes, known, max(1, math.ceil(pointers / part_pointers)), least), "pairs")
    pointers = pairs.agg(F.sum("n")).first()[0] or 0
    limit = part_pointers // 2
    hot_words = frequent.where(F.col("f") > limit)
    hot = np.zeros(BITS // 8, np.uint8)
    if not hot_words.isEmpty():
        hot = bitmap(hot_prefixes(codes, known, share(bitmap(hot_words, "code", BITS)), width, limit), "key", BITS)
    counts = phrase_counts(codes, known, share(bitmap(pairs, "key", BITS)), share(hot), max(1, math.ceil(pointers / part_pointers)), width, least)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked(_spelled(stored(counts, "phrases"), frequent), frequent, totals, absorbed, top)


def _spelled(phrases: DataFrame, frequent: DataFrame) -> DataFrame:
    """``lang, words, a`` of the phrases in codes."""
    each = phrases.select("phrase", "f", F.posexplode("phrase").alias("at", "code"))
    word = F.struct("at", F.col("word").cast("string").alias("word"))
    joined = each.join(frequent.select("code", "lang", "word"), "code").groupBy("phrase", "f").agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(word)).alias("words"))
    return stored(joined.select("lang", F.col("words.word").alias("words"), F.col("f").alias("a")), "spelled")


def ranked(phrases: DataFrame, frequent: DataFrame, totals: DataFrame, absorbed: int, top: int) -> DataFrame:
    """The best of ``phrases`` (``lang, words, a``) of each language, scored by their own counts and the words'."""
    joined = lambda words: F.concat_ws(" ", words)
    size = F.size("words")
    phrases = phrases.withColumn("phrase", joined("words"))
    f = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")).unionAll(frequent.select("lang", F.col("word").cast("string"), "f"))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.slice("words", 1, F.col("k"))).alias("left"), joined(F.slice("words", F.col("k") + 1, size - F.col("k"))).alias("right"))
    cuts = cuts.join(f.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(f.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(totals, "lang")
    exact = lambda c: F.col(c).cast("decimal(17,0)")
    cuts = cuts.withColumns({"above": F.lit(1000).cast("decimal(4,0)") * exact("a") * exact("n"), "below": exact("l") * exact("r")})
    lowest = F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    inside = phrases.where(size > 2).withColumn("long", F.explode(F.sequence(F.lit(2), size - 1)))
    inside = inside.withColumn("start", F.explode(F.sequence(F.lit(1), size - F.col("long") + 1)))
    inside = inside.groupBy("lang", joined(F.slice("words", F.col("start"), F.col("long"))).alias("phrase")).agg(F.max("a").alias("around"))
    alone = F.col("around").isNull() | (100 * F.col("around") < absorbed * F.col("a"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(alone).drop("around")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)  # the best of a language are among the best of its parts
    best = kept.withColumn("place", F.row_number().over(salted)).where(F.col("place") <= top)
    whole = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    return best.withColumn("rank", whole).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
