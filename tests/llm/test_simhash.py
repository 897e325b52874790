import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rainledger.llm import components, regions, simhash
from rainledger.llm.queries import op7_simhash
from tests.llm import brute


def test_contract(spark, tables):
    folder, docs = tables
    got = Counter(tuple(r) for r in op7_simhash(spark, folder).collect())
    assert got == Counter(brute.op7(docs))


def test_empty(spark, empty_tables):
    assert op7_simhash(spark, empty_tables).collect() == []
    assert simhash.one_of_each(spark.read.parquet(f"{empty_tables}/documents.parquet")).collect() == []


def near_prints(n=400, seed=4):
    """Chains and clusters of fingerprints 1 to 6 bits apart."""
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 30])):
            out.add(x)
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                x ^= 1 << b
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 2])
def test_no_link_is_missed(spark, tables, block):
    prints = near_prints()
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp bigint")
    got = {r.node: r.root for r in components.components(simhash.links(df, 4, block=block)).collect()}
    root = {x: x for x in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(prints):
        for y in prints[:i]:
            if (x ^ y).bit_count() <= 4:
                root[find(x)] = find(y)
    want = Counter(frozenset(k for k in prints if find(k) == r) for r in {find(x) for x in prints})
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    groups = {}
    for x in prints:
        groups.setdefault(got.get(signed(x), signed(x)), set()).add(x)
    assert Counter(map(frozenset, groups.values())) == want


def test_covering(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    parts, near = simhash.segments(4)
    for low, bits in parts:
        segment = x >> np.uint64(low) & np.uint64((1 << bits) - 1)
        home = simhash.nearest(segment)
        assert (simhash.syndromes(home) == 0).all() and (np.bitwise_count(home ^ segment) <= 1).all()
        where, found = simhash.anchors(x, low, bits, 1 + near)
        assert set(zip(range(500), home.tolist())) <= set(zip(where.tolist(), found.tolist()))
    assert sum(b for _, b in parts) == 64


def test_one_of_each(spark, tables):
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows = [(None, "no id"), (None, "no id"), (7000, None), (7001, ""), (7002, "  ")]
    for group in range(20):
        base = words(250)
        rows.append((group * 100, " ".join(base)))
        for copy in range(1, 12):
            near = list(base)
            near[rng.randrange(250)] = f"edit{copy}"
            rows.append((group * 100 + copy, " ".join(near if copy % 2 else base)))
    rows += [(5000 + i, " ".join(words(120))) for i in range(60)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as row", "2 as NODE", "3 as fp0")
    out = simhash.one_of_each(docs)
    assert out.columns == docs.columns
    kept = sorted((r.doc_id for r in out.collect()), key=lambda x: (x is None, x or 0))
    assert kept == [*range(0, 2000, 100), *range(5000, 5060), 7000, None]


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_similarity_itself_decides(spark, tables):
    """Appended blocks above 0.8 go and scattered edits below 0.8 stay, whatever bits of a sketch they change."""
    rng = random.Random(9)
    words = lambda n: [f"w{int(rng.paretovariate(0.8))}" if rng.random() < 0.6 else f"v{rng.randrange(9999)}" for _ in range(n)]
    rows, stay = [], set()
    for pair in range(60):
        base = words(400)
        near = base + words((90, 60, 40)[pair % 3]) if pair % 2 else list(base)
        if pair % 2 == 0:
            for at in range(5, 400, (60, 30, 25)[pair % 3]):
                near[at] = f"edit{pair}x{at}"
        rows += [(2 * pair, " ".join(base)), (2 * pair + 1, " ".join(near))]
        one, two = shingles(base), shingles(near)
        stay |= {2 * pair} | ({2 * pair + 1} if len(one & two) < 0.8 * len(one | two) else set())
    assert 70 < len(stay) < 110
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id for r in simhash.one_of_each(docs).collect()} == stay


def test_every_pair_of_a_key_is_decided(spark, tables):
    """Regions find the components that all pairs of a key give: chains and strangers, whole or in blocks."""
    rng = random.Random(2)
    sets = {n: set(range(1000 * (n // 20) + 3 * n, 1000 * (n // 20) + 3 * n + 40)) for n in range(100)}  # a chain of 20
    sets |= {n: {rng.randrange(10**6) for _ in range(20)} for n in range(100, 130)}
    members = [(n % 3 if n < 100 else 0, n) for n in sets] + [(7, n) for n in sets]
    first = {k: min(n for key, n in members if key == k) for k, _ in members}
    for block in (1024, 16):
        out = regions.region_links(
            spark.createDataFrame([(first[k], n, len(sets[n])) for k, n in members], "pivot bigint, node bigint, n int").distinct(),
            spark.createDataFrame([(n, sorted(x)) for n, x in sets.items()], "node bigint, shingles array<bigint>"),
            80,
            block,
        )
        assert {n: n // 20 * 20 for n in range(100)} == {r.node: r.root for r in out.collect()}


def test_components_of_a_long_path(spark, tables):
    order = list(range(300))
    random.Random(1).shuffle(order)
    df = spark.createDataFrame([(order[i], order[i + 1]) for i in range(299)] + [(1000, 1001), (5, 5)], "a bigint, b bigint")
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {i: 0 for i in range(300)} | {1000: 1000, 1001: 1000}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=40))
def test_forest(pairs):
    a, b = (np.array(x) for x in zip(*pairs))
    x, y = components.forest(a, b)
    assert len(x) <= len({*a.tolist(), *b.tolist()})

    def classes(edges):
        root = {n: n for e in pairs for n in e}
        for _ in range(40):
            for p, q in edges:
                root[p] = root[q] = min(root[p], root[q])
        return root

    assert classes(pairs) == classes(list(zip(x.tolist(), y.tolist())))


def test_fingerprint():
    for text in ("", "A b", "a b c d", "One two three four five", "x " * 50, "naïve ÄÖ a b c"):
        assert simhash.simhash(simhash.shingle_hashes(text.encode(), 4)) == brute.fingerprint(text)
