"""Components against all pairs of sets, and the join in a cell against all pairs too."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rainledger.llm import jaccard, regions
from rainledger.llm.queries import op11_jaccard_join
from tests.llm.brute import WORD, lower
from tests.llm.data import write_tables


def shingles(text, width=5):
    words = WORD.findall(lower(text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def plain(docs, percent=80, width=5):
    sets = [shingles(t, width) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            common = len(x & sets[j])
            if common and 100 * common >= percent * len(x | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return Counter((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets)))


def near_copies(seed=3):
    """Groups of edited copies from well above to below the threshold, shared passages, and texts of shared lines."""
    rng = random.Random(seed)
    words = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    passage, lines = words(60), [words(12) for _ in range(14)]
    rows = []
    for group in range(12):
        base = words(rng.choice([8, 30, 120, 300]))
        for copy in range(rng.choice([2, 3, 40])):
            near = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 40))):
                near[rng.randrange(len(near))] = f"edit{rng.randrange(10**6)}"
            rows.append((group * 100 + copy, " ".join(near + (words(len(base) // 6) if copy % 7 == 3 else []))))
    rows += [(2000 + i, " ".join(words(40) + passage + words(20))) for i in range(40)]
    rows += [(3000 + i, " ".join(sum(rng.sample(lines, 9), []))) for i in range(50)]
    rows += [(4000, "a b c d"), (4001, "A  b\tc d"), (4002, "a b c d e"), (4003, "a"), (None, "a"), (None, "own text of no id at all"), (None, None), (4004, None), (4005, " ")]
    rows += [rows[3], rows[3], (5, rows[0][1])]
    rng.shuffle(rows)
    return rows


def collected(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_contract(spark, tables):
    folder, docs = tables
    assert collected(op11_jaccard_join(spark, folder)) == plain(docs)


@pytest.mark.parametrize("block, heavy, percent", [(1024, 16, 80), (16, 4, 80), (24, 2, 50), (8, 1000, 95)])
def test_regions(spark, tables, block, heavy, percent):
    """Also with small blocks, where regions are dealt to several, and with and without late shingles."""
    rows = near_copies()
    df = spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows], "doc_id bigint, text string, node int, LOW string, n_shingles int").repartition(3)
    out = jaccard.jaccard_components(df, block=block, heavy=heavy, percent=percent)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    got = collected(out)
    assert got == plain(rows, percent)
    assert len({c for _, _, c in got}) < len(rows) - 60 or percent == 95


def test_empty(spark, empty_tables):
    assert op11_jaccard_join(spark, empty_tables).collect() == []


def test_only_empty_texts(spark, tables, tmp_path):
    docs = [(1, None), (2, ""), (3, " "), (None, None)]
    folder, _ = write_tables(spark, tmp_path, docs)
    assert collected(op11_jaccard_join(spark, folder)) == Counter([(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 0, None)])


def sets_like(rng, count):
    base = [rng.sample(range(300), rng.randrange(2, 40)) for _ in range(6)]
    out = []
    for _ in range(count):
        s = set(rng.choice(base))
        for _ in range(rng.randrange(0, 6)):
            s ^= {rng.randrange(300)}
        out.append(s or {1})
    return out


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 150), st.sampled_from([50, 80, 90]), st.floats(0.1, 1))
def test_cell(seed, count, percent, share):
    """What the cell connects is what all pairs with one side at home connect, given what was connected before."""
    rng = random.Random(seed)
    sets = sets_like(rng, count)
    home = np.array([rng.random() < share for _ in sets])
    roots = np.array([rng.randrange(count) if rng.random() < 0.3 else i + count for i in range(count)])
    nodes = np.arange(count) * 7 + 3
    a, b = regions.cell_links(nodes, [np.array(sorted(s), np.uint64) for s in sets], roots, home, percent)

    def classes(links):
        label = np.unique(roots, return_inverse=True)[1]
        for i, j in links:
            label[label == label[j]] = label[i]
        groups = {}
        for i, x in enumerate(label.tolist()):
            groups.setdefault(x, set()).add(i)
        return sorted(map(sorted, groups.values()))

    pairs = [(i, j) for i in range(count) for j in range(i) if (home[i] or home[j]) and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    found = [((x - 3) // 7, (y - 3) // 7) for x, y in zip(a.tolist(), b.tolist())]
    assert classes(found) == classes(pairs)
    assert len(found) < count


def test_prefixes_meet():
    """Sets that link share a first shingle, whichever shingles are late, and of more places as many as every set must."""
    rng, linked = np.random.default_rng(5), 0
    for _ in range(400):
        x = rng.integers(0, 1 << 63, rng.integers(1, 300)).astype(np.uint64)
        y = np.unique(np.concatenate([x[rng.random(len(x)) < rng.choice([0.85, 0.93, 1])], rng.integers(0, 1 << 63, rng.integers(0, 4)).astype(np.uint64)]))
        x = np.unique(x)
        late = rng.integers(0, 256, 1 << 10).astype(np.uint8)
        if 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y)):
            linked += 1
            one, two = (jaccard.first_keys(s, jaccard.prefix_length(len(s), 80), late) for s in (x, y))
            assert len(np.intersect1d(one, two))
            one, two = (jaccard.first_keys(s, jaccard.prefix_length(len(s), 80, jaccard.SPARE)) for s in (x, y))
            for s in (x, y):
                assert len(np.intersect1d(one, two)) >= jaccard.least_shared(np.int64(len(s)), 80, jaccard.SPARE)
    assert linked > 100
