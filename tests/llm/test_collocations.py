"""Phrases against counts of all n-grams, and the sort against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rainledger.llm import collocations
from rainledger.llm.common import bitmap, in_bitmap
from tests.llm.brute import lower


def plain(rows, least, top, width=5):
    """The contract for (text, lang) rows."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, width + 1):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        chosen = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {p[i : i + m] for p, a in chosen.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
                  if 100 * a >= 100 * chosen[p[i : i + m]]}
        scored = []
        for p, a in chosen.items():
            if p not in inside:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return Counter(out)


def corpus(seed=5):
    rng = random.Random(seed)
    zipf = lambda: f"W{min(60, int(rng.paretovariate(0.7)))}é"
    rows = []
    for i in range(150):
        words = [zipf() for _ in range(rng.randrange(0, 120))]
        if i % 3 == 0:
            words[5:5] = "New York City Hall of Records is open".split()
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\x0b", "\x1c "]) for w in words)
        rows.append((text, rng.choice(["en", "en", "en", "de", None, ""])))
    rows += [(None, "en"), ("", None), (" \n ", "xx"), ("same same " * 500, "en"), ("a b c a b c " * 30, "de"), ("a b. c", "und")]
    rows += [rows[3]] * 9
    return rows


def write(spark, rows):
    return spark.createDataFrame([(t, g, 1, "y") for t, g in rows], "text string, lang string, rank int, CODES string").repartition(4)


@pytest.mark.parametrize("least, top, part_pointers", [(20, 2000, 1 << 21), (12, 15, 2000), (5, 100, 60)])
def test_contract(spark, tables, least, top, part_pointers):
    """With small parts, leading words are routed deeper and partial counts are added up."""
    rows = corpus()
    got = collocations.collocations(write(spark, rows), least=least, top=top, part_pointers=part_pointers).collect()
    assert Counter(map(tuple, got)) == plain(rows, least, top)
    assert len(got) > 20


def test_empty(spark, tables):
    assert collocations.collocations(write(spark, corpus()).limit(0)).collect() == []
    assert collocations.collocations(write(spark, [("a b", "en"), (None, None)])).collect() == []


def test_slices(spark, tables, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 10)
    text = b"one two.three four five six, seven eight nine ten" * 3
    joined = b"".join(collocations._slices(text.translate(collocations._LETTERS)))
    assert joined == text.translate(collocations._LETTERS)
    assert all(len(s) < 30 for s in collocations._slices(text.translate(collocations._LETTERS)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=2, max_size=5), min_size=1, max_size=60), st.integers(1, 6))
def test_quicksort(suffixes, least):
    rows = np.array([s + [0] * (5 - len(s)) for s in suffixes]).T
    weights = np.arange(1, len(suffixes) + 1)
    want = Counter()
    for s, w in zip(suffixes, weights.tolist()):
        want.update({tuple(s[:m]): w for m in range(2, len(s) + 1)})
    got = list(collocations.quicksorted(rows, weights, least))
    assert len(got) == len(dict(got)) and dict(got) == {p: w for p, w in want.items() if w >= least}
    spread = list(collocations.quicksorted(rows, weights, least, 3))
    assert len(spread) == len(dict(spread)) and dict(spread) == {p: w for p, w in want.items() if w >= least or len(p) <= 3}


def test_bitmap(spark, tables):
    rng = random.Random(1)
    values = [rng.getrandbits(64) - (1 << 63) for _ in range(500)]
    bits = bitmap(spark.createDataFrame([(v,) for v in values], "x bigint"), "x", 1 << 16)
    assert in_bitmap(np.array(values), bits).all()
    assert set(np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist()) == {v % (1 << 16) for v in values}
