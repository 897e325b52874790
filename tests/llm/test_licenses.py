import random
import textwrap
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rainledger.llm import licenses
from rainledger.llm.queries import op6_license_scan
from tests.helpers import plan
from tests.llm import brute

COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def rounded(rows):
    return Counter((*r[:-1], round(r[-1], 9)) for r in rows)


def test_contract(spark, tables):
    folder, docs = tables
    got = rounded(tuple(r[c] for c in COLUMNS) for r in op6_license_scan(spark, folder).collect())
    assert got == rounded(brute.op6(docs, licenses.PHRASES, licenses.TEMPLATES, licenses.THRESHOLD))
    assert sum(bool(r[6]) for r in got) > 3


def test_notices_and_edited_notices(spark, tables):
    rng = random.Random(2)
    rows = [(-1, None), (-2, "")]
    for i, (_, template) in enumerate(licenses.TEMPLATES * 4):
        words = template.split()
        for _ in range(i // len(licenses.TEMPLATES)):
            words[rng.randrange(len(words))] = "edited"
        rows.append((i, f"some line\n{' '.join(words).upper()} and more words\nBY CC by-nc by CC BY NC\ncc by nc"))
    rows.append((900, "licensed under the mit\nlicense"))  # a phrase over two lines
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as LABELS", "2 as row", "3 as blocks", "4 as best", "5 as More")
    out = licenses.scan(docs)
    got = rounded(tuple(r[c] for c in COLUMNS) for r in out.collect())
    assert got == rounded(brute.op6(rows, licenses.PHRASES, licenses.TEMPLATES, licenses.THRESHOLD))
    assert out.columns == ["doc_id", "row", "best", "More", *COLUMNS[1:]]


def wrapped(text, width, prefix=""):
    return "\n".join(prefix + line for line in textwrap.wrap(text, width, break_long_words=False))


@pytest.mark.parametrize("width", [30, 72])
@pytest.mark.parametrize("prefix", ["", " * ", "# "])
def test_wrapped_notices(spark, tables, width, prefix):
    rows = []
    for i, (_, template) in enumerate(licenses.TEMPLATES):
        rows.append((i, f"title\n\n{wrapped('Copyright 2024 by its authors. ' + template + ' and so on', width, prefix)}\n\nend"))
        broken = wrapped(template, 20).split("\n")
        rows.append((100 + i, "\n\n".join(["some words", *broken])))  # a paragraph a line: no block holds it
    out = {r.doc_id: (r.labels.split(","), r.score) for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), phrases={}).collect()}
    for i, (label, _) in enumerate(licenses.TEMPLATES):
        assert label in out[i][0] and out[i][1] == 1.0
        assert out[100 + i][1] == 0.0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c", b"d", b"x", b"y"]), max_size=4), max_size=12), st.integers(0, 8), st.integers(1, 3))
def test_blocks_left_out_lie_in_others(lines, reach, least):
    vocabulary = frozenset([b"a", b"b", b"c", b"d"])
    text = "\n".join(" ".join(w.decode() for w in line) for line in lines)
    every = [shared for b in brute.blocks(text, reach) if len(shared := {w.encode() for w in b} & vocabulary) >= least]
    found = licenses.text_blocks(lines, vocabulary, least, reach)
    assert all(any(b <= f for f in found) for b in every)
    assert all(f in every for f in found)


@pytest.mark.parametrize("threshold", [0.3, 0.5, 1.0])
def test_the_filters_lose_nothing(spark, tables, threshold):
    rng = random.Random(9)
    vocabulary = [f"t{i}" for i in range(14)]
    pick = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    templates = [(f"l{i}", pick(rng.randrange(1, 9))) for i in range(8)]
    rows = [(i, "\n".join(pick(rng.randrange(0, 9)) for _ in range(3))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = rounded(tuple(r[c] for c in COLUMNS) for r in licenses.scan(docs, phrases={}, templates=templates, threshold=threshold).collect())
    assert got == rounded(brute.op6(rows, {}, templates, threshold))


def test_empty(spark, empty_tables):
    assert op6_license_scan(spark, empty_tables).collect() == []


def test_no_cross_join(spark, tables):
    text = plan(op6_license_scan(spark, tables[0]))
    assert "Cartesian" not in text and "NestedLoop" not in text
