import random

from hypothesis import given, settings
from hypothesis import strategies as st

from rainledger.llm import linededup
from rainledger.llm.queries import op5_substring_dedup
from tests.llm import brute


def key(doc_id, spans, text):
    return doc_id is None, doc_id or 0, str([tuple(s.values()) if isinstance(s, dict) else tuple(s) for s in spans]), str(text)


def test_against_a_plain_version(spark, tables):
    folder, docs = tables
    got = sorted(key(r.doc_id, r.removed, r.text) for r in op5_substring_dedup(spark, folder).collect())
    assert got == sorted(key(*x) for x in brute.op5(docs, linededup.MIN_WORDS))
    assert sum(k[2] != "[]" for k in got) > 20


def test_a_passage_inside_lines_stays_once(spark, tables):
    rng = random.Random(5)
    words = lambda n: " ".join(f"w{rng.randrange(99999)}" for _ in range(n))
    passage = f"The {words(30)}. A {words(10)}. Then {words(14)}."
    texts = {i: f"{words(20)} {passage} {words(20)}." for i in range(30)}
    clean = {100 + i: f"{words(30)}. See also. {words(30)}." for i in range(30)}
    rows = [*texts.items(), *clean.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' as row", "1 as UNITS", "doc_id as removed")
    out = {r.doc_id: r for r in linededup.deduplicated(docs).collect()}
    assert out[0].text == texts[0] and out[0].row == "x" and out[0].UNITS == 1
    for i in range(1, 30):
        [span] = out[i].removed
        assert texts[i][span.start : span.end] == passage and span.first_doc_id == 0 and span.n_words == 57
        assert out[i].text == texts[i].replace(f"{passage} ", "")
    assert all(out[i].text == t for i, t in clean.items())


def test_empty(spark, empty_tables):
    assert op5_substring_dedup(spark, empty_tables).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB .\n!é", max_size=60))
def test_units_hold_all_words(text):
    found = linededup.units(text)
    assert [w for _, a, b, _ in found for w in brute.alnum(text[a:b])] == brute.alnum(text)
    assert all(n == len(brute.alnum(text[a:b])) > 0 for _, a, b, n in found)
    assert [(a, b) for _, a, b, _ in found] == [(a, b) for _, a, b in brute.sentences(text)]
    assert all(b <= c for (_, _, b, _), (_, c, _, _) in zip(found, found[1:]))
