from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from rainledger.llm import decontaminate
from rainledger.llm.queries import op10_decontamination
from tests.llm import brute
from tests.llm.data import ITEMS


def test_contract(spark, tables):
    folder, docs = tables
    got = Counter(tuple(r) for r in op10_decontamination(spark, folder).collect())
    assert got == Counter(brute.op10(docs, ITEMS))
    assert sum(r[-1] for r in got) == 2


def test_empty(spark, empty_tables, tables):
    assert op10_decontamination(spark, empty_tables).collect() == []
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.uncontaminated(docs, nothing).count() == docs.count()


def test_blocks_of_items_give_the_same(spark, tables):
    folder, docs = tables
    read = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{folder}/benchmark.parquet")
    one = decontaminate.find_occurrences(*read).drop("text").collect()
    many = decontaminate.find_occurrences(*read, block_bytes=60).drop("text").collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_clashing_names(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet").selectExpr("*", "1 as n_words", "2 as hit_spans", "3 as SPANS")
    bench = spark.read.parquet(f"{tables[0]}/benchmark.parquet")
    kept = decontaminate.uncontaminated(docs, bench)
    assert kept.columns == docs.columns
    clean = {r[0] for r in brute.op10(tables[1], ITEMS) if not r[-1]}
    assert {r.doc_id for r in kept.collect()} == clean
    assert kept.where("n_words <> 1 or hit_spans <> 2").count() == 0


WORDS = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40)


@settings(max_examples=200, deadline=None)
@given(WORDS, st.lists(WORDS, max_size=4), st.integers(1, 5))
def test_search_finds_every_occurrence(text, items, window):
    tables = decontaminate.searchers([(i, b" ".join(w).decode()) for i, w in enumerate(items)], window)
    got = {(at, t.length, i) for t in tables for at, found in t.find(text) for i in found}
    want = set()
    for i, item in enumerate(items):
        n = min(window, len(item))
        parts = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if n else set()
        want |= {(at, n, i) for at in range(len(text) - n + 1) if n and tuple(text[at : at + n]) in parts}
    assert got == want
