import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rainledger.llm import quality
from rainledger.llm.queries import op4_quality_rules
from tests.llm import brute


def host(doc_id):
    return f"src{(doc_id or 0) % 3}"


def test_contract(spark, tables):
    folder, docs = tables
    got = Counter(tuple(r) for r in op4_quality_rules(spark, folder).collect())
    want = brute.op4(docs, host, quality.HOST_SHARE, quality.HOST_DOCS, quality.LEFT_WORDS, quality.LEFT_SHARE)
    assert got == Counter(want)


def test_depleted_documents_go_and_copies_stay(spark, tables):
    menu = "Home About Contact Search this site and much more of the menu that each page has " * 4
    rng = __import__("random").Random(3)
    words = lambda n: " ".join(f"w{rng.randrange(9999)}" for _ in range(n))
    rows = [(i, f"{menu.strip()}\n{words(10)}\n{words(5)}", "h") for i in range(40)]  # little beside the menu
    rows += [(100 + i, f"{menu.strip()}\n{words(80)}", "h") for i in range(40)]  # enough beside it
    text = f"{words(60)}\n{words(60)}"
    rows += [(200 + i, text, "h") for i in range(300)]  # copies
    rows += [(600 + i, text.replace("w1", f"v{i}", 1), "h") for i in range(300)]  # near copies
    rows += [(1000, None, None), (1001, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "1 as row", "2 as HOST", "3 as n_words")
    out = quality.filtered(docs)
    assert out.columns == docs.columns
    kept = {r.doc_id: r.text for r in out.collect()}
    assert set(kept) == {i for i in range(100, 140)} | set(range(200, 500)) | set(range(600, 900))
    assert all("Home" not in kept[i] and len(kept[i].split()) == 80 for i in range(100, 140))
    assert all(kept[i] == text for i in range(200, 500))
    assert out.where("row <> 1 or host <> 2 or n_words <> 3").count() == 0


def removed_rows(spark, rows):
    docs = spark.createDataFrame(rows, "row bigint, text string, source string")
    return {r.row: len(r.removed or []) for r in quality.verdicts(docs, "row").collect()}


def test_footers_of_several_lines(spark, tables):
    """Lines that stand together are removed however short the rest is."""
    rng = random.Random(5)
    words = lambda n: " ".join(f"w{rng.randrange(9999)}" for _ in range(n))
    footer = "\n".join(words(20) for _ in range(6))
    for own in (7, 12, 32):
        got = removed_rows(spark, [(i, f"{words(own)}\n{footer}", "h") for i in range(300)])
        assert got == dict.fromkeys(range(300), 6)


def test_the_rule_alone_on_menus_footers_and_copies(spark, tables):
    """The count by sketches removes what the plain count of distinct documents removes."""
    rng = random.Random(11)
    words = lambda n: " ".join(f"w{rng.randrange(9999)}" for _ in range(n))
    menu, footer, copied = words(9), [words(15) for _ in range(4)], "\n".join(words(30) for _ in range(5))
    rows = []
    for i in range(400):
        lines = [words(rng.randrange(8, 30)) for _ in range(rng.randrange(2, 6))]
        lines = [menu] * (i % 2) + lines + footer[: rng.randrange(5)] + [words(4)] * (i % 5 == 0)
        rows.append((i, "\n".join(lines), "h" if i % 4 else "g"))
    rows += [(1000 + i, copied, "h") for i in range(300)]
    docs = spark.createDataFrame(rows, "row bigint, text string, source string")
    host_of = {r[0]: r[2] for r in rows}.get
    above = brute.boilerplate([r[:2] for r in rows], host_of, quality.HOST_SHARE, quality.HOST_DOCS)
    want = {r[0]: {quality.line_hash(x.encode()) for x in brute.normal_lines(r[1]) if (r[2], x) in above} for r in rows}
    assert len(above) == 9  # the footer on both hosts, the menu on one
    assert {r.row: set(r.removed or ()) for r in quality.verdicts(docs, "row").collect()} == want


def test_copies_count_on_neither_side(spark, tables):
    rng = random.Random(6)
    words = lambda n: " ".join(f"w{rng.randrange(9999)}" for _ in range(n))
    lines, menu = [words(20) for _ in range(6)], words(8)
    rows = [(i, "\n".join(lines), "h") for i in range(900)]
    for i in range(900, 1800):  # near copies, a word of some line changed
        near = [line.split() for line in lines]
        near[i % 6][rng.randrange(20)] = f"edit{i}"
        rows.append((i, "\n".join(map(" ".join, near))))
        rows[-1] += ("h",)
    rows += [(2000 + i, f"{words(60)}" + f"\n{menu}" * (i < 80), "h") for i in range(200)]
    assert removed_rows(spark, rows) == {r[0]: int(2000 <= r[0] < 2080) for r in rows}


def test_empty(spark, empty_tables):
    assert op4_quality_rules(spark, empty_tables).collect() == []
    assert quality.filtered(spark.read.parquet(f"{empty_tables}/documents.parquet")).collect() == []


def test_counts_are_per_host(spark, tables):
    line = "the same line of some words here"
    rows = [(i, f"{line}\nother{i}", f"h{i % 10}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("row", F.col("doc_id"))
    few = quality.verdicts(docs, "row", share=0.0, least_docs=10)
    assert few.where("removed is not null").count() == 0  # ten documents in each host
    more = quality.verdicts(docs, "row", share=0.0, least_docs=9)
    assert more.where("removed is not null").count() == 100


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\n\t\r\x0b#$日", max_size=60))
def test_measures(text):
    assert quality.measures(text.encode()) == brute.op4_base(text)[:5]
