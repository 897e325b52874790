"""The pipeline against a version of each stage that works on lists."""

import random
from collections import Counter

import corpus_pipeline
from rainledger.llm import linededup, quality
from tests.llm import brute
from tests.llm.data import ITEMS, write_tables
from tests.llm.brute import op5 as expected
from tests.llm.test_packing import DIGEST, filled


def corpus(seed=11):
    """Clean documents, boilerplate, junk, exact and near copies, repeated passages, benchmark text."""
    rng = random.Random(seed)
    words = lambda n: " ".join(f"w{rng.randrange(20000)}x" for _ in range(n))
    menu = "Home About Contact Search this site"
    passage = f"The passage {words(60)} ends here."
    rows = []
    for i in range(90):
        lines = [f"{words(rng.randrange(20, 60)).capitalize()}." for _ in range(rng.randrange(3, 7))]
        if i % 2:
            lines.insert(0, menu)
        if i % 9 == 0:
            lines[1] = f"{lines[1][:-1]} {passage} {words(30)}"
        if i % 30 == 7:
            lines.append(f"{words(5)} {ITEMS[1][1]} {words(5)}")
        rows.append((i, "\n".join(lines)))
    for k, (i, text) in enumerate(rows[40:60]):
        parts = text.split(" ")
        if k % 2:
            parts[rng.randrange(len(parts))] = f"edit{k}"
        rows.append((1000 + k, " ".join(parts)))
    rows += [(2000, None), (2001, ""), (2002, words(20)), (2003, "spam spam spam " * 40), (None, words(100))]
    rng.shuffle(rows)
    return rows


def host(doc_id):
    return f"src{(doc_id or 0) % 3}"


def jaccard(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.lower().split(), b.lower().split())]
    return len(sets[0] & sets[1]) / max(1, len(sets[0] | sets[1]))


def plain(docs):
    verdicts = brute.op4(docs, host, quality.HOST_SHARE, quality.HOST_DOCS, quality.LEFT_WORDS, quality.LEFT_SHARE)
    lines = Counter()
    for doc_id, text in docs:
        lines.update({(host(doc_id), x) for x in (text or "").split("\n")})
    counts = Counter(host(d) for d, _ in docs)
    kept = []
    for (doc_id, text), verdict in zip(docs, verdicts):
        if verdict[-1]:
            limit = max(quality.HOST_DOCS, quality.HOST_SHARE * counts[host(doc_id)])
            left = [x for x in text.split("\n") if lines[host(doc_id), x] <= limit or not x.startswith("Home")]
            kept.append((doc_id, "\n".join(left)))
    kept.sort(key=lambda d: (d[0] is None, d[0] or 0))
    alone = []
    for doc_id, text in kept:
        if not any(jaccard(text, other) >= 0.8 for _, other in alone):
            alone.append((doc_id, text))
    cut = [(d, t) for d, _, t in expected(alone, linededup.MIN_WORDS)]
    return [(d, t) for d, t in cut if not brute.op10([(d, t)], ITEMS)[0][-1]]


def test_pipeline(spark, tables, tmp_path):
    folder, docs = write_tables(spark, tmp_path, corpus())
    want = plain(docs)
    rows = corpus_pipeline.run(spark, folder).collect()
    assert Counter(tuple(r[c] for c in DIGEST) for r in rows) == Counter(brute.op1_pieces(want))
    assert filled(rows) > 0
    ids = {d for d, _ in want}
    assert len(want) < len(docs) - 20 and not ids & set(range(1000, 2004)) and ids >= set(range(0, 40)) - {7, 37}


def test_stages_keep_the_columns(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet").selectExpr("*", "1 as removed", "'x' as ROW", "2 as fp", "3 as n_words")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables[0])
        assert out.schema.simpleString() == docs.schema.simpleString()
        assert out.where("removed <> 1 or row <> 'x' or fp <> 2 or n_words <> 3 or n_chars <> length(text)").count() == 0


def test_empty(spark, empty_tables):
    assert corpus_pipeline.run(spark, empty_tables).collect() == []
