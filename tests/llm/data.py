"""Small tables with the awkward cases, as folders of Parquet that queries can read."""

from __future__ import annotations

import random

ITEMS = [
    (10, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (9, "Alpha, BETA gamma delta epsilon zeta eta theta iota kappa!"),
    (3, "short item"),
    (None, "nameless item with words that are enough to be one window here"),
    (4, None),
    (5, "..."),
    (3, "short item again"),
]


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


def documents(n=120, seed=7):
    """(doc_id, text): nulls, empty and blank texts, one very long, copies, near copies, odd characters, a null id."""
    rng = random.Random(seed)
    rows = [(-5, None), (0, ""), (1, " \n\t "), (2, "one"), (3, "Two words"), (None, "no id but a text of some words"), (None, None)]
    rows.append((4, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu " * 3))
    rows.append((5, "x Short\x00ITEM y short item again z. ALPHA-beta gamma delta epsilon zeta eta theta iota kappa"))
    rows.append((6, "naïve café  double   spaces\n\nblank lines \ttabs nbsp 日本語 text 🙂 it's don't 123abc\r\nCRLF \x01 <|endoftext|> "))
    rows.append((7, " ".join(words(rng, 30_000, 3000))))
    rows.append((8, "same same " * 400))
    base = " ".join(words(rng, 200, 5000)) + ".\n" + " ".join(words(rng, 100, 5000))
    rows += [(100 + i, base) for i in range(12)]
    for i in range(12):
        near = base.split(" ")
        near[rng.randrange(len(near))] = f"edit{i}"
        rows.append((200 + i, " ".join(near)))
    passage = "The passage " + " ".join(words(rng, 60, 5000)) + " ends here."
    for i in range(n):
        lines = [" ".join(words(rng, rng.randrange(1, 40), 2000)).capitalize() + "." for _ in range(rng.randrange(1, 8))]
        if i % 3 == 0:
            lines.insert(0, "Home About Contact Search this site")
        if i % 10 == 0:
            lines[-1] = lines[-1][:-1] + " " + passage + " " + " ".join(words(rng, 30, 2000))
        if i % 17 == 0:
            lines.append("Released under the MIT License.")
        rows.append((1000 + 3 * i, "\n".join(lines)))
    rng.shuffle(rows)
    return rows


def write_tables(spark, folder, docs=None, items=ITEMS, pages=()):
    docs = documents() if docs is None else docs
    rows = [(d, t, "en", f"src{(d or 0) % 3}", None if t is None else len(t)) for d, t in docs]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(items), "item_id bigint, text string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(list(pages), "page_id bigint, url string, html string").write.mode("overwrite").parquet(f"{folder}/pages.parquet")
    return str(folder), docs
