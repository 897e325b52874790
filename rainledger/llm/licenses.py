"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

Notices are wrapped over lines, so a block begins with each line of a paragraph (lines up to one without
a word) and goes on until the lines after the first hold as many words as the longest template: a template
that is wrapped anyhow, after other words too, lies in the block of the line it begins in. A block matches a
template if it holds at least ``threshold`` of the template's distinct words. The join is exact: words are ordered from the rarest in the corpus on; a block that
meets the threshold must hold one of the template's first words in that order (prefix), have words
enough (length), and have words enough left after the shared one in both orders (position).
Candidates that pass are compared in full. Only words of templates travel, and the templates,
a list in code, are the small side of the join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.llm.common import alnum_words, free_name, stored, texts_of

THRESHOLD = 0.85

#: Phrases whose words in a row name a license.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Notices and grants of common licenses, as published.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                 "http://www.apache.org/licenses/LICENSE-2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
]


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(first word, label) of each place where a phrase's words follow each other."""
    out = []
    for phrase, label in phrases.items():
        parts = phrase.encode().split()
        if not set(parts) <= set(words):
            continue
        at = -1
        try:
            while True:
                at = words.index(parts[0], at + 1)
                if words[at : at + len(parts)] == parts:
                    out.append((at, label))
        except ValueError:
            pass
    return sorted(out)


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """``template, label, tokens``: distinct words, a row per template."""
    rows = [
        (i, label, sorted({w.decode() for w in alnum_words(text.encode())})) for i, (label, text) in enumerate(templates)
    ]
    return spark.createDataFrame([r for r in rows if r[2]], "template int, label string, tokens array<string>")


def text_blocks(lines: list[list[bytes]], vocabulary: frozenset[bytes], least: int, reach: int) -> list[set[bytes]]:
    """The words of ``vocabulary`` in each block, if at least ``least``: see the module; ``reach`` words after the first line.

    A block whose words all stand in the one before or after it is left out: whatever it matches, that one does, at no lower score.
    """
    out: list[set[bytes]] = []
    held: Counter[bytes] = Counter()  # of the lines from the block's first to before ``end``
    shared = [vocabulary.intersection(line) for line in lines]
    end = after = 0  # after: words of the block's lines behind the first
    for i, line in enumerate(lines):
        if not line:
            continue
        if end <= i:
            held.clear()
            held.update(shared[i])
            end, after = i + 1, 0
        else:
            after -= len(line)  # it was behind the line before, now it is the first
        while after < reach and end < len(lines) and lines[end]:
            held.update(shared[end])
            after += len(lines[end])
            end += 1
        if len(held) >= least:
            if out and out[-1] <= held.keys():
                out[-1] = set(held)
            elif not out or not held.keys() <= out[-1]:
                out.append(set(held))
        for word in shared[i]:
            if held[word] == 1:
                del held[word]
            else:
                held[word] -= 1
    return out


def scanned(docs: DataFrame, text_col: str, phrases: dict[str, str], vocabulary: frozenset[bytes], least: int, reach: int) -> DataFrame:
    """``docs`` without the text, with counts and phrases, and of each block with at least ``least`` words of templates those words."""
    others = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text in texts_of(batch, text_col):
                lines = [alnum_words(line) for line in text.split(b"\n")]
                words = [w for line in lines for w in line]
                places = phrase_places(words, phrases)
                starts = [at for at, _ in places]
                first, last = (starts[0], starts[-1]) if starts else (None, None)
                blocks = [[w.decode() for w in sorted(block)] for block in text_blocks(lines, vocabulary, least, reach)]
                out.append((len(words), len(places), first, last, sorted({x for _, x in places}), blocks))
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), *columns], [*others, *_NAMES])

    schema = docs.select(*others).schema
    for field in T.StructType.fromDDL(_SCHEMA):
        schema = schema.add(field)
    return docs.mapInArrow(run, schema)


_SCHEMA = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base array<string>, blocks array<array<string>>"
_NAMES = ["n_words", "n_base", "first_word", "last_word", "base", "blocks"]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.list_(pa.string()))]


def needed(size, threshold: float):
    """Shared words that a template of ``size`` words asks for."""
    return F.ceil(size * threshold - 1e-9).cast("int")


def matching_blocks(blocks: DataFrame, templates: DataFrame, threshold: float) -> DataFrame:
    """``row, block, label, score`` of every block and template with a containment of at least ``threshold``.

    ``blocks`` has ``row, block, tokens`` (distinct words that occur in templates).
    """
    counts = blocks.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    known = templates.select(F.explode("tokens").alias("token")).distinct()
    order = Window.orderBy(F.coalesce("n", F.lit(0)), "token")  # a row per word of the templates
    ranks = known.join(counts, "token", "left").select("token", F.row_number().over(order).alias("rank"))
    ranked = (
        templates.select("template", "label", F.explode("tokens").alias("token"))
        .join(ranks, "token")
        .groupBy("template", "label")
        .agg(F.sort_array(F.collect_list("rank")).alias("ranks"))
        .withColumn("size", F.size("ranks"))
        .withColumn("need", needed(F.col("size"), threshold))
    )
    prefix = ranked.select("*", F.posexplode(F.slice("ranks", F.lit(1), F.col("size") - F.col("need") + 1)).alias("t_at", "rank"))
    numbers = {r["token"]: r["rank"] for r in ranks.collect()}  # as many as the templates have distinct words
    lookup = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    mine = blocks.select("row", "block", F.sort_array(F.transform("tokens", lambda t: lookup[t])).alias("own"))
    probes = mine.select("row", "block", "own", F.posexplode("own").alias("b_at", "rank"))
    left = F.least(F.col("size") - F.col("t_at"), F.size("own") - F.col("b_at"))  # with the shared word itself
    shared = F.size(F.array_intersect("own", "ranks"))
    candidates = probes.join(F.broadcast(prefix), "rank").where(  # a row per prefix word
        (F.size("own") >= F.col("need")) & (left + F.least("t_at", "b_at") >= F.col("need"))
    )
    return (
        candidates.where(shared >= F.col("need"))
        .select("row", "block", "label", (shared / F.col("size")).alias("score"))
        .distinct()
    )


def scan(
    docs: DataFrame,
    text_col: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Labels of every document: its columns but the text, then ``n_words, n_base, first_word, last_word,
    base_labels, labels, score``.

    ``score`` is the largest containment among matching blocks, 1 where only a phrase was found, else 0. A null or
    empty text has no words; repeated rows each get their labels; an empty table gives no rows. A very long text
    is read in one go, its blocks leave as words of templates only. Columns of these names are replaced.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a share of a template's words")
    out_names = [*_NAMES, "base_labels", "labels", "score"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in out_names and c != text_col])
    row = free_name(docs, "row")
    spark = docs.sparkSession
    texts = [alnum_words(t.encode()) for _, t in templates]
    tokens = [set(t) for t in texts]
    vocabulary = frozenset().union(*tokens)
    reach = max(map(len, texts), default=0)
    least = min((math.ceil(len(t) * threshold - 1e-9) for t in tokens if t), default=1)
    rest = [c for c in docs.columns if c != text_col]
    rowed = docs.withColumn(text_col, F.col(text_col).cast("string")).withColumn(row, F.monotonically_increasing_id())
    found = stored(scanned(rowed, text_col, phrases, vocabulary, least, reach), "license-blocks")
    blocks = found.select(F.col(row).alias("row"), F.posexplode("blocks").alias("block", "tokens"))
    matches = matching_blocks(blocks, template_table(spark, templates), threshold)
    more, best = free_name(found, "more"), free_name(found, "best")
    labels = matches.groupBy(F.col("row").alias(row)).agg(F.collect_set("label").alias(more), F.max("score").alias(best))
    joined = found.join(labels, row, "left")
    every = F.array_sort(F.array_union("base", F.coalesce(more, F.array().cast("array<string>"))))
    phrase_score = F.when(F.col("n_base") > 0, 1.0).otherwise(0.0)
    return joined.select(
        *rest,
        *_NAMES[:4],
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.greatest(phrase_score, F.coalesce(best, F.lit(0.0))).alias("score"),
    )
