"""DuckDB SQL for the queries that SQL can express at a fair speed.

Not expressed: tokenizers (1, 2 and the pipeline), XXH64 with a seed (4, 7), crc32 (8, 9), cuts that look
behind (5). Those are tested against plain versions.
"""

from __future__ import annotations

from rainledger.llm.licenses import PHRASES, TEMPLATES, THRESHOLD

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(column: str) -> str:
    """The words of a text: A-Z in lower case, runs of letters, digits and what is beyond ASCII."""
    lower = f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT html, min(page_id) AS first FROM p WHERE strlen(html) >= 100 GROUP BY html)
SELECT page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, sha256(p.html) AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN firsts ON p.html = firsts.html"""

OP10 = f"""
WITH items AS (SELECT item_id, {words('text')} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
patterns AS (SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS part
             FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i FROM sized)),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {words('text')} AS w FROM documents),
windows AS (SELECT rid, n, i, list_slice(w, i, i + n - 1) AS part
            FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
                  FROM docs, (SELECT DISTINCT n FROM sized) WHERE len(w) >= n)),
hits AS (SELECT rid, item_id, i, windows.n FROM windows JOIN patterns ON windows.n = patterns.n AND windows.part = patterns.part),
places AS (SELECT rid, count(DISTINCT pos) AS n_hit
           FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS pos FROM hits) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN places ON docs.rid = places.rid LEFT JOIN found ON docs.rid = found.rid"""

_PHRASES = ", ".join(f"({str(phrase.split())}, '{label}')" for phrase, label in PHRASES.items())
_TEMPLATES = ", ".join(f"('{label}', '{text}')" for label, text in TEMPLATES)
OP6 = f"""
WITH phrases(part, label) AS (VALUES {_PHRASES}),
templates AS (SELECT label, list_distinct({words('text')}) AS asked FROM (VALUES {_TEMPLATES}) AS t(label, text)),
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {words('text')} AS w FROM documents),
starts AS (SELECT rid, w, unnest(generate_series(1, len(w))) AS i FROM docs WHERE len(w) > 0),
places AS (SELECT rid, i - 1 AS pos, label FROM starts JOIN phrases ON w[i] = part[1] AND list_slice(w, i, i + len(part) - 1) = part),
base AS (SELECT rid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
                string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY rid),
vocabulary AS (SELECT list_distinct(flatten(list(asked))) AS known FROM templates),
longest AS (SELECT max(len({words('text')})) AS reach FROM (VALUES {_TEMPLATES}) AS t(label, text)),
split AS (SELECT rid, {words('line')} AS line, no
          FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(1, len(string_split(text, chr(10))))) AS no FROM docs)),
lines AS (SELECT rid, no, len(line) AS n, list_intersect(line, known) AS shared,
                 sum(CASE WHEN len(line) = 0 THEN 1 ELSE 0 END) OVER upto AS par, sum(len(line)) OVER upto AS total
          FROM split, vocabulary WINDOW upto AS (PARTITION BY rid ORDER BY no)),
reached AS (SELECT rid, par, no, total, unnest(generate_series(no, no + reach)) AS other FROM lines, longest WHERE n > 0),
blocks AS (SELECT a.rid, list_distinct(flatten(list(b.shared))) AS b
           FROM reached a JOIN lines b ON b.rid = a.rid AND b.no = a.other AND b.par = a.par, longest
           WHERE b.no = a.no OR b.total - b.n - a.total < reach GROUP BY a.rid, a.no),
matches AS (SELECT rid, label, CAST(len(list_intersect(b, asked)) AS DOUBLE) / len(asked) AS score
            FROM blocks, templates WHERE len(list_intersect(b, asked)) >= ceil(len(asked) * {THRESHOLD} - 1e-9)),
best AS (SELECT rid, max(score) AS score FROM matches GROUP BY rid),
every AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels
          FROM (SELECT rid, label FROM matches UNION SELECT rid, label FROM places) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       greatest(CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, coalesce(best.score, 0.0::DOUBLE)) AS score
FROM docs LEFT JOIN base ON docs.rid = base.rid LEFT JOIN every ON docs.rid = every.rid LEFT JOIN best ON docs.rid = best.rid"""


def _clustering(rounds: int = 5, k: int = 40, dims: int = 64) -> str:
    """Vectors and centroids as one row per component; a round is an assignment and floored means."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS (SELECT p.rid, c.num, sum((p.x - c.x) * (p.x - c.x)) AS d FROM points p JOIN c{r} c USING (i) GROUP BY p.rid, c.num),
a{r} AS (SELECT rid, arg_min(num, (d, num)) AS num, min(d) AS d FROM d{r} GROUP BY rid),
""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT a.num, p.i, sum(p.x) AS s, count(*) AS n FROM a{r} a JOIN points p USING (rid) GROUP BY a.num, p.i),
c{r + 1} AS (SELECT c.num, c.i, coalesce((s - (s % n + n) % n) // n, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON c.num = m.num AND c.i = m.i),
""")
    return f"""
WITH kept AS (SELECT row_number() OVER () AS rid, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
              FROM embeddings WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dims}),
points AS (SELECT rid, unnest(v) AS x, unnest(generate_series(1, {dims})) AS i FROM kept),
starts AS (SELECT v, row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS num FROM kept QUALIFY num < {k}),
c0 AS (SELECT num, unnest(v) AS x, unnest(generate_series(1, {dims})) AS i FROM starts),
{"".join(steps)}totals AS (SELECT num, sum(d) AS cluster_inertia, sum(sum(d)) OVER () AS inertia FROM a{rounds} GROUP BY num),
digests AS (SELECT num, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY num)
SELECT vec_id, CAST(a.num AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(cluster_inertia AS BIGINT) AS cluster_inertia,
       CAST(inertia AS BIGINT) AS inertia, centroid_sha256
FROM kept JOIN a{rounds} a USING (rid) JOIN totals USING (num) JOIN digests USING (num)"""


OP12 = rf"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
pieces AS (SELECT row_number() OVER () AS rid, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
           FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts)),
starts AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM pieces WHERE len(w) > 0),
grams AS (SELECT lang, m, list_slice(w, i, i + m - 1) AS g, count(*) AS f
          FROM starts, (SELECT unnest(generate_series(1, 5)) AS m) WHERE i + m - 1 <= len(w) GROUP BY lang, m, g),
totals AS (SELECT lang, CAST(sum(f) AS HUGEINT) AS n FROM grams WHERE m = 1 GROUP BY lang),
candidates AS (SELECT * FROM grams WHERE m > 1 AND f >= 100),
cuts AS (SELECT lang, g, m, f, unnest(generate_series(1, m - 1)) AS k FROM candidates),
scored AS (SELECT c.lang, c.g, c.m, c.f AS a, k, x.f AS l, y.f AS r, n,
                  (CAST(1000 AS HUGEINT) * c.f * n) // (CAST(x.f AS HUGEINT) * y.f) AS score
           FROM cuts c JOIN grams x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, k)
                JOIN grams y ON y.lang = c.lang AND y.g = list_slice(c.g, k + 1, c.m) JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_parts AS (SELECT DISTINCT c.lang, list_slice(c.g, i, i + s - 1) AS g, c.f
                FROM (SELECT *, unnest(generate_series(1, m)) AS i FROM candidates) c, (SELECT unnest(generate_series(2, 4)) AS s)
                WHERE s < c.m AND i + s - 1 <= c.m),
kept AS (SELECT * FROM lowest l WHERE NOT EXISTS (
    SELECT 1 FROM inner_parts p WHERE p.lang = l.lang AND p.g = l.g AND 100 * p.f >= 100 * l.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, array_to_string(g, ' ') AS phrase FROM kept) QUALIFY rank <= 2000"""

ORACLE: dict[str, str] = {
    "op3_warc": OP3,
    "op6_license_scan": OP6,
    "op10_decontamination": OP10,
    "op12_collocations": OP12,
    "op13_centroid_clustering": _clustering(),
}
