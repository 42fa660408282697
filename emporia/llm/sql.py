"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from emporia.llm.licences import DENIED, RULES, SENTENCES, known_forms


def mix_sql(documents: str = "documents", seed: str = "mix") -> str:
    """(doc_id, size, source_size, target, copies) of every document."""
    return rf"""
sized AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM {documents}),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT source, source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM per),
tried AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (ORDER BY source_size * 3 / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY source_size * 3 / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
targets AS (SELECT source, source_size, least(CAST(source_size * 3 AS DOUBLE), max(CASE WHEN source_size * 3 >= level * weight THEN level END) OVER () * weight) AS target FROM tried),
mixed AS (SELECT doc_id, size, source_size, target, CAST(floor(rate) AS BIGINT) + CASE WHEN draw / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END AS copies
    FROM (SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
        CAST(CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(s.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) AS draw
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source))"""


MIX_SQL = f"WITH {mix_sql()} SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed"


def licence_sql() -> str:
    """Sentences end at blank lines and at . ! ? before white space or the end.  Known forms are
    found anywhere in them; a match that takes in a denial before it is dropped."""
    forms = known_forms(SENTENCES)
    known = "MAP {" + ", ".join(f"'{form}': '{name}'" for form, name in forms.items()) + "}"
    denied = DENIED.removeprefix(r"\b")
    found = rf"\b({denied})?({'|'.join(forms)})\b"
    held = ", ".join(f"CASE WHEN contains(joined, '|{'|'.join(ids)}|') THEN '{name}' END" for name, ids in RULES)
    return rf"""
WITH numbered AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
cut AS (SELECT row, unnest(regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '\r\n?', chr(10), 'g'), '\n[ \t\f\x0B]*\n|[.!?]+(?:[\s\x0B]|$)')) AS s,
    generate_subscripts(regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '\r\n?', chr(10), 'g'), '\n[ \t\f\x0B]*\n|[.!?]+(?:[\s\x0B]|$)'), 1) AS place FROM numbered),
normal AS (SELECT row, place, regexp_replace(s, '[^a-z0-9]+', ' ', 'g') AS s FROM cut),
hits AS (SELECT row, place, list_filter(list_zip(regexp_extract_all(s, '{found}', 1), regexp_extract_all(s, '{found}', 2)), lambda x: coalesce(x[1], '') = '') AS hits FROM normal),
ids AS (SELECT row, flatten(list(list_transform(hits, lambda x: {known}[x[2]]) ORDER BY place)) AS ids FROM hits GROUP BY row),
joined AS (SELECT row, array_to_string(ids, '|') AS sentence_ids, '|' || array_to_string(ids, '|') || '|' AS joined FROM ids),
rules AS (SELECT row, sentence_ids, list_filter([{held}], lambda x: x IS NOT NULL) AS held FROM joined)
SELECT doc_id, sentence_ids, array_to_string(list_sort(list_distinct(held)), '|') AS licences, CAST(len(held) AS BIGINT) AS n_rules FROM numbered JOIN rules USING (row)"""


LICENCE_SQL = licence_sql()

SUBSTRING_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM t),
win AS (SELECT doc_id, pos, md5(array_to_string([word, lead(word, 1) OVER d, lead(word, 2) OVER d, lead(word, 3) OVER d, lead(word, 4) OVER d, lead(word, 5) OVER d, lead(word, 6) OVER d,
    lead(word, 7) OVER d, lead(word, 8) OVER d, lead(word, 9) OVER d, lead(word, 10) OVER d, lead(word, 11) OVER d, lead(word, 12) OVER d], ' ')) AS h,
    lead(word, 12) OVER d AS last FROM p WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
firsts AS (SELECT h, min(doc_id) AS first FROM win WHERE last IS NOT NULL GROUP BY h),
gone AS (SELECT DISTINCT win.doc_id, win.pos + k.k AS pos FROM win JOIN firsts USING (h), range(13) k(k) WHERE win.last IS NOT NULL AND firsts.first < win.doc_id),
kept AS (SELECT p.doc_id, count(*) AS n_kept, string_agg(p.word, ' ' ORDER BY p.pos) AS kept FROM p LEFT JOIN gone USING (doc_id, pos) WHERE gone.pos IS NULL GROUP BY p.doc_id)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(len(t.w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)"""

JACCARD_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS g FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM t UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a)
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id FROM t LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)"""

LINES_SQL = r"""
WITH t AS (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13))), lambda x: x <> '') AS l,
    string_split(coalesce(text, ''), chr(10)) AS raw FROM documents),
w AS (SELECT doc_id, i AS pos, k.len, md5(array_to_string(l[i : i + k.len - 1], chr(10))) AS h, len(l) = 1 OR len(regexp_extract_all(l[i], '[^\x20\x09-\x0D]+')) >= 3 AS counts
    FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM t) s, (SELECT CAST(pow(2, range) AS BIGINT) AS len FROM range(16)) k WHERE i + k.len - 1 <= len(l)),
later AS (SELECT doc_id, pos, len, counts FROM (SELECT *, row_number() OVER (PARTITION BY len, h ORDER BY doc_id, pos) AS r FROM w) x WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, pos + j.j AS pos FROM later, range(2) j(j) WHERE len = 2 OR (len = 1 AND counts AND j.j = 0)),
longest AS (SELECT doc_id, max(len) AS len FROM later GROUP BY doc_id),
line AS (SELECT doc_id, i AS place, raw[i] AS line, trim(raw[i], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> '' AS full_line FROM (SELECT doc_id, raw, unnest(range(1, len(raw) + 1)) AS i FROM t)),
ranked AS (SELECT doc_id, place, line, full_line, sum(CASE WHEN full_line THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY place) AS pos FROM line),
kept AS (SELECT r.doc_id, string_agg(line, chr(10) ORDER BY place) AS kept FROM ranked r LEFT JOIN gone g ON g.doc_id = r.doc_id AND g.pos = r.pos AND r.full_line WHERE g.pos IS NULL GROUP BY r.doc_id)
SELECT t.doc_id, CAST(len(t.l) AS BIGINT) AS n_lines, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed, CAST(coalesce(longest.len, 0) AS BIGINT) AS longest_shared, sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM t LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) n USING (doc_id) LEFT JOIN longest USING (doc_id) LEFT JOIN kept USING (doc_id)"""
