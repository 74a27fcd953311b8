"""DuckDB statements of those queries that SQL can express; written by hand, sharing only the fixed values."""

from __future__ import annotations

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(table: str, key: str) -> str:
    return f"""
    {table}_w AS (SELECT {key}, regexp_extract_all({_LOW}, '[^\\x20\\x09-\\x0D]+') AS w FROM {table}),
    {table}_s AS (
        SELECT DISTINCT {key}, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
        FROM {table}_w)"""


DECONTAMINATION = f"""
WITH {_shingles("documents", "doc_id")}, {_shingles("benchmark", "item_id")},
sizes AS (SELECT item_id, count(*) AS n FROM benchmark_s GROUP BY item_id)
SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_found, count(*) / n AS containment
FROM documents_s JOIN benchmark_s USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n HAVING count(*) >= 0.75 * n
"""

JACCARD = f"""
WITH RECURSIVE {_shingles("documents", "doc_id")},
sizes AS (SELECT doc_id, count(*) AS n, md5(array_to_string(list_sort(list(s)), chr(10))) AS h FROM documents_s GROUP BY doc_id),
classes AS (SELECT h, min(doc_id) AS class_id FROM sizes GROUP BY h),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
    FROM documents_s a JOIN documents_s b ON a.s = b.s AND a.doc_id <> b.doc_id
    WHERE a.doc_id IN (SELECT class_id FROM classes) AND b.doc_id IN (SELECT class_id FROM classes)
    GROUP BY 1, 2),
links AS (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach AS (SELECT class_id AS x, class_id AS y FROM classes UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
parts AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(class_id, doc_id) AS class_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN classes USING (h) LEFT JOIN parts ON x = class_id
"""

_ATTRIBUTE = """
replace(regexp_replace(regexp_extract(tag, '(?is)[\\s"''/]{name}\\s*=\\s*("([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 1),
    '^["'']|["'']$', '', 'g'), '&amp;', '&')"""


def _attribute(name: str) -> str:
    return _ATTRIBUTE.replace("{name}", name)


def _rule(host: str, path: str, what: str) -> str:
    rules = [  # longest first
        ("www.example.com", "/en/", "allow"), ("example.com", "/en/", "block"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
        ("com", "/", "allow"),
    ]
    whens = " ".join(
        f"WHEN ({host} = '{h}' OR ends_with({host}, '.{h}')) AND starts_with({path}, '{p}') THEN '{h + p if what == 'rule' else v}'"
        for h, p, v in rules
    )
    return f"CASE {whens} END"


_HOST = "translate(regexp_extract({0}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({0}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"

URLS = f"""
WITH RECURSIVE p AS (
    SELECT page_id, html, {_HOST.format("coalesce(url, '')")} AS host, {_PATH.format("coalesce(url, '')")} AS path FROM pages),
links AS (SELECT host, path, unnest(regexp_extract_all(html, '(?is)<link\\b[^>]*>')) AS tag FROM p),
metas AS (SELECT host, path, unnest(regexp_extract_all(html, '(?is)<meta\\b[^>]*>')) AS tag FROM p),
targets AS (
    SELECT host, path, trim({_attribute("href")}) AS t FROM links
    WHERE list_contains(string_split_regex(lower({_attribute("rel")}), '\\s+'), 'canonical')
    UNION ALL
    SELECT host, path, trim(regexp_extract({_attribute("content")}, '(?is)url\\s*=\\s*["'']?([^"'']*)', 1)) FROM metas
    WHERE lower({_attribute("http-equiv")}) = 'refresh'),
whole AS (
    SELECT host, host || path AS u, CASE
        WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
        WHEN starts_with(t, '//') THEN 'x:' || t
        WHEN starts_with(t, '/') THEN 'x://' || host || t
        WHEN regexp_matches(t, '^[?#]') THEN 'x://' || host || path
        ELSE 'x://' || host || (CASE WHEN path = '' THEN '/' ELSE regexp_extract(path, '(?s)^(.*/)', 1) END) || t END AS t
    FROM targets WHERE t <> ''),
edges AS (
    SELECT u, {_HOST.format("t")} || {_PATH.format("t")} AS v FROM whole WHERE host <> '' AND {_HOST.format("t")} <> ''),
both_ways AS (SELECT u, v FROM edges WHERE u <> v UNION SELECT v, u FROM edges WHERE u <> v),
reach AS (SELECT u, u AS v FROM both_ways UNION SELECT r.u, b.v FROM reach r JOIN both_ways b ON r.v = b.u),
near AS (
    SELECT u, {_rule("regexp_extract(v, '(?s)^([^/]*)', 1)", "regexp_extract(v, '(?s)^[^/]*(.*)$', 1)", "verdict")} AS verdict FROM reach),
alias AS (SELECT u, min(verdict) AS verdict FROM near WHERE verdict IS NOT NULL GROUP BY u)
SELECT page_id, host, path, {_rule("host", "path", "rule")} AS rule,
    coalesce({_rule("host", "path", "verdict")}, CASE WHEN host <> '' THEN alias.verdict END, 'allow') AS verdict
FROM p LEFT JOIN alias ON alias.u = host || path
"""

_TEMPLATES = """
    (0, true, 'gpl', 'gnu general public license'), (1, true, 'apache', 'apache license'), (2, true, 'cc-by', 'cc by'),
    (3, true, 'mit', 'mit license'),
    (4, false, 'apache-2.0', 'licensed under the apache license version 2 0'),
    (5, false, 'apache-2.0', 'unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind'),
    (6, false, 'gpl-3.0', 'licensed under gnu general public license version 3'),
    (7, false, 'gpl-grant', 'you can redistribute it and or modify it under the terms of the gnu general public license'),
    (8, false, 'cc-by-nc-4.0', 'licensed under cc by nc 4 0'), (9, false, 'cc-by-sa-4.0', 'licensed under cc by sa 4 0'),
    (10, false, 'cc-by-4.0', 'licensed under cc by 4 0'), (11, false, 'mit-notice', 'released under the mit license'),
    (12, false, 'mit-grant', 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files'),
    (13, false, 'bsd-grant', 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met')
"""

LICENSES = f"""
WITH words AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT * FROM (VALUES {_TEMPLATES}) AS v(template, base, label, phrase)),
places AS (
    SELECT template, base, label, len(string_split(phrase, ' ')) - 1 AS size, k AS place, string_split(phrase, ' ')[k + 1] AS a,
        string_split(phrase, ' ')[k + 2] AS b, string_split(phrase, ' ')[1] AS front, string_split(phrase, ' ')[-1] AS final
    FROM t, unnest(range(0, len(string_split(phrase, ' ')) - 1)) AS r(k)),
pairs AS (
    SELECT doc_id, i AS spot, w[i + 1] AS a, w[i + 2] AS b, CASE WHEN i >= 1 THEN w[i] END AS p1, CASE WHEN i >= 2 THEN w[i - 1] END AS p2,
        w[i + 3] AS n1, w[i + 4] AS n2
    FROM words, unnest(range(0, len(w) - 1)) AS r(i)),
matches AS (SELECT *, spot - place AS diagonal FROM pairs JOIN places USING (a, b)),
votes AS (
    SELECT doc_id, template, base, label, size, diagonal, count(DISTINCT place) AS votes, list(DISTINCT place) AS found,
        coalesce(bool_or(place = 1 AND p2 = front), false) AS front_in, coalesce(bool_or(place = 2 AND p1 = front), false) AS front_out,
        coalesce(bool_or(place = size - 2 AND n2 = final), false) AS final_in,
        coalesce(bool_or(place = size - 3 AND n1 = final), false) AS final_out
    FROM matches GROUP BY doc_id, template, base, label, size, diagonal),
whole AS (SELECT doc_id, label, diagonal FROM votes WHERE base AND votes = size),
runs AS (
    SELECT *, coalesce(list_min(list_filter(range(0, size), lambda x: NOT list_contains(found, x))), size) AS head,
        size - 1 - coalesce(list_max(list_filter(range(0, size), lambda x: NOT list_contains(found, x))), -1) AS tail
    FROM votes WHERE NOT base),
edits AS (
    SELECT x.doc_id, x.label, x.diagonal AS start, (x.size - 1) / x.size AS score
    FROM runs x JOIN runs y ON y.doc_id = x.doc_id AND y.template = x.template AND y.diagonal = x.diagonal + 1
    WHERE x.head > 0 AND y.tail > 0 AND x.head + y.tail >= x.size - 1
    UNION ALL SELECT x.doc_id, x.label, x.diagonal, (x.size - 2) / x.size
    FROM runs x JOIN runs y ON y.doc_id = x.doc_id AND y.template = x.template AND y.diagonal = x.diagonal - 1
    WHERE x.head > 0 AND y.tail > 0 AND x.head + y.tail >= x.size - 2
    UNION ALL SELECT doc_id, label, diagonal - 1, (size - 1) / size FROM runs WHERE front_in AND tail >= size - 1
    UNION ALL SELECT doc_id, label, diagonal + 1, (size - 2) / size FROM runs WHERE front_out AND tail >= size - 2
    UNION ALL SELECT doc_id, label, diagonal, (size - 1) / size FROM runs WHERE final_in AND head >= size - 1
    UNION ALL SELECT doc_id, label, diagonal, (size - 2) / size FROM runs WHERE final_out AND head >= size - 2),
varied AS (
    SELECT doc_id, label, score FROM edits e
    WHERE NOT EXISTS (FROM votes v WHERE v.doc_id = e.doc_id AND v.diagonal = e.start AND v.votes = v.size AND NOT v.base)),
marked AS (
    SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= 2 THEN 0 ELSE 1 END AS fresh
    FROM votes WHERE NOT base),
spans AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM marked),
merged AS (
    SELECT s.doc_id, s.template, s.label, s.size, s.span, count(DISTINCT place) / s.size AS score
    FROM spans s JOIN matches q ON q.doc_id = s.doc_id AND q.template = s.template AND q.diagonal = s.diagonal
    GROUP BY s.doc_id, s.template, s.label, s.size, s.span HAVING count(DISTINCT place) / s.size >= 0.85),
named AS (
    SELECT doc_id, label, true AS base, 1.0 AS score FROM whole UNION ALL SELECT doc_id, label, false, score FROM merged
    UNION ALL SELECT doc_id, label, false, score FROM varied),
per_doc AS (
    SELECT doc_id, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels,
        array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE base)), ',') AS base_labels, max(score) AS score
    FROM named GROUP BY doc_id),
base AS (SELECT doc_id, count(*) AS n, min(diagonal) AS low, max(diagonal) AS high FROM whole GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, low AS first_word, high AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(CAST(score AS DOUBLE), 0.0) AS score
FROM words LEFT JOIN per_doc USING (doc_id) LEFT JOIN base USING (doc_id)
"""

NEIGHBOURS = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (
    SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(e, lambda x: x <> 0)) > 0),
s AS (
    SELECT q.vec_id AS query_id, r.vec_id, greatest(-1.0, least(1.0, list_dot_product(q.e, r.e) / sqrt(list_dot_product(q.e, q.e) * list_dot_product(r.e, r.e)))) AS score
    FROM u q JOIN u r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

#: crc32 by its table of 256 entries; `_crc(hex)` is the unsigned sum over the bytes that a hex text spells.
_CRC_TABLE = """list_transform(range(256), lambda b: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b))"""


def _crc(text: str) -> str:
    return f"""xor(list_reduce(list_transform(range(0, length(hex({text})) // 2), lambda i: CAST('0x' || substring(hex({text}), 2 * i + 1, 2) AS BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""


VARIANTS = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS t),
raw AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')) AS run FROM documents),
runs AS (
    SELECT concat(doc_id, ':', translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS named,
        translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
    FROM raw GROUP BY ALL),
hashed AS (SELECT run, k, {_crc("named")} AS h FROM runs, crc),
lost AS (
    SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed),
vocabulary AS (
    SELECT word, CAST(sum(k) AS BIGINT) AS n, CAST(length(word) AS BIGINT) AS l FROM lost WHERE length(word) >= 7
    GROUP BY word HAVING sum(k) >= 2),
cut AS (SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS rest FROM (SELECT *, unnest(range(l)) AS i FROM vocabulary)),
near AS (
    SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN vocabulary b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN vocabulary b ON a.rest = b.word),
ranked AS (
    SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near,
        row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS k FROM near),
formed AS (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
    FROM vocabulary v LEFT JOIN ranked r ON r.word = v.word AND r.k = 1),
up AS (
    SELECT word, word AS root FROM formed
    UNION ALL SELECT u.word, f.form FROM up u JOIN formed f ON f.word = u.root WHERE f.form IS NOT NULL),
roots AS (SELECT u.word, u.root FROM up u JOIN formed f ON f.word = u.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""

CHAT = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
    SELECT *, length(role) + length(text)
        + len(regexp_extract_all(role || ' ' || text, '\\\\|</?s>|\\[/?INST\\]')) + length('[INST][/INST]</s>') AS chars
    FROM said)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) + length('<s>') AS formatted_chars
FROM sized GROUP BY conv_id
"""

TRIE = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS t),
own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id),
convs AS (
    SELECT a.conv_id, h, a.conv_id - a.conv_id % 20 AS base, least(h, coalesce(b.n, 0)) AS taken
    FROM (SELECT *, {_crc("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM sizes, crc) a LEFT JOIN sizes b ON b.conv_id = a.conv_id - a.conv_id % 20),
turns AS (
    SELECT c.conv_id, o.place AS depth, role, text FROM convs c JOIN own o ON o.conv_id = c.base AND o.place <= c.h
    UNION ALL SELECT c.conv_id, o.place - h + taken, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.place > c.h),
steps AS (
    SELECT conv_id, depth, list({{'role': role, 'text': text}}) OVER w AS said, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)),
keyed AS (
    SELECT conv_id, depth, md5(CAST(said AS VARCHAR)) AS node, lag(md5(CAST(said AS VARCHAR)), 1, 'root') OVER (PARTITION BY conv_id ORDER BY depth) AS parent, words
    FROM steps UNION ALL SELECT conv_id, 0, 'root', NULL, 0 FROM convs),
nodes AS (
    SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(words) AS words, count(*) AS n_convs, min(conv_id) AS conv_id
    FROM keyed GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n FROM nodes GROUP BY parent),
full_nodes AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (node)),
below AS (
    SELECT a.node, sum((b.n_children = 0)::INT) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved
    FROM (SELECT DISTINCT u.node, d.node AS under FROM keyed u JOIN keyed d ON d.conv_id = u.conv_id AND d.depth >= u.depth) a
    JOIN full_nodes b ON b.node = a.under GROUP BY a.node),
last AS (SELECT conv_id, node FROM keyed QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)),
ended AS (SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS h FROM last GROUP BY node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
    CAST(saved AS BIGINT) AS saved_tokens, coalesce(h, sha256('')) AS ends_sha256
FROM full_nodes n JOIN below USING (node) LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN ended e ON e.node = n.node
"""

ORACLES = {
    "op11_spelling_variants": VARIANTS,
    "op12_chat_formatting": CHAT,
    "op13_conversation_trie": TRIE,
    "op1_benchmark_decontamination": DECONTAMINATION,
    "op4_ngram_jaccard_join": JACCARD,
    "op6_url_filters": URLS,
    "op9_license_scans": LICENSES,
    "op10_nearest_neighbours": NEIGHBOURS,
}
