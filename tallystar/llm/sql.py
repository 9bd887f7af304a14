"""SQL (DuckDB) for the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Votes in the order of the rules; b and g say when a rule calls a document bad and good.
_RULES = [
    ("n_symbols * 10 > n", "n_symbols * 50 <= n"),
    ("n_repeat_words * 4 > n", "n_repeat_words * 10 <= n"),
    ("n_dup_lines * 10 > n_lines * 3", "n_dup_lines = 0 AND n_lines > 2"),
    ("word_chars < 3 * n OR word_chars > 12 * n", "word_chars BETWEEN 4 * n AND 9 * n"),
    ("n_capitals * 5 > word_chars", "n_capitals * 20 <= word_chars"),
    ("n_stops * 100 < n", "n_stops * 40 >= n"),
    ("n_marks * 10 > n", "n_marks * 50 <= n"),
    ("n_letters * 10 < word_chars * 9", "n_letters * 100 >= word_chars * 94"),
]
_VOTES = ", ".join(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END" for bad, good in _RULES)

_POSTERIOR = """1 / (1 + exp(-(ln(share / (1 - share)) + list_sum(list_transform(range(1, 9), lambda j:
    CASE x.v[j] WHEN 1 THEN ln(good[j] / (1 - bad[j])) WHEN -1 THEN ln((1 - good[j]) / bad[j]) ELSE 0 END)))))"""


def _weight(vote: int, good: bool) -> str:
    part = "x.q" if good else "(1 - x.q)"
    return f"list_sum(list_transform(s, lambda x: CASE WHEN x.v[j] = {vote} THEN x.n * {part} ELSE 0 END))"


OP1 = rf"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS l
    FROM documents
),
grams AS (
    SELECT rid, k, count(*) OVER (PARTITION BY rid, w[k], w[k + 1], w[k + 2]) AS c
    FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS k FROM d)
),
repeats AS (
    SELECT rid, count(DISTINCT k + j) AS n FROM grams, range(0, 3) AS r(j) WHERE c > 1 GROUP BY rid
),
f AS (
    SELECT rid, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
        len(l) AS n_lines, greatest(len(w), 1) AS n,
        length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
        length(t) - length(regexp_replace(t, '\p{{L}}', '', 'g')) AS n_letters,
        length(t) - length(replace(t, '.', '')) AS n_stops,
        length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS n_marks
    FROM d LEFT JOIN repeats USING (rid)
),
voted AS (SELECT *, [{_VOTES}] AS votes FROM f),
p AS (
    SELECT list({{'v': votes, 'n': n}} ORDER BY votes) AS p
    FROM (SELECT votes, count(*)::DOUBLE AS n FROM voted GROUP BY votes)
),
em(i, share, good, bad) AS (
    SELECT 0, 0.8::DOUBLE, list_transform(range(8), lambda j: 0.99::DOUBLE), list_transform(range(8), lambda j: 0.2::DOUBLE)
    UNION ALL
    SELECT i, share, good, list_transform(range(1, 9), lambda j: greatest(bad[j], 1 - good[j])) FROM (
        SELECT i,
            (list_sum(list_transform(s, lambda x: x.n * x.q)) + 4) / (list_sum(list_transform(s, lambda x: x.n)) + 5) AS share,
            list_transform(range(1, 9), lambda j: ({_weight(1, True)} + 5 * 0.99) / ({_weight(1, True)} + {_weight(-1, True)} + 5)) AS good,
            list_transform(range(1, 9), lambda j: ({_weight(-1, False)} + 5 * 0.2) / ({_weight(-1, False)} + {_weight(1, False)} + 5)) AS bad
        FROM (
            SELECT i + 1 AS i, list_transform(p, lambda x: {{'v': x.v, 'n': x.n, 'q': {_POSTERIOR}}}) AS s
            FROM em, p WHERE i < 40
        )
    )
),
final AS (
    SELECT x.v AS votes, {_POSTERIOR} AS p_good
    FROM (SELECT share, good, bad, unnest(p) AS x FROM em, p WHERE i = 40)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND p_good >= 0.5 AS kept
FROM voted JOIN final USING (votes)
"""

OP5 = rf"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
),
windows AS (
    SELECT rid, doc_id, k, array_to_string(w[k:k + 49], ' ') AS p
    FROM (SELECT *, unnest(range(1, len(w) - 48)) AS k FROM d)
),
found AS (
    SELECT rid, k FROM (SELECT *, min(doc_id) OVER (PARTITION BY p) AS least FROM windows) WHERE least < doc_id
),
gone AS (SELECT DISTINCT rid, k + j AS k FROM found, range(0, 50) AS r(j)),
rest AS (
    SELECT rid, count(gone.k) AS n_removed, string_agg(word, ' ' ORDER BY k) FILTER (WHERE gone.k IS NULL) AS kept
    FROM (SELECT rid, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word FROM d) LEFT JOIN gone USING (rid, k)
    GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN rest USING (rid)
"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP9 = rf"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce({LOWER}, ''), '{_ALNUM}') AS w FROM documents
),
phrases AS (
    SELECT DISTINCT item, len(w[k:k + 9]) AS n, array_to_string(w[k:k + 9], ' ') AS p
    FROM (
        SELECT item_id::VARCHAR AS item, w, unnest(range(1, greatest(2, len(w) - 8))) AS k
        FROM (SELECT item_id, regexp_extract_all(coalesce({LOWER}, ''), '{_ALNUM}') AS w FROM benchmark) WHERE len(w) > 0
    )
),
windows AS (
    SELECT rid, n, k, array_to_string(w[k:k + n - 1], ' ') AS p
    FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM phrases))
),
found AS (SELECT rid, n, k, item FROM windows JOIN phrases USING (n, p)),
hits AS (SELECT rid, count(DISTINCT k + j) AS n_hit FROM (SELECT rid, k, unnest(range(0, n)) AS j FROM found) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
"""

OP11 = rf"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce({LOWER}, ''), '{WORD}') AS w FROM documents
),
grams AS (
    SELECT rid, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k:k + 3], ' ')) END)) AS s
    FROM d
),
sets AS (SELECT min(doc_id) AS id, s FROM grams WHERE len(s) > 0 GROUP BY s),
t AS (SELECT id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
    SELECT a.id AS a, b.id AS b, a.n AS n, b.n AS m, count(*) AS c FROM t AS a JOIN t AS b ON a.x = b.x AND a.id <> b.id GROUP BY ALL
),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 85 * (n + m - c)),
reach(id, least) AS (
    SELECT id, id FROM sets UNION SELECT b, least FROM reach JOIN links ON id = a
),
named AS (SELECT id, min(least) AS component FROM reach GROUP BY id)
SELECT g.doc_id, len(g.s) AS n_shingles, coalesce(named.component, g.doc_id) AS component_id
FROM grams AS g LEFT JOIN sets ON g.s = sets.s LEFT JOIN named ON named.id = sets.id
"""

OP12 = """
WITH v AS (
    SELECT row_number() OVER () AS rid, vec_id AS id,
        CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
),
s AS (
    SELECT a.rid, a.id AS anchor_id, a.label = b.label AS same, b.id, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM v AS a JOIN v AS b ON a.rid <> b.rid WHERE a.id % 100 = 0
),
p AS (
    SELECT rid, anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY rid ORDER BY score DESC, id) AS turn
    FROM s WHERE same QUALIFY turn <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.rid, turn ORDER BY s.score DESC, s.id)::INTEGER AS rank,
    s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON p.rid = s.rid AND NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
"""

OP13 = """
WITH RECURSIVE runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
            '[A-Za-zÀ-ÿ]+')) AS run FROM documents
    ) WHERE length(run) >= 7 GROUP BY ALL
),
crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
),
hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda x:
            CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + (unicode(x)::BIGINT >> 6), 128 + (unicode(x)::BIGINT & 63)] END)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) AS h
    FROM runs, crc
),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
    ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
cut AS (
    SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
),
near AS (
    SELECT DISTINCT cut.word AS a, words.word AS b FROM cut JOIN words ON cut.rest = words.word
    UNION SELECT words.word, cut.word FROM cut JOIN words ON cut.rest = words.word
    UNION SELECT x.word, y.word FROM cut AS x JOIN cut AS y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
),
best AS (
    SELECT a, count(*) AS n_near, arg_min(b, {'n': -n, 'b': b}) AS b, max(n) AS form_n FROM near JOIN words ON words.word = b GROUP BY a
),
formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN b END AS form, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
    FROM words LEFT JOIN best ON a = word
),
follow(word, root, i) AS (
    SELECT word, word, 0 FROM formed UNION ALL
    SELECT follow.word, formed.form, i + 1 FROM follow JOIN formed ON formed.word = follow.root WHERE formed.form IS NOT NULL
),
roots AS (SELECT word, arg_max(root, i) AS root FROM follow GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op5_repeat_removal": OP5,
    "op9_decontamination": OP9,
    "op11_ngram_jaccard_join": OP11,
    "op12_hard_negatives": OP12,
    "op13_spelling_variants": OP13,
}
