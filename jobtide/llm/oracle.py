"""The queries of this subpackage as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from jobtide.llm import license, secrets

ORACLE: dict[str, str] = {}

ORACLE["op6_mixing"] = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, count(*) FILTER (WHERE size > 0) AS source_docs,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 2.0 ELSE 3.0 END AS weight
    FROM d GROUP BY source
), b AS (SELECT *, source_size * 3.0::DOUBLE AS bound FROM s), r AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(bound) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
        row_number() OVER w AS nth
    FROM b WINDOW w AS (ORDER BY bound / weight, source NULLS LAST)
), t AS (
    SELECT source, source_size, source_docs,
        least(bound, weight * (SELECT min_by(level, nth) FROM r WHERE level * weight <= bound)) AS target
    FROM r
), f AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t
), g AS (
    SELECT *, CASE WHEN whole >= 3 THEN 0.0::DOUBLE ELSE target - whole * source_size END AS rest FROM f
), o AS (
    SELECT *, rest / source_size / (1 - rest / source_size) / (source_size::DOUBLE / source_docs) AS odds FROM g
), u AS (
    SELECT doc_id, source, size, (('0x' || substr(md5('0:' || doc_id), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u FROM d
), k AS (
    SELECT u.source, size, rest, u / (1 - u) / (odds * size) AS rank FROM u JOIN o ON u.source IS NOT DISTINCT FROM o.source
    WHERE size > 0 AND rest > 0
), c AS (SELECT source, rank, rest, sum(size) AS together FROM k GROUP BY ALL), e AS (
    SELECT *, sum(together) OVER (PARTITION BY source ORDER BY rank ROWS UNBOUNDED PRECEDING) AS upto FROM c
), x AS (
    SELECT source, max(rank) AS cut FROM e WHERE upto - together / 2 <= rest GROUP BY source
)
SELECT u.doc_id, u.size, o.source_size, o.target,
    CASE WHEN size = 0 THEN 0 ELSE (whole + CASE WHEN u / (1 - u) / (odds * size) <= cut THEN 1 ELSE 0 END) * size END::BIGINT AS taken
FROM u JOIN o ON u.source IS NOT DISTINCT FROM o.source LEFT JOIN x ON u.source IS NOT DISTINCT FROM x.source
"""


def _found(rule: secrets.Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
    SELECT doc_id, '{rule.kind}' AS kind, {secrets.RULES.index(rule)} AS nth,
        list_transform(range(1, len(m) + 1), lambda i: list_sum(list_transform(b[:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: len(x))), 0)) AS s,
        m, g
    FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '{pattern}') AS b,
        regexp_extract_all(coalesce(text, ''), '{pattern}', 0) AS m, regexp_extract_all(coalesce(text, ''), '{pattern}', {rule.group}) AS g FROM documents)"""


_LEAST = " ".join(f"WHEN '{r.kind}' THEN {r.least}" for r in secrets.RULES)
_KINDS = ", ".join(f"'{r.kind}'" for r in secrets.BASE)

ORACLE["op8_secret_scans"] = f"""
WITH f AS ({" UNION ALL ".join(_found(r) for r in secrets.RULES)}), p AS (
    SELECT doc_id, kind, nth, unnest(s) AS s, unnest(m) AS m, unnest(g) AS g FROM f
), q AS (
    SELECT doc_id, kind, nth, s, kind || ':' || s::BIGINT || ':' || (s + len(m))::BIGINT AS t FROM p WHERE len(g) >= CASE kind {_LEAST} END
), a AS (
    SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)},
        string_agg(t, ',' ORDER BY s, nth) FILTER (WHERE kind IN ({_KINDS})) AS base, string_agg(t, ',' ORDER BY s, nth) AS spans
    FROM q GROUP BY doc_id
)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN a USING (doc_id)
"""

_quoted = lambda s: "'" + s.replace("'", "''") + "'"
_TABLE = ", ".join(f"({_quoted(s)}, {_quoted(i)})" for s, i in license.known(license.SENTENCES).items())
_MATCHED = "SELECT doc_id, n_sentences, sentence_ids, '' AS found, ',' || replace(sentence_ids, ',', ',,') || ',' AS seq FROM ids"
for _name, _seq in license.RULES:
    _part = _quoted("," + ",,".join(_seq) + ",")
    _MATCHED = f"""SELECT doc_id, n_sentences, sentence_ids, replace(seq, {_part}, '') AS seq, CASE WHEN contains(seq, {_part})
        AND NOT contains(found, ',{_name},') THEN found || ',{_name},' ELSE found END AS found FROM ({_MATCHED})"""

ORACLE["op2_license_scans"] = rf"""
WITH known(s, id) AS (VALUES {_TABLE}), parts AS (
    SELECT doc_id, unnest(p) AS s, unnest(range(len(p))) AS i
    FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '{license.ENDS}') AS p FROM documents)
), plain AS (
    SELECT doc_id, i, lower(trim(regexp_replace(s, '{license.SIGNS}', ' ', 'g'))) AS s FROM parts
), hits AS (
    SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY i) AS ids FROM plain JOIN known USING (s) GROUP BY doc_id
), ids AS (
    SELECT doc_id, coalesce(n, 0) AS n_sentences, coalesce(ids, '') AS sentence_ids FROM documents LEFT JOIN hits USING (doc_id)
), m AS ({_MATCHED})
SELECT doc_id, n_sentences, sentence_ids, trim(replace(found, ',,', ','), ',') AS licences,
    trim(replace(seq, ',,', ','), ',') AS unmatched
FROM m
"""

ORACLE["op4_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents), t AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d
), s AS (
    SELECT doc_id, i, word, CASE WHEN count(*) OVER f = 50 THEN md5(string_agg(word, ' ') OVER f) END AS h FROM t
    WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
), m AS (SELECT h, min(doc_id) AS least FROM s WHERE h IS NOT NULL GROUP BY h), f AS (
    SELECT doc_id, i, word, coalesce(least < doc_id, false) AS starts FROM s LEFT JOIN m USING (h)
), g AS (
    SELECT doc_id, i, word, bool_or(starts) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM f
), k AS (
    SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM g GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


ORACLE["op13_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), g AS (
    SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(list_zip(w, w[2:], w[3:], w[4:], true), lambda x: x[1] || ' ' || x[2] || ' ' || x[3] || ' ' || x[4])) END AS g FROM w
), n AS MATERIALIZED (SELECT doc_id, len(g)::BIGINT AS n FROM g), s AS MATERIALIZED (SELECT doc_id, hash(unnest(g)) AS s FROM g),
shared AS MATERIALIZED (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS MATERIALIZED (
    SELECT l.a, l.b FROM (SELECT a, b, c FROM shared UNION ALL SELECT b, a, c FROM shared) l
        JOIN n p ON p.doc_id = l.a JOIN n q ON q.doc_id = l.b WHERE 100 * c >= 85 * (p.n + q.n - c)
), reach(a, b) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT n.doc_id, n.n AS n_shingles, c.component_id FROM n JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = n.doc_id
"""

ORACLE["op11_spelling_variants"] = r"""
WITH RECURSIVE t AS (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM (SELECT unnest(range(256)) AS i)
), d AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS k, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{6,}')) AS w FROM documents) GROUP BY ALL
), h AS (
    SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(k || ':' || w, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))),
        lambda c, b: xor(c >> 8, t.t[xor(c & 255, b) + 1]))) AS h
    FROM d, t
), v AS MATERIALIZED (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), x AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)
), p AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM x a JOIN x b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT x.word, v.word, v.n FROM x JOIN v ON v.word = x.rest
    UNION SELECT v.word, x.word, x.n FROM x JOIN v ON v.word = x.rest
), g AS (
    SELECT word, count(*) AS c, min(struct_pack(n := -other_n, o := encode(other))) AS b FROM p GROUP BY word
), f AS MATERIALIZED (
    SELECT v.word, CASE WHEN -g.b.n >= 5 * v.n THEN decode(g.b.o) END AS form, v.n, coalesce(g.c, 0)::BIGINT AS n_near,
        CASE WHEN -g.b.n >= 5 * v.n THEN (-g.b.n)::BIGINT END AS form_n FROM v LEFT JOIN g ON g.word = v.word
), r AS (
    SELECT word, word AS root FROM f UNION ALL SELECT r.word, f.form FROM r JOIN f ON f.word = r.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM f JOIN (SELECT r.word, r.root FROM r JOIN f ON f.word = r.root WHERE f.form IS NULL) r ON r.word = f.word
"""
