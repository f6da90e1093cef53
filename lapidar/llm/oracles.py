"""SQL (DuckDB) of the operators that SQL can express."""

from __future__ import annotations

import string

from lapidar.llm import license_scan, quality_rules, substring_dedup

_WORDS = r"regexp_extract_all({x}, '[^\x20\x09-\x0D]+')"


def dedup_sql(width: int = substring_dedup.WIDTH) -> str:
    return f"""
WITH docs AS (SELECT doc_id, {_WORDS.format(x="coalesce(text, '')")} AS words FROM documents),
windows AS (SELECT doc_id, i, sha256(array_to_string(words[i:i + {width - 1}], ' ')) AS k FROM (SELECT doc_id, words, unnest(range(1, len(words) - {width - 2})) AS i FROM docs WHERE len(words) >= {width})),
first AS (SELECT k, min(doc_id) AS low FROM windows GROUP BY k),
late AS (SELECT doc_id, i FROM windows JOIN first USING (k) WHERE low < doc_id),
gone AS (SELECT DISTINCT doc_id, i + o AS p FROM late, (SELECT unnest(range({width})) AS o)),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM docs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id"""


def rules_sql() -> str:
    widths = sorted({3, *quality_rules.LIMITS})
    parts, names = [], []
    for n in widths:
        same = " AND ".join(f"lead(w, {k}) OVER o IS NOT NULL" for k in (n - 1,))
        gram = ", ' ', ".join(["w", *(f"lead(w, {k}) OVER o" for k in range(1, n))])
        parts.append(f"""
g{n} AS (SELECT doc_id, p, k, count(*) OVER (PARTITION BY doc_id, k) AS times FROM (SELECT doc_id, p, CASE WHEN {same} THEN concat({gram}) END AS k FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY p)) WHERE k IS NOT NULL),
c{n} AS (SELECT doc_id, count(*) AS words, sum(length(w)) AS chars FROM placed SEMI JOIN (SELECT DISTINCT doc_id, p + o AS p FROM g{n}, (SELECT unnest(range({n})) AS o) WHERE times > 1) USING (doc_id, p) GROUP BY doc_id)""")
        names.append(f"LEFT JOIN c{n} ON d.doc_id = c{n}.doc_id")
    bad = " OR ".join(
        [f"n_symbols > {quality_rules.SYMBOL_LIMIT} * n_words", f"dup_line_chars > {quality_rules.LINE_LIMIT} * word_chars"]
        + [f"chars_{n} > {m} * word_chars" for n, m in quality_rules.LIMITS.items()])
    chars = ", ".join(f"coalesce(c{n}.chars, 0) AS chars_{n}" for n in widths)
    failed = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format(x="coalesce(text, '')")} AS words FROM documents),
placed AS (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS p FROM docs),{",".join(parts)},
sizes AS (SELECT doc_id, sum(length(w)) AS word_chars FROM placed GROUP BY doc_id),
lines AS (SELECT doc_id, line, count(*) - 1 AS again, list_sum(list_transform({_WORDS.format(x="line")}, lambda x: length(x))) AS chars FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
WHERE len({_WORDS.format(x="line")}) > 0 GROUP BY doc_id, line),
dup AS (SELECT doc_id, sum(again) AS n_dup_lines, sum(again * chars) AS dup_line_chars FROM lines GROUP BY doc_id),
found AS (SELECT d.doc_id, len(d.words) AS n_words, coalesce(word_chars, 0) AS word_chars, length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(dup_line_chars, 0) AS dup_line_chars, coalesce(c3.words, 0) AS n_repeat_words, {chars}
FROM docs d LEFT JOIN sizes ON d.doc_id = sizes.doc_id LEFT JOIN dup ON d.doc_id = dup.doc_id {" ".join(names)})
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
CAST(n_repeat_words AS BIGINT) AS n_repeat_words, {failed} AS base_failed, NOT ({failed} OR {bad}) AS kept FROM found"""


def licenses_sql(containment: float = license_scan.CONTAINMENT) -> str:
    low = f"translate({{x}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    words = r"regexp_extract_all({x}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    phrases = []
    for phrase, label in license_scan.PHRASES.items():
        w = phrase.split()
        met = " AND ".join([f"w = '{w[0]}'", *(f"w{i} = '{x}'" for i, x in enumerate(w[1:], 1))])
        phrases.append(f"SELECT doc_id, p, '{label}' AS label FROM placed WHERE {met}")
    lists = lambda some: f"[{', '.join(map(repr, some))}]"
    every = license_scan.notices_of(license_scan.TEMPLATES, containment)
    notices = ", ".join(f"({i}, '{x.label}', {lists(x.tokens)}, {lists(x.names)}::VARCHAR[], {x.least}, {x.width}, {lists(x.explained)}::INTEGER[])" for i, x in enumerate(every))
    gap = license_scan.PARAGRAPHS
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, {words.format(x=low.format(x="coalesce(text, '')"))} AS words FROM documents),
placed AS (SELECT doc_id, p, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS p FROM docs) WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
places AS ({" UNION ALL ".join(phrases)}),
base AS (SELECT doc_id, count(*) AS n, min(p) AS first, max(p) AS last, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY doc_id),
notices(template, label, tokens, names, least, width, explained) AS (VALUES {notices}),
blocks AS (SELECT doc_id, wide, block, part, {words.format(x=low.format(x="part"))} AS every FROM (
SELECT doc_id, false AS wide, unnest(range(len(parts))) AS block, unnest(parts) AS part FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM docs) UNION ALL
SELECT doc_id, true, unnest(range(len(parts))), unnest(parts) FROM (SELECT doc_id, regexp_split_to_array(text, '{gap}') AS parts FROM docs)) WHERE NOT wide OR contains(part, chr(10))),
met AS (SELECT doc_id, wide, block, every, template, label, tokens, least, width, explained, len(list_intersect(list_distinct(every), tokens)) AS shared FROM blocks, notices
WHERE list_has_all(every, names) AND len(list_intersect(list_distinct(every), tokens)) >= least),
hits AS (SELECT doc_id, block, template, p, w FROM (SELECT doc_id, block, template, tokens, unnest(range(len(every))) AS p, unnest(every) AS w FROM met WHERE wide) WHERE list_contains(tokens, w)),
tight AS (SELECT doc_id, block, template, max(n) AS shared FROM (SELECT a.doc_id, a.block, a.template, a.p, count(DISTINCT b.w) AS n FROM hits a JOIN met m ON m.wide AND a.doc_id = m.doc_id AND a.block = m.block AND a.template = m.template
JOIN hits b ON a.doc_id = b.doc_id AND a.block = b.block AND a.template = b.template AND b.p BETWEEN a.p AND a.p + m.width - 1 GROUP BY ALL) GROUP BY ALL),
fit AS (SELECT m.doc_id, wide, m.block, m.template, label, explained, CASE WHEN wide THEN t.shared ELSE m.shared END AS n, CASE WHEN wide THEN t.shared ELSE m.shared END / len(tokens) AS share
FROM met m LEFT JOIN tight t ON m.doc_id = t.doc_id AND m.block = t.block AND m.template = t.template WHERE NOT wide OR t.shared >= least),
alike AS (SELECT doc_id, label, share FROM fit x WHERE NOT EXISTS (SELECT 1 FROM fit y WHERE x.doc_id = y.doc_id AND x.wide = y.wide AND x.block = y.block AND list_contains(x.explained, y.template)
AND (y.share > x.share OR y.share = x.share AND y.n > x.n))),
score AS (SELECT doc_id, max(share) AS score FROM alike GROUP BY doc_id),
every AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM alike UNION SELECT doc_id, label FROM places) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base, CAST(base.first AS BIGINT) AS first_word, CAST(base.last AS BIGINT) AS last_word,
coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels, coalesce(score.score, 0.0) AS score
FROM docs d LEFT JOIN base ON d.doc_id = base.doc_id LEFT JOIN every ON d.doc_id = every.doc_id LEFT JOIN score ON d.doc_id = score.doc_id"""


SQL = {"op5_license_scan": licenses_sql(), "op7_substring_dedup": dedup_sql(), "op9_quality_rules": rules_sql()}
