"""The native operators once more, as SQL over the given tables.

Patterns and steps are repeated here on purpose: SQL that took them from the operators
would share their mistakes. Only the phrases and templates are the operators' own.
"""

from orderlake.llm.license_scan import BASE_PHRASES, TEMPLATES

_SPACE = r"[ \x09-\x0D]+"

QUALITY_RULES = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), worded AS (
    SELECT *, list_filter(string_split_regex(text, '{_SPACE}'), lambda x: x <> '') AS w FROM docs
), windows AS (
    SELECT r, i, array_to_string(w[i : i + 7], ' ') AS said
    FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM worded WHERE len(w) >= 8)
), twice AS (
    SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, said) > 1
), repeated AS (
    SELECT r, count(DISTINCT p) AS n
    FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r
), lines AS (
    SELECT r, line, length(regexp_replace(line, '{_SPACE}', '', 'g')) AS chars,
           list_filter(string_split_regex(line, '{_SPACE}'), lambda x: x <> '') AS words,
           len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
           len(regexp_extract_all(line, '[!?]{{2,}}')) AS cries,
           len(regexp_extract_all(line, '[|»›•]')) AS bars
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
), judged AS (
    SELECT *, chars > 0 AND (
        symbols > 2 AND 100 * symbols > 10 * chars
        OR cries > 2 AND 5 * cries >= len(words)
        OR bars > 2 AND 3 * bars >= len(words)
        OR len(words) <= 4 AND NOT regexp_matches(line, '[.!?:;,)"''…]$') AND regexp_matches(line,
            '(?i)\b(home|menu|login|log in|sign in|sign up|search|next|previous|share|subscribe|contact us|about us|sitemap|back to top|read more|skip to content)\b')
        OR len(words) >= 12 AND 4 * len(list_distinct(words)) <= len(words)
        OR regexp_matches(line,
            '(?i)(cookie policy|uses cookies|privacy policy|terms of (use|service)|enable javascript|lorem ipsum|subscribe to our newsletter|click here to)')
    ) AS fails
    FROM lines
), by_line AS (
    SELECT r, count(*) FILTER (chars > 0) - count(DISTINCT line) FILTER (chars > 0) AS n_dup_lines,
           count(*) FILTER (fails) AS n_lines_removed,
           coalesce(sum(chars) FILTER (fails), 0)::BIGINT AS lost_chars
    FROM judged GROUP BY r
), counted AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, n_dup_lines,
           coalesce(n, 0) AS n_repeat_words, n_lines_removed, lost_chars
    FROM worded JOIN by_line USING (r) LEFT JOIN repeated USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       n_lines_removed, lost_chars,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * lost_chars > 30 * word_chars) AS kept
FROM counted
"""


def _words(text: str) -> str:
    return "[" + ", ".join(f"'{word}'" for word in text.split()) + "]"


_TEMPLATES = ",\n".join(
    f"({i}, '{label}', {_words(notice)}, {_words(phrase)})"
    for i, (label, notice, phrase) in enumerate(TEMPLATES)
)
_BASE = ",\n".join(f"('{label}', {_words(phrase)})" for label, phrase in BASE_PHRASES)

LICENSE_SCAN = rf"""
WITH templates(t, label, notice, phrase) AS (VALUES
{_TEMPLATES}
), base(label, phrase) AS (VALUES
{_BASE}
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM documents
), notices AS (
    SELECT t, word, p - 1 AS p FROM (
        SELECT t, unnest(notice) AS word, unnest(range(1, len(notice) + 1)) AS p FROM templates)
), places AS (
    SELECT r, word, i - 1 AS i FROM (
        SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs)
    WHERE word IN (SELECT word FROM notices)
), frequency AS (
    SELECT word, count(DISTINCT r) AS n FROM places GROUP BY word
), possible AS (
    SELECT r, t FROM docs JOIN templates ON list_has_all(w, phrase)
), rare AS (
    SELECT r, t, word
    FROM possible JOIN (SELECT DISTINCT t, word FROM notices) USING (t)
    JOIN (SELECT DISTINCT r, word FROM places) USING (r, word) JOIN frequency USING (word)
    QUALIFY row_number() OVER (PARTITION BY r, t ORDER BY n, word) <= 2
), beginnings AS (
    SELECT DISTINCT r, t, i - p AS o
    FROM rare JOIN places USING (r, word) JOIN notices USING (t, word)
), verified AS (
    SELECT r, label, len(list_filter(range(1, len(notice) + 1),
               lambda i: o + i >= 1 AND w[o + i] = notice[i]))::DOUBLE / len(notice) AS share
    FROM beginnings JOIN docs USING (r) JOIN templates USING (t)
    WHERE len(list_filter(range(1, len(notice) - len(phrase) + 2), lambda i:
        notice[i : i + len(phrase) - 1] = phrase AND o + i >= 1
        AND w[o + i : o + i + len(phrase) - 1] = phrase)) > 0
), more AS (
    SELECT r, list(label) AS labels, max(share) AS share FROM verified WHERE share >= 0.5 GROUP BY r
), stood AS (
    SELECT r, label, i FROM (
        SELECT r, w, label, phrase, unnest(range(1, len(w) + 1)) AS i
        FROM docs JOIN base ON list_has_all(w, phrase))
    WHERE w[i : i + len(phrase) - 1] = phrase
), based AS (
    SELECT r, count(*) AS n, min(i) - 1 AS first_word, max(i) - 1 AS last_word, list(label) AS labels
    FROM stood GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(list_distinct(based.labels)), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(
           list_concat(coalesce(based.labels, []), coalesce(more.labels, [])))), ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM docs LEFT JOIN based USING (r) LEFT JOIN more USING (r)
"""

SOURCE_AUDIT = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), words AS (
    SELECT r, lang, source,
           unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
), counts AS (
    SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS d FROM words GROUP BY ALL
), kept AS (
    SELECT lang, term, sum(n) AS n_lang FROM counts GROUP BY lang, term HAVING sum(d) >= 3
), langs AS (
    SELECT lang, count(*) AS v, sum(n_lang) AS n_all FROM kept GROUP BY lang
), kept_counts AS (
    SELECT lang, source, term, n FROM counts SEMI JOIN kept USING (lang, term)
), groups AS (
    SELECT lang, source, coalesce(sum(n), 0) AS n_source
    FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN kept_counts USING (lang, source)
    GROUP BY lang, source
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n_source + l.v) AS p,
           1 + (1000000000::HUGEINT * (k.n_lang + 1)) // (l.n_all + l.v) AS q
    FROM groups g JOIN langs l ON l.lang = g.lang JOIN kept k ON k.lang = g.lang
    LEFT JOIN kept_counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY ALL
), pairs AS (
    SELECT x.lang, x.source, y.source AS item, coalesce(s.value, 0) AS value
    FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
    LEFT JOIN sums s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
), both_parts AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM both_parts
QUALIFY part = 'pair' OR rank <= 200
"""

HARD_NEGATIVES = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
           list_dot_product(a.v, r.v)::BIGINT AS score
    FROM whole a JOIN whole r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
