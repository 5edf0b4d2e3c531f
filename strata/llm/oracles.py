"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, unnest(list_zip(parts, range(len(parts)))) AS part FROM (
        SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT doc_id, part[1] AS line, part[2] AS pos,
        translate(trim(part[1], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), hot AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
    SELECT k.*, h.key IS NOT NULL AND k.doc_id <> h.last AS dropped
    FROM keyed k LEFT JOIN hot h ON k.key = h.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = rf"""
WITH items AS (
    SELECT item_id, words, least(10, len(words)) AS n FROM (
        SELECT item_id, {_WORDS} AS words FROM benchmark) WHERE len(words) > 0
), cuts AS (
    SELECT DISTINCT n, item_id, array_to_string(list_slice(words, i, i + n - 1), ' ') AS cut FROM (
        SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM items)
), docs AS (
    SELECT doc_id, {_WORDS} AS words FROM documents
), starts AS (
    SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
    FROM docs, (SELECT DISTINCT n FROM cuts)
), hits AS (
    SELECT s.doc_id, s.i, s.n, c.item_id FROM (
        SELECT doc_id, n, i, array_to_string(list_slice(words, i, i + n - 1), ' ') AS cut FROM starts) s
    JOIN cuts c USING (n, cut)
), hit_words AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit FROM (
        SELECT doc_id, unnest(range(i, i + n)) AS word FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
        SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


def _mixing(rounds: int = 8) -> str:
    words = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
    lines = "length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), ''))"
    steps, last = [], "rake0"
    for step, dimension in enumerate(["source", "lang", "topic"] * rounds, start=1):
        steps.append(
            f"rake{step} AS (SELECT * REPLACE (w * to_{dimension} / sum(w) OVER (PARTITION BY {dimension}) AS w) FROM {last})"
        )
        last = f"rake{step}"
    return f"""
WITH facts AS (
    SELECT doc_id, source, lang,
        CASE WHEN n = 0 THEN 'empty' WHEN n_lines >= 20 THEN 'listed'
            WHEN n < 100 THEN 'short' ELSE 'prose' END AS topic,
        CAST(n + 1 AS BIGINT) AS tokens
    FROM (SELECT *, {words} AS n, {lines} AS n_lines FROM documents)
), cells AS (
    SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM facts GROUP BY ALL
), rake0 AS (
    SELECT *, tokens AS w, pow(sum(tokens) OVER (PARTITION BY source), 0.85) AS to_source,
        pow(sum(tokens) OVER (PARTITION BY lang), 0.9) AS to_lang,
        pow(sum(tokens) OVER (PARTITION BY topic), 1.0) AS to_topic
    FROM cells
), {", ".join(steps)}, used AS (
    -- The cells that are used up first lead; whichever of them are, the scale is no smaller.
    SELECT *, sum(tokens) OVER (ORDER BY tokens / w, source, lang, topic) AS t,
        sum(w) OVER (ORDER BY tokens / w, source, lang, topic) AS u,
        sum(w) OVER () AS whole, 0.8 * sum(tokens) OVER () AS budget
    FROM {last}
), scale AS (
    SELECT greatest(max(budget / whole), max((budget - t) / (whole - u))
        FILTER (WHERE whole - u > 1e-9 * whole)) AS factor FROM used
), shares AS (
    SELECT source, lang, topic, least(1.0, factor * w / tokens) AS probability FROM used, scale
)
SELECT f.doc_id, f.source, f.lang, f.topic, f.tokens, round(probability, 9) AS probability,
    CAST('0x' || substr(md5(concat_ws('-', 'mix', CAST(doc_id AS VARCHAR))), 1, 13) AS BIGINT)
        / 4503599627370496.0 < probability AS kept
FROM facts f JOIN shares s ON f.source IS NOT DISTINCT FROM s.source
    AND f.lang IS NOT DISTINCT FROM s.lang AND f.topic = s.topic
"""


FILL_IN_MIDDLE = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
        sha256('7:' || CAST(doc_id AS VARCHAR)) AS hexed
    FROM documents
), drawn AS (
    SELECT *, CAST(len(lines) AS BIGINT) AS n,
        CAST('0x' || substr(hexed, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(hexed, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(hexed, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(hexed, 25, 8) AS BIGINT) AS h4
    FROM docs
), cuts AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
            OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT *, array_to_string(lines[1:a], '') AS prefix,
        array_to_string(lines[a + 1:b], '') AS middle, array_to_string(lines[b + 1:], '') AS suffix
    FROM cuts
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle)
        ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), links AS (
    SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reached AS (
    SELECT a AS vec_id, b AS other FROM links
    UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a
), firsts AS (
    SELECT vec_id, min(other) AS other FROM reached GROUP BY 1
), counted AS (
    SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id,
    vec_id = least(vec_id, coalesce(other, vec_id)) AS kept
FROM embeddings LEFT JOIN firsts USING (vec_id) LEFT JOIN counted USING (vec_id)
"""

#: In the given pages the main text is marked up as the article, and three references occur.
HTML_EXTRACTION = r"""
WITH articles AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages
), bare AS (
    SELECT page_id, url, replace(replace(replace(regexp_replace(body, '<[^>]*>', ' ', 'g'),
        '&quot;', '"'), '&amp;', '\x01'), '&amp', '\x01') AS body FROM articles
), shown AS (
    SELECT page_id, url, trim(regexp_replace(replace(body, '\x01', '&'), '\s+', ' ', 'g')) AS text FROM bare
)
SELECT page_id, url, text, length(text) AS n_chars FROM shown
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_line_dedup": LINE_DEDUP,
        "op4_mixing": _mixing(),
        "op7_decontamination": DECONTAMINATION,
        "op9_embedding_dedup": EMBEDDING_DEDUP,
        "op12_fill_in_middle": FILL_IN_MIDDLE,
        "op13_html_extraction": HTML_EXTRACTION,
    }
