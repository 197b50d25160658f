"""The queries of this subpackage as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from offerlens.llm import licenses

_SPACE = r"[\x20\x09-\x0D]+"

EXACT = rf"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g') AS clean FROM documents
), groups AS (
    SELECT clean, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY clean
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(clean) AS text_sha256
FROM texts JOIN groups USING (clean)
"""


#: roles are rendered as they are where nothing conflicts; the escape adds a backslash to each ``<`` ``|`` pair
CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, i, role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, role)
), sized AS (
    SELECT *,
        contains(text, '<|im_start|>') OR contains(text, '<|im_end|>') OR regexp_matches(text, '<\\+\|')
            OR contains(role, '<|im_start|>') OR contains(role, '<|im_end|>') OR contains(role, chr(10))
            OR contains(role, chr(92)) AS conflict,
        length(replace(replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n'), '|', chr(92) || 'p'))
            + length(regexp_replace(text, '<(\\*)\|', '<\1_|', 'g')) AS escaped_chars
    FROM turns
)
SELECT
    conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(CASE WHEN bool_or(conflict) THEN sum(escaped_chars) ELSE sum(length(role) + length(text)) END
        + 24 * count(*) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


_GRAMS = ", ".join(f"({t}, {i}, '{g}')" for t, i, g in licenses.template_rows())
_NAMES = ", ".join(
    f"({i}, {len(p.split()) - 1}, '{label}')"
    for i, (p, label) in enumerate([*licenses.PHRASES.items(), *licenses.NOTICES.items()])
)
LICENSES = rf"""
WITH grams(template, pos, known) AS (VALUES {_GRAMS}), names(template, n, label) AS (VALUES {_NAMES}),
texts AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '{licenses.WORD}') AS words
    FROM documents
), places AS (
    SELECT doc_id, words, unnest(range(1, len(words))) AS i FROM texts
), votes AS (
    SELECT doc_id, template, i - 1 - pos AS diagonal, bit_or(1::BIGINT << pos) AS bits
    FROM places JOIN grams ON words[i] || ' ' || words[i + 1] = known AND template >= 0 GROUP BY ALL
), steps AS (
    SELECT *, CASE WHEN diagonal - lag(diagonal) OVER w > {licenses.REACH} THEN 1 ELSE 0 END AS apart
    FROM votes WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal)
), runs AS (
    SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM steps
), spans AS (
    SELECT doc_id, template, label, bit_count(bit_or(bits)) / n AS share,
        count(*) FILTER (WHERE bit_count(bits) = n) AS places,
        min(diagonal) FILTER (WHERE bit_count(bits) = n) AS first_word,
        max(diagonal) FILTER (WHERE bit_count(bits) = n) AS last_word,
        template < {len(licenses.PHRASES)} AS base
    FROM runs JOIN names USING (template) GROUP BY doc_id, template, label, n, span
)
SELECT
    doc_id, any_value(len(words)) AS n_words,
    CAST(coalesce(sum(places) FILTER (WHERE base), 0) AS BIGINT) AS n_base,
    min(first_word) FILTER (WHERE base) AS first_word,
    max(last_word) FILTER (WHERE base) AS last_word,
    coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE base AND places > 0))), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (
        WHERE CASE WHEN base THEN places > 0 ELSE share >= {licenses.SHARE} END))), ','), '') AS labels,
    coalesce(max(share), 0)::DOUBLE AS score
FROM texts LEFT JOIN spans USING (doc_id) GROUP BY doc_id
"""

TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * x::DOUBLE) AS BIGINT)) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[]) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 20
"""

PHRASES = r"""
WITH texts AS (
    SELECT row_number() OVER () AS i, coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), pieces AS (
    SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\n\x0B\f\r]')) AS piece FROM texts
), lines AS (
    SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM lines GROUP BY lang
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lines
), grams AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
    FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)
), counts AS (
    SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), longer AS (
    SELECT lang, phrase, string_split(phrase, ' ') AS w, k, f FROM counts WHERE k > 1
), held AS (
    SELECT lang, phrase, max(f) AS most FROM (
        SELECT lang, array_to_string(w[1 : k - 1], ' ') AS phrase, f FROM longer
        UNION ALL SELECT lang, array_to_string(w[2 : k], ' '), f FROM longer
    ) GROUP BY ALL
), cuts AS (
    SELECT x.lang, x.phrase, x.f, x.w, x.k, unnest(range(1, x.k)) AS cut
    FROM longer x LEFT JOIN held h ON h.lang = x.lang AND h.phrase = x.phrase WHERE coalesce(h.most, 0) < x.f
), scored AS (
    SELECT c.lang, c.phrase, c.cut, c.f AS a, x.f AS l, y.f AS r, n, (1000 * c.f * n) // (x.f * y.f) AS score
    FROM cuts c
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.cut], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1 : c.k], ' ')
    JOIN totals t ON t.lang = c.lang
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER w AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
    score::BIGINT AS score
FROM lowest WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_licenses": LICENSES,
        "op3_exact_dedup": EXACT,
        "op4_top_k": TOP_K,
        "op8_chat": CHAT,
        "op11_phrases": PHRASES,
    }
