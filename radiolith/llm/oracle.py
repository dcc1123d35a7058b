"""DuckDB SQL of the queries that SQL can express."""

_RULES = """(VALUES ('allow','org','/'), ('block','example.org','/es/'), ('block','example.org','/en/1'),
    ('allow','com','/fr/'), ('block','com','/de/')) rules(action, rule_host, rule_path)"""

_URL = r"""SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages"""

_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

ORACLE: dict[str, str] = {
    "op1_url_filter": f"""WITH u AS ({_URL}),
        fits AS (SELECT DISTINCT host, path, rule_host || rule_path AS rule, action FROM u, {_RULES}
            WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
        best AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS verdict
            FROM fits GROUP BY host, path)
        SELECT page_id, u.host, u.path, rule, coalesce(verdict, 'allow') AS verdict
        FROM u LEFT JOIN best ON u.host = best.host AND u.path = best.path""",
    "op4_chat": r"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, n, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)),
        x AS (SELECT *, 23 + length(role) + length(text) + length(text) - length(replace(text, chr(92), ''))
            + len(regexp_extract_all(text, '<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<image>|<audio>|<document>')) AS chars FROM t)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            sum(chars)::BIGINT AS formatted_chars FROM x GROUP BY conv_id""",
    "op5_substring_dedup": r"""WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
            FROM documents),
        w AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 34], ' ')) AS h
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM d)),
        r AS (SELECT doc_id, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM r),
        gaps AS (SELECT doc_id, list(j) AS gone FROM gone GROUP BY doc_id),
        k AS (SELECT d.doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
            CASE WHEN gone IS NULL THEN words
                ELSE list_transform(list_filter(list_zip(words, range(1, len(words) + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END AS kept
            FROM d LEFT JOIN gaps ON d.doc_id = gaps.doc_id)
        SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k""",
    "op7_warc": r"""WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p),
        d AS (SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                (((('0x' || h[1 + 5 * (j // 4):5 + 5 * (j // 4)])::BIGINT >> (15 - 5 * (j % 4))) & 31) + 1)::BIGINT, 1), '' ORDER BY j) AS payload_digest
            FROM p, range(32) r(j) GROUP BY page_id)
        SELECT g.page_id, payload_bytes, payload_digest, CASE WHEN g.page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN g.page_id = top THEN NULL ELSE top END AS refers_to FROM g JOIN d ON g.page_id = d.page_id""",
    "op8_decontaminate": rf"""WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        b AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
        bw AS (SELECT DISTINCT item_id, least(10, len(words)) AS k, unnest(list_transform(range(1, len(words) - least(10, len(words)) + 2),
            lambda i: array_to_string(words[i:i + least(10, len(words)) - 1], ' '))) AS w FROM b WHERE len(words) > 0),
        dw AS (SELECT doc_id, i, k, array_to_string(words[i:i + k - 1], ' ') AS w
            FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw))),
        h AS (SELECT doc_id, i, dw.k, item_id FROM dw JOIN bw ON dw.w = bw.w AND dw.k = bw.k),
        hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM h) GROUP BY doc_id),
        it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id)
        SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN it ON d.doc_id = it.doc_id""",
    "op10_exact_dedup": r"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
            sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents),
        g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
            count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op12_hard_negatives": r"""WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
            FROM r a JOIN r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
        p AS (SELECT anchor_id, other, score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
        SELECT p.anchor_id, p.other AS positive_id, (row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY s.score DESC, s.other))::INT AS rank,
            s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
        QUALIFY rank <= 5""",
    "op13_divergence": r"""WITH t AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS terms FROM documents),
        d AS (SELECT doc, lang, source, unnest(terms) AS term FROM t),
        kept AS (SELECT lang, term, count(*) AS total FROM d GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
        g AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
        c AS (SELECT lang, source, term, count(*) AS n FROM d JOIN kept USING (lang, term) GROUP BY lang, source, term),
        x AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n, total, count(*) OVER (PARTITION BY g.lang, g.source) AS v,
                sum(coalesce(n, 0)) OVER (PARTITION BY g.lang, g.source) AS group_n, sum(total) OVER (PARTITION BY g.lang, g.source) AS lang_n
            FROM g JOIN kept ON g.lang = kept.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
        s AS (SELECT lang, source, term, n, (1 + (1000000000 * (n + 2)::HUGEINT) // (group_n + 2 * v))::HUGEINT AS p,
                (1 + (1000000000 * (total + 2)::HUGEINT) // (lang_n + 2 * v))::HUGEINT AS q FROM x),
        pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(((pa.p - pb.p) * (pa.p - pb.p)) // (pa.p + pb.p)), 0)::BIGINT AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s pa ON pa.lang = a.lang AND pa.source = a.source
                LEFT JOIN s pb ON pb.lang = b.lang AND pb.source = b.source AND pb.term = pa.term GROUP BY 1, 2, 3),
        term AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM s WHERE n > 0 AND p > q),
        u AS (SELECT 'pair' AS part, * FROM pair UNION ALL SELECT 'term', * FROM term)
        SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
        FROM u QUALIFY part = 'pair' OR rank <= 10""",
}
