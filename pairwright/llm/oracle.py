"""SQL counterparts of the registered queries of this folder, where SQL can express them."""

ORACLE = {
    "op8_topk": r"""
        WITH v AS (
            SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
            FROM v q JOIN v d ON d.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op9_chat": r"""
        WITH given AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
        )
        SELECT conv_id, count(*)::BIGINT AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length('<|im_start|>') + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'))
                   + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
        FROM given GROUP BY conv_id
    """,
    "op13_infill": r"""
        WITH given AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
        ), units AS (
            SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS u, ('0x' || h[1:8])::UBIGINT AS h1,
                   ('0x' || h[9:16])::UBIGINT AS h2, ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4
            FROM given
        ), cuts AS (
            SELECT *, len(u)::BIGINT AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1))::BIGINT AS a,
                   greatest(h1 % (len(u) + 1), h2 % (len(u) + 1))::BIGINT AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                        WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM units
        ), parts AS (
            SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM cuts
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
}
