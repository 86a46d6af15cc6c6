"""SQL for a second engine that checks the suffix, repair and resampling operators."""

#: The CRC-32 from what each byte adds by its distance from the end; ``crc_keys`` must hold the texts in ``k``.
_CRC = """
    crc_bits AS (
        SELECT b, 0 AS step, b::BIGINT AS v FROM range(256) t(b)
        UNION ALL SELECT b, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_bits WHERE step < 8
    ), crc_byte AS (SELECT b, v FROM crc_bits WHERE step = 8
    ), crc_keyed AS (SELECT k, hex(encode(k)) AS h, len(hex(encode(k))) // 2 AS n FROM crc_keys
    ), crc_place AS (
        SELECT 0 AS d, b, v FROM crc_byte
        UNION ALL SELECT d + 1, p.b, xor(p.v >> 8, t.v) FROM crc_place p JOIN crc_byte t ON t.b = p.v & 255
        WHERE d < (SELECT max(n) FROM crc_keyed)
    ), crc_zeros AS (
        SELECT 0 AS n, 4294967295::BIGINT AS v
        UNION ALL SELECT n + 1, xor(z.v >> 8, t.v) FROM crc_zeros z JOIN crc_byte t ON t.b = z.v & 255
        WHERE n < (SELECT max(n) FROM crc_keyed)
    ), crc_letters AS (
        SELECT k, n, unnest(range(n)) AS pos, h FROM crc_keyed
    ), crc_sums AS (
        SELECT l.k, any_value(l.n) AS n, bit_xor(p.v) AS v
        FROM crc_letters l JOIN crc_place p ON p.d = l.n - 1 - l.pos AND p.b = ('0x' || substr(h, 2 * pos + 1, 2))::INTEGER
        GROUP BY l.k
    ), crcs AS (SELECT s.k, xor(xor(s.v, z.v), 4294967295) AS crc FROM crc_sums s JOIN crc_zeros z USING (n))
"""

ORACLES: dict[str, str] = {
    "op11_suffix_dedup": """
        WITH texts AS (SELECT doc_id, encode(coalesce(text, '')) AS raw, octet_length(encode(coalesce(text, ''))) AS n FROM documents
        ), windows AS (
            SELECT doc_id, unnest(range(n)) AS pos,
                   unnest(list_transform(range(n), lambda i: hex(array_slice(raw, i + 1, i + 1)))) AS byte,
                   unnest(list_transform(range(n), lambda i: CASE WHEN i + 100 <= n THEN md5(array_slice(raw, i + 1, i + 100)) END)) AS name
            FROM texts
        ), firsts AS (
            SELECT name, min(row(doc_id, pos)) AS place FROM windows WHERE name IS NOT NULL GROUP BY name
        ), marked AS (
            SELECT doc_id, pos, byte, coalesce(row(doc_id, pos) > place, false) AS late FROM windows LEFT JOIN firsts USING (name)
        ), judged AS (
            SELECT doc_id, pos, byte,
                   bool_or(late) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone
            FROM marked
        ), edges AS (
            SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM judged
        ), sums AS (
            SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
                   string_agg(byte, '' ORDER BY pos) FILTER (WHERE NOT gone) AS kept
            FROM edges GROUP BY doc_id
        )
        SELECT t.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(unhex(coalesce(kept, ''))) AS kept_sha256
        FROM texts t LEFT JOIN sums USING (doc_id)
    """,
    "op12_conversation_repair": r"""
        WITH RECURSIVE named AS (
            SELECT *, concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS k FROM conversations
        ), crc_keys AS (SELECT DISTINCT k FROM named
        ), """ + _CRC + r""", damaged AS (
            SELECT conv_id, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
                   CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
                   unnest(CASE WHEN crc % 20 = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM named JOIN crcs USING (k) WHERE crc % 20 <> 0
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS n FROM damaged
        ), judged AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
                           WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
                   role[1:1] AS initial, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY n) AS previous
            FROM numbered
        ), inserts(q, i, q2, added, extra) AS (
            VALUES (0, 0, 0, [], 0), (1, 0, 1, [], 0), (2, 0, 2, [], 0), (3, 0, 3, [], 0),
                   (0, 1, 2, ['user:'], 5), (1, 1, 2, ['user:'], 5), (2, 1, 3, ['assistant:'], 5), (3, 1, 2, ['user:'], 5),
                   (0, 2, 3, ['user:', 'assistant:'], 10), (1, 2, 3, ['user:', 'assistant:'], 10),
                   (2, 2, 2, ['assistant:', 'user:'], 10), (3, 2, 3, ['user:', 'assistant:'], 10)
        ), states AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS n, 0 AS q, struct_pack(cost := 0, audit := '', lines := []::VARCHAR[]) AS best FROM damaged
            UNION ALL
            SELECT conv_id, n, q, min(best) FROM (
                SELECT s.conv_id, j.n,
                       CASE WHEN e.edit = 'D' THEN i.q2 WHEN e.edit = 'R' THEN CASE i.q2 WHEN 2 THEN 3 ELSE 2 END
                            ELSE CASE j.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END END AS q,
                       struct_pack(
                           cost := s.best.cost + i.extra + CASE e.edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
                                   + CASE WHEN e.edit <> 'D' AND j.fault = 'truncated' THEN 5 ELSE 0 END,
                           audit := s.best.audit || repeat('I', i.i) || e.edit,
                           lines := list_concat(list_concat(s.best.lines, i.added::VARCHAR[]),
                               CASE e.edit WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [j.role || ':' || j.text]
                                    ELSE [CASE i.q2 WHEN 2 THEN 'assistant:' ELSE 'user:' END || j.text] END)) AS best
                FROM states s JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.n = s.n + 1
                JOIN inserts i ON i.q = s.q, (VALUES ('D'), ('K'), ('R')) e(edit)
                WHERE e.edit = 'D' OR j.fault IN ('', 'truncated') AND (e.edit = 'R'
                      OR j.initial = 's' AND i.q2 = 0 OR j.initial = 'u' AND i.q2 <> 2 OR j.initial = 'a' AND i.q2 = 2)
            ) GROUP BY conv_id, n, q
        ), sums AS (
            SELECT conv_id, max(n) AS n, (max(turn) - min(turn) + 1 - count(DISTINCT turn))::BIGINT AS gaps,
                   count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
                   count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                   count(*) FILTER (WHERE n > 1 AND concat(previous, initial) NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv_id
        ), ended AS (
            SELECT s.conv_id, min(struct_pack(
                       cost := best.cost + CASE s.q WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END,
                       audit := best.audit || CASE s.q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
                       lines := list_concat(best.lines, CASE s.q WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE [] END))) AS best
            FROM states s JOIN sums m ON s.conv_id IS NOT DISTINCT FROM m.conv_id AND s.n = m.n GROUP BY s.conv_id
        )
        SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost,
               coalesce(e.best.audit, '') AS audit, sha256(coalesce(array_to_string(e.best.lines, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c
        LEFT JOIN sums m ON c.conv_id IS NOT DISTINCT FROM m.conv_id LEFT JOIN ended e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
    """,
    "op13_importance_resampling": r"""
        WITH RECURSIVE texts AS (
            SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark
        ), lists AS (
            SELECT row_number() OVER () AS id, side, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM texts
        ), features AS (
            SELECT id, side, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS k FROM lists
        ), crc_keys AS (SELECT DISTINCT k FROM features
        ), """ + _CRC + r""", held AS (SELECT id, side, crc % 10000 AS bucket, count(*) AS n FROM features JOIN crcs USING (k) GROUP BY ALL
        ), shares AS (
            SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE side = 'b'), 0)::DOUBLE AS t
            FROM held GROUP BY bucket
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000)))) AS gain FROM shares
        ), sums AS (
            SELECT id, sum(n)::BIGINT AS n, floor(sum(n * gain) / sum(n))::BIGINT AS weight FROM held JOIN gains USING (bucket) GROUP BY id
        ), noisy AS (
            SELECT id, doc_id, len(w) AS words, ('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h FROM lists WHERE side = 'd'
        ), scored AS (
            SELECT doc_id, words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                   (coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
            FROM noisy LEFT JOIN sums USING (id)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (WHERE words >= 20) OVER () AS able
            FROM scored
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND place <= 25 * able // 100 THEN place END::BIGINT AS rank FROM ranked
    """,
}
