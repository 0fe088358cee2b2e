"""SQL that the queries are compared with, where SQL can express them."""

from __future__ import annotations

#: Sources sorted by the ratio of their limit to their weight; the first level that does not
#: exceed its source's ratio is the one at which the targets sum to all sizes.
MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           ('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-')), 1, 15))::BIGINT AS k
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS s,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
    FROM sized GROUP BY source
), levels AS (
    SELECT *, 3 * s / w AS ratio,
           (sum(s) OVER () - coalesce(sum(3 * s) OVER (ORDER BY 3 * s / w, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT
           / (sum(w) OVER (ORDER BY 3 * s / w, source NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level_here
    FROM totals
), chosen AS (
    SELECT arg_min(level_here, (ratio, source IS NULL, coalesce(source, ''))) AS level
    FROM levels WHERE level_here <= ratio
), goals AS (
    SELECT source, s, least(3.0::DOUBLE * s, level * w) AS target,
           least(3 * s, floor(least(3.0::DOUBLE * s, level * w) + 0.5))::BIGINT AS budget
    FROM levels, chosen
), placed AS (
    SELECT d.*, g.s, g.target, g.budget,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id NULLS LAST, d.size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
    FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size::BIGINT AS size, s AS source_size, target,
       (budget // greatest(s, 1) * size
        + greatest(0, least(size, budget % greatest(s, 1) - ahead)))::BIGINT AS taken
FROM placed
"""

CHAT = r"""
WITH rows AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), marked AS (
    SELECT *, regexp_replace(regexp_replace(replace(text, '\', '\\'),
           '<(\||/?s>|<SYS>>|</SYS>>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g') AS e
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|turn|><|text|><|end|>') + length(coalesce(role, '')) + length(e))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

#: Windows as lists of words, numbered from 1; a word goes if any window over it is repeated.
SUBSTRINGS = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, w[i:i + 12] AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM split)
), least AS (
    SELECT g, min(doc_id) AS first FROM windows GROUP BY g
), removed AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
    FROM windows JOIN least USING (g) WHERE first < doc_id
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
    FROM words ANTI JOIN removed USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""

#: Units as a list; the draws are groups of eight hex digits of one digest per document.
INFILL = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
           [('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), i, 8))::BIGINT
               FOR i IN [1, 9, 17, 25]] AS h
    FROM documents
), drawn AS (
    SELECT *, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
           greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90
                THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
), parts AS (
    SELECT doc_id, t, form, len(u)::BIGINT AS n, array_to_string(u[1:a], '') AS p,
           array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s
    FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
              ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

#: All pairs of sets that share a shingle, and components by walking the links.
MINHASH = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct([w[i:i + 3] FOR i IN range(1, greatest(1, len(w) - 3) + 1)]) AS s
    FROM split WHERE len(w) > 0
), groups AS (
    SELECT list_sort(s) AS s, min(doc_id) AS node, len(any_value(s)) AS n FROM sets GROUP BY ALL
), items AS (
    SELECT node, n, unnest(s) AS g FROM groups
), links AS (
    SELECT a.node AS a, b.node AS b FROM items a JOIN items b USING (g)
    WHERE a.node <> b.node AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.node, b.node HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), reached AS (
    SELECT node, node AS other FROM groups
    UNION SELECT r.node, l.b FROM reached r JOIN links l ON r.other = l.a
), components AS (
    SELECT node, min(other) AS component_id FROM reached GROUP BY node
)
SELECT d.doc_id, coalesce(len(s.s), 0)::BIGINT AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sets s USING (doc_id) LEFT JOIN groups g ON list_sort(s.s) = g.s
     LEFT JOIN components c ON g.node = c.node
"""

#: A checksum is a fold over the bytes, each followed by eight steps (-1); a proof is a fold over the
#: levels, each with what stands to the left and to the right of the node.
MERKLE = r"""
WITH RECURSIVE fields AS (
    SELECT doc_id, source, text,
           concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'),
                  coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
                  coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head,
           replace(text, chr(10), '') AS joined,
           xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(
               [[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
                FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
               lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384)
                            ELSE c >> 1 END)) AS crc
    FROM documents
), leaves AS (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           CASE WHEN crc % 2 = 0 THEN sha256(head || coalesce(strlen(joined) || ':' || joined, '-')) END AS tampered
    FROM fields
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           count(*) OVER (PARTITION BY source) AS n
    FROM leaves
), nodes AS (
    SELECT 0 AS level, source, pos, n, leaf AS digest FROM placed
    UNION ALL
    SELECT level + 1, source, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
    FROM nodes WHERE n > 1 GROUP BY level, source, pos // 3, n
), subroots AS (
    SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
    FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS level, pos, n, digest FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
    FROM tops WHERE n > 1 GROUP BY level, pos // 3, n
), every AS (
    SELECT level, source, false AS top, pos, digest FROM nodes WHERE n > 1
    UNION ALL SELECT level, NULL, true, pos, digest FROM tops WHERE n > 1
), sides AS (
    SELECT a.level, a.source, a.top, a.pos,
           coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
           coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
    FROM every a JOIN every b ON a.level = b.level AND a.source IS NOT DISTINCT FROM b.source
         AND a.top = b.top AND a.pos // 3 = b.pos // 3
    GROUP BY ALL
), steps AS (
    SELECT p.source, p.pos, s.level, s.l, s.r
    FROM placed p JOIN sides s ON NOT s.top AND p.source IS NOT DISTINCT FROM s.source
         AND s.pos = p.pos // CAST(pow(3, s.level) AS BIGINT)
    UNION ALL
    SELECT p.source, p.pos, 1000 + s.level, s.l, s.r
    FROM placed p JOIN subroots t ON p.source IS NOT DISTINCT FROM t.source
         JOIN sides s ON s.top AND s.pos = t.pos // CAST(pow(3, s.level) AS BIGINT)
), proofs AS (
    SELECT source, pos, sha256(string_agg(l || r, '' ORDER BY level)) AS proof_sha256,
           list({'l': l, 'r': r} ORDER BY level) AS sides
    FROM steps GROUP BY source, pos
), roots AS (
    SELECT digest AS root FROM tops WHERE n = 1
)
SELECT doc_id, leaf, t.digest AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
       list_reduce(list_prepend({'l': coalesce(tampered, leaf), 'r': ''}, coalesce(sides, [])),
                   lambda x, e: {'l': sha256(e.l || x.l || e.r), 'r': ''}).l AS folded_root,
       folded_root = root AS verified
FROM placed p JOIN subroots t ON p.source IS NOT DISTINCT FROM t.source
     LEFT JOIN proofs f ON p.source IS NOT DISTINCT FROM f.source AND p.pos = f.pos, roots
"""

_GRAMS = (2, 3, 4, 6, 8, 10)


def _quality() -> str:
    """Per n-gram length the words inside n-grams that their text has twice; lines by their first place."""
    ctes, joins, shares = [], [], []
    for n in _GRAMS:
        ctes.append(f"""
at{n} AS (SELECT doc_id, i, w[i:i + {n - 1}] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM split)),
in{n} AS (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS i FROM at{n} SEMI JOIN
    (SELECT doc_id, g FROM at{n} GROUP BY doc_id, g HAVING count(*) > 1) USING (doc_id, g)),
sum{n} AS (SELECT doc_id, count(*) AS words{n}, sum(length(word)) AS chars{n} FROM in{n} JOIN words USING (doc_id, i) GROUP BY doc_id)""")
        joins.append(f"LEFT JOIN sum{n} USING (doc_id)")
        if n != 3:
            shares.append(f"coalesce(chars{n}, 0)::DOUBLE / greatest(1, word_chars) AS share_{n}")
    return rf"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split
), lines AS (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM split
), dups AS (
    SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines, sum((n - 1) * length(line))::BIGINT AS dup_chars
    FROM (SELECT doc_id, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line)
    GROUP BY doc_id
), chars AS (
    SELECT doc_id, sum(length(word))::BIGINT AS word_chars FROM words GROUP BY doc_id
), {",".join(ctes)}, measured AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(word_chars, 0) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(words3, 0)::BIGINT AS n_repeat_words, coalesce(dup_chars, 0)::DOUBLE / greatest(1, length(t)) AS line_share,
           {", ".join(shares)}
    FROM split LEFT JOIN dups USING (doc_id) LEFT JOIN chars USING (doc_id) {" ".join(joins)}
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT base_failed AND line_share <= 0.3 AND share_2 <= 0.8 AND share_4 <= 0.5 AND share_6 <= 0.4 AND share_8 <= 0.35
       AND share_10 <= 0.3 AS kept
FROM measured
"""


#: The law by exact sums, without samples, ranges or cells; the checksum as a fold over the bytes, each followed
#: by eight steps (-1).
SHARDING = r"""
WITH sized AS (
    SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
           ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS k,
           ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-')), 1, 15))::BIGINT AS k2, hex(encode(coalesce(text, ''))) AS h
    FROM documents
), placed AS (
    SELECT *, sum(size) OVER ()::BIGINT AS total, (sum(size) OVER o)::BIGINT - size AS start,
           row_number() OVER o - 1 AS number, sum(size) OVER (PARTITION BY k)::BIGINT AS group_size
    FROM sized WINDOW o AS (ORDER BY k, k2, size, doc_id NULLS LAST ROWS UNBOUNDED PRECEDING)
), dealt AS (
    SELECT *, least(39, floor((CASE WHEN group_size * 40 <= 0.05 * total
            THEN 2 * min(start) OVER (PARTITION BY k) + group_size ELSE 2 * start + size END) * 40 / (2 * total)))::INTEGER AS shard
    FROM placed
)
SELECT doc_id, size::BIGINT AS size,
       xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(
           [[('0x' || substr(h, 2 * i + 1, 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR i IN range(size - 16)])),
           lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS text_crc32,
       'bytes' AS law, shard, number - min(number) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM dealt
"""

#: Every 100-byte string by a sum of its hex digits, the first place of each, and runs of removed bytes.
SUFFIXES = r"""
WITH raw AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), strings AS (
    SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS g FROM (SELECT doc_id, h, unnest(range(n - 99)) AS i FROM raw)
), repeated AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS place FROM strings
        SEMI JOIN (SELECT g FROM strings GROUP BY g HAVING count(*) > 1) USING (g)) WHERE place > 1
), runs AS (
    SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
            SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS fresh FROM repeated))
    GROUP BY doc_id, run
), gaps AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM runs
), cut AS (
    SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept, max(b) AS last,
           sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans
    FROM gaps JOIN raw USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM raw LEFT JOIN cut USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_mixing": MIXING,
    "op4_substring_dedup": SUBSTRINGS,
    "op5_suffix_array_dedup": SUFFIXES,
    "op6_quality_rules": _quality(),
    "op7_sharding": SHARDING,
    "op8_chat_formatting": CHAT,
    "op11_fill_in_middle": INFILL,
    "op12_minhash_near_dedup": MINHASH,
    "op13_merkle_manifest": MERKLE,
}
