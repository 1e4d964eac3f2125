"""SQL of the operators that SQL can express, for DuckDB over the test tables."""

from __future__ import annotations

#: Hosts whose patterns block where no rule decides (fixed values).
_BLOCKED = "ads-track|free-bets|cheap-pills|spam-farm|casino-win|adult-x"

_OP10 = rf"""
WITH split AS (
    SELECT page_id,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM split
), ruled AS (
    SELECT page_id, host, path,
        CASE
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%'
                THEN 'example.com/de/'
            WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%'
                THEN 'example.net/en/'
            WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
            WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/'
        END AS rule
    FROM parts
)
SELECT page_id, host, path, rule,
    CASE
        WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
        WHEN rule IS NOT NULL THEN 'allow'
        WHEN regexp_matches(host || path, '(^|\.)({_BLOCKED})\.') THEN 'block'
        ELSE 'allow'
    END AS verdict
FROM ruled
"""

_OP8 = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(len(words), 13) AS size,
        array_to_string(words[i : i + least(len(words), 13) - 1], ' ') AS window_text
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 11, 2))) AS i
        FROM item_words WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM item_windows
), doc_windows AS (
    SELECT doc_id, size, i, array_to_string(words[i : i + size - 1], ' ') AS window_text
    FROM (SELECT doc_id, words, size, unnest(range(1, greatest(len(words) - size + 2, 1))) AS i
        FROM doc_words, sizes)
), found AS (
    SELECT doc_id, item_id, i, size FROM doc_windows JOIN item_windows USING (size, window_text)
), hit AS (
    SELECT doc_id, count(DISTINCT covered) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS covered FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP9 = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i : i + 12], ' ') AS run
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 11, 1))) AS i FROM words)
), least AS (SELECT run, min(doc_id) AS least FROM windows GROUP BY run
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place
    FROM windows JOIN least USING (run) WHERE doc_id > least
), places AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM words
), kept AS (
    SELECT p.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS text
    FROM places p ANTI JOIN gone g USING (doc_id, place) GROUP BY p.doc_id
)
SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM words w LEFT JOIN kept USING (doc_id)
"""

_OP7 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i : i + 3], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i
        FROM words WHERE len(words) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY 1, 2
), links AS (
    SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""

_OP12 = """
WITH sized AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), named AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM sized
), judged AS (
    SELECT *, payload_bytes >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS revisits
    FROM named
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN revisits THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN revisits THEN first END AS refers_to, true AS verified
FROM judged
"""


def _op11(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The rounds one after the other, each a full search of the entries."""
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"""far{i} AS MATERIALIZED (
    SELECT r, p.part, entry, list_sum(list_transform(list_zip(p.piece, b.piece), lambda x : (x[1] - x[2]) * (x[1] - x[2]))) AS far
    FROM pieces p JOIN books{i} b ON p.part = b.part
), chosen{i} AS MATERIALIZED (
    SELECT r, part, min({{'far': far, 'entry': entry}}) AS best FROM far{i} GROUP BY r, part
)"""
        )
        if i < rounds:
            steps.append(
                f"""moved{i} AS (
    SELECT c.part, c.best.entry AS entry, place, sum(piece[place])::BIGINT AS total, count(*) AS n
    FROM chosen{i} c JOIN pieces p ON c.r = p.r AND c.part = p.part, unnest(range(1, len(p.piece) + 1)) AS u(place)
    GROUP BY ALL
), new{i} AS (
    SELECT part, entry, list(((total - (total % n + n) % n) // n)::BIGINT ORDER BY place) AS piece
    FROM moved{i} GROUP BY part, entry
), books{i + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, coalesce(n.piece, b.piece) AS piece
    FROM books{i} b LEFT JOIN new{i} n ON b.part = n.part AND b.entry = n.entry
)"""
            )
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
        list_transform(embedding, lambda x : floor({scale} * x::DOUBLE)::BIGINT) AS whole
    FROM embeddings
    WHERE embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x : x IS NOT NULL AND isfinite(x))), true)
), pieces AS MATERIALIZED (
    SELECT r, part, whole[part * (len(whole) // {parts}) + 1 : (part + 1) * (len(whole) // {parts})] AS piece
    FROM kept, unnest(range({parts})) AS u(part)
), books0 AS MATERIALIZED (
    SELECT part, r - 1 AS entry, piece FROM pieces WHERE r <= {entries}
), {", ".join(steps)}, results AS (
    SELECT k.vec_id, k.label, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.far)::BIGINT AS error
    FROM chosen{rounds} c JOIN kept k ON k.r = c.r GROUP BY k.r, k.vec_id, k.label
), digest AS (
    SELECT sha256(string_agg(array_to_string(piece, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM results, digest
"""


#: Edits by state: 0 nothing put out, 1 system, 2 user, 3 assistant; inserts behind an edit end in other states.
_OP13 = r"""
WITH RECURSIVE bits AS (
    SELECT b, b AS value, 0 AS done FROM unnest(range(256)) AS u(b)
    UNION ALL
    SELECT b, CASE WHEN value % 2 = 1 THEN xor(3988292384, value // 2) ELSE value // 2 END, done + 1 FROM bits WHERE done < 8
), crc AS (SELECT list(value ORDER BY b) AS step FROM bits WHERE done = 8
), keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
    FROM conversations
), fated AS (
    SELECT keyed.*, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i : ascii(k[i])::BIGINT)),
        lambda value, byte : xor(value // 256, step[(xor(value, byte) % 256) + 1]))) % 20 AS fate
    FROM keyed, crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
        CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM fated, unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS u(copy)
    WHERE fate <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged
), judged AS MATERIALIZED (
    SELECT conv_id, i, turn, role, text, left(role, 1) AS initial,
        left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair,
        CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault
    FROM placed
), edits(state, edit, initial, target, price) AS (
    SELECT state::INTEGER, 'D', NULL::VARCHAR, state::INTEGER, 3 FROM unnest(range(4)) AS u(state)
    UNION ALL VALUES (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0), (3, 'K', 'u', 2, 0),
        (0, 'R', NULL, 2, 2), (1, 'R', NULL, 2, 2), (2, 'R', NULL, 3, 2), (3, 'R', NULL, 2, 2)
), inserts(source, state, signs, added, price) AS (
    VALUES (0, 0, '', '', 0), (1, 1, '', '', 0), (2, 2, '', '', 0), (3, 3, '', '', 0),
        (0, 2, 'I', 'user:', 2), (1, 2, 'I', 'user:', 2), (2, 3, 'I', 'assistant:', 2), (3, 2, 'I', 'user:', 2),
        (0, 3, 'II', E'user:\nassistant:', 4), (1, 3, 'II', E'user:\nassistant:', 4)
), ids AS (SELECT DISTINCT conv_id FROM conversations
), ways AS (
    SELECT conv_id, 0::BIGINT AS i, n.state, {'cost': n.price::BIGINT, 'audit': n.signs, 'lines': [x for x in [n.added] if x <> '']} AS way
    FROM ids, inserts n WHERE n.source = 0
    UNION ALL
    SELECT conv_id, i, state, min(way) AS way FROM (
        SELECT w.conv_id, j.i, n.state, {
            'cost': w.way.cost + e.price + n.price + CASE WHEN e.edit <> 'D' AND coalesce(j.fault, '') = 'truncated' THEN 1 ELSE 0 END,
            'audit': w.way.audit || e.edit || n.signs,
            'lines': list_concat(list_concat(w.way.lines, CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [j.role || ':' || j.text]
                ELSE [CASE e.target WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || j.text] END),
                [x for x in [n.added] if x <> ''])} AS way
        FROM ways w
        JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1
        JOIN edits e ON e.state = w.state AND (e.initial IS NULL OR e.initial = j.initial)
            AND (e.edit = 'D' OR coalesce(j.fault, '') NOT IN ('blank', 'duplicate'))
        JOIN inserts n ON n.source = e.target
    ) GROUP BY conv_id, i, state
), figures AS (
    SELECT conv_id, max(i) AS last, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
), best AS (
    SELECT w.conv_id, min(way) AS way FROM ways w LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM w.conv_id
    WHERE i = coalesce(last, 0) AND state IN (0, 3) GROUP BY w.conv_id
)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, way.cost AS cost, way.audit AS audit,
    sha256(array_to_string(way.lines, chr(10))) AS repaired_sha256
FROM best b LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM b.conv_id
"""

ORACLES: dict[str, str] = {
    "op7_near_duplicates": _OP7,
    "op8_contamination": _OP8,
    "op9_repeated_passages": _OP9,
    "op10_url_filter": _OP10,
    "op11_vector_codes": _op11(),
    "op12_warc": _OP12,
    "op13_conversation_repair": _OP13,
}
