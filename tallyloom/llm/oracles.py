"""The same results in SQL, where SQL can express them."""

from __future__ import annotations

from tallyloom.llm import phrases, quality, secrets

WORD = r"[^\x20\x09-\x0D]+"

OP4 = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 15))::BIGINT AS k
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, row_number() OVER (ORDER BY source_size * 2.0::DOUBLE / w, source NULLS LAST) AS i FROM s),
held AS (  -- the first i - 1 sources stop at their limit
  SELECT i, cap / w AS own,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
         / sum(w) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r),
cut AS (SELECT i, level FROM held WHERE level < own ORDER BY i LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN cut.i IS NULL OR r.i < cut.i THEN cap ELSE w * level END AS target
  FROM r LEFT JOIN cut ON true),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
p AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before FROM d)
SELECT p.doc_id, p.size, b.source_size, b.target,
       (epochs * p.size + greatest(0, least(p.size, floor(target - epochs * source_size) - before)))::BIGINT AS taken
FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source
"""


OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (
  SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(least.b, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(least.b, v.vec_id)) AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN least ON least.a = v.vec_id
"""

OP3 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS x
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(least.b, w.doc_id)) AS component_id,
       w.doc_id = least(w.doc_id, coalesce(least.b, w.doc_id)) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.a = w.doc_id
"""


def _dup(n: int) -> str:
    return f"coalesce(sum(chars) FILTER (n = {n}), 0)::BIGINT AS dup_{n}gram_chars"


OP5 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
w AS (SELECT doc_id, regexp_extract_all(x, '{WORD}') AS w FROM d),
places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
  FROM w CROSS JOIN (VALUES (3), {', '.join(f'({n})' for n in quality.NGRAMS)}) AS v(n)),
grams AS (
  SELECT doc_id, n, p, row_number() OVER same AS k, count(*) OVER (PARTITION BY doc_id, n, gram) AS m
  FROM (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS gram FROM places)
  WINDOW same AS (PARTITION BY doc_id, n, gram ORDER BY p)),
covered AS (SELECT DISTINCT doc_id, n, unnest(range(p, p + n)) AS q FROM grams WHERE CASE WHEN n = 3 THEN m > 1 ELSE k > 1 END),
repeats AS (SELECT doc_id, n, count(*) AS words, sum(length(w[q])) AS chars FROM covered JOIN w USING (doc_id) GROUP BY doc_id, n),
per_doc AS (
  SELECT doc_id, coalesce(sum(words) FILTER (n = 3), 0)::BIGINT AS n_repeat_words, {', '.join(map(_dup, quality.NGRAMS))}
  FROM w LEFT JOIN repeats USING (doc_id) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS i FROM (SELECT doc_id, string_split(x, chr(10)) AS s FROM d)),
again AS (
  SELECT doc_id, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')))::BIGINT AS dup_line_chars
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS k FROM lines WHERE regexp_matches(line, '{WORD}')) WHERE k > 1 GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(x, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols
  FROM w JOIN d USING (doc_id)),
joined AS (
  SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(dup_line_chars, 0) AS dup_line_chars, per_doc.* EXCLUDE (doc_id),
         n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed, greatest(word_chars, 1)::DOUBLE AS c
  FROM counted JOIN per_doc USING (doc_id) LEFT JOIN again USING (doc_id))
SELECT * EXCLUDE (c), NOT base_failed AND NOT (dup_line_chars / c > {quality.MAX_DUP_LINES}::DOUBLE
  OR {' OR '.join(f'dup_{n}gram_chars / c > {most}::DOUBLE' for n, most in quality.NGRAMS.items())}) AS kept
FROM joined
"""


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _found(kind: str, pattern: str, where: str = "TRUE", rest: str = "hit") -> str:
    """Matches of a pattern: between them lie the parts of the text split by it. ``rest`` is what of a match ``where`` judges."""
    return f"""SELECT doc_id, '{kind}' AS kind, {secrets.KINDS.index(kind)} AS r, start, start + length(hit) AS stop FROM (
  SELECT *, {rest} AS rest FROM (SELECT doc_id, h[i] AS hit, list_sum(g[1:i]) + coalesce(list_sum(list_transform(h[1:i - 1], lambda s: length(s))), 0) AS start FROM (
    SELECT doc_id, h, g, unnest(range(1, len(h) + 1)) AS i FROM (
      SELECT doc_id, regexp_extract_all(x, {_text(pattern)}) AS h, list_transform(string_split_regex(x, {_text(pattern)}), lambda s: length(s)) AS g FROM t)))) WHERE {where}"""


def _suspicious(name: str) -> str:
    pattern, bits = secrets.CLASSES[name]
    calm = " AND ".join(f"NOT regexp_matches(hit, {_text(c)})" for c in secrets.CALM[name])
    rest = "hit" if name == "hex" else (
        f"array_to_string(list_filter(string_split_regex(hit, {_text(secrets.SEPARATOR)}), lambda part: NOT regexp_matches(part, {_text(secrets.CALM_PART)})), '')")
    needed = str(bits) if name == "hex" else f"CASE WHEN regexp_matches(hit, '[0-9]') THEN {bits} ELSE {secrets.NO_DIGIT_BITS} END"
    windows = f"list_transform(range(1, length(rest) - {secrets.WINDOW - 2}), lambda p: list_aggregate(string_split(substr(rest, p, {secrets.WINDOW}), ''), 'entropy'))"
    return _found("entropy", pattern, f"{calm} AND list_max({windows}) >= {needed}", rest)


_LISTED = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, r)"
OP10 = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
base AS (
  {_found('assign', secrets.ASSIGN, f"length(regexp_extract(hit, {_text(secrets.ASSIGN)}, 2)) >= {secrets.ASSIGN_VALUE}")}
  UNION ALL {_found('access', secrets.ACCESS)}
  UNION ALL {_found('hex', secrets.HEX)}),
more AS ({_suspicious('hex')} UNION ALL {_suspicious('base64')}),
spans AS (
  SELECT * FROM base UNION ALL
  SELECT DISTINCT m.doc_id, m.kind, m.r, m.start, m.stop  -- those of which some character is in no fixed pattern
  FROM (SELECT *, unnest(range(start::BIGINT, stop::BIGINT)) AS p FROM more) m LEFT JOIN base b ON b.doc_id = m.doc_id AND b.start <= p AND p < b.stop
  WHERE b.doc_id IS NULL)
SELECT t.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce({_LISTED} FILTER (kind <> 'entropy'), '')) AS base_sha256, coalesce({_LISTED}, '') AS spans
FROM t LEFT JOIN spans USING (doc_id) GROUP BY t.doc_id
"""


OP12 = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT)),
            lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS kind
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 0 THEN [] WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM t),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '?' END AS initial,
         right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
  FROM d),
f AS (
  SELECT *, last = '' AS blank, last <> '' AND seen > 1 AS duplicate, last <> '' AND seen = 1 AND last NOT IN ('.', '!', '?') AS truncated,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM o),
-- The cheapest repair of the rows from i on, by what came before: nothing, a system turn, a user turn, an assistant turn.
r AS (
  SELECT conv_id, max(i) + 1 AS i, {'c': 0::BIGINT, 'a': ''} AS n0, {'c': 6::BIGINT, 'a': 'II'} AS n1, {'c': 3::BIGINT, 'a': 'I'} AS n2, {'c': 0::BIGINT, 'a': ''} AS n3
  FROM f GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, list_min([b0, {'c': b2.c + 3, 'a': 'I' || b2.a}, {'c': b3.c + 6, 'a': 'II' || b3.a}]),
         list_min([b1, {'c': b2.c + 3, 'a': 'I' || b2.a}, {'c': b3.c + 6, 'a': 'II' || b3.a}]),
         list_min([b2, {'c': b3.c + 3, 'a': 'I' || b3.a}]), list_min([b3, {'c': b2.c + 3, 'a': 'I' || b2.a}])
  FROM (
    SELECT f.conv_id, f.i,
           list_min([{'c': n0.c + 4, 'a': 'D' || n0.a}] || CASE WHEN blank OR duplicate THEN [] ELSE
             [{'c': n2.c + more + CASE WHEN initial = 'u' THEN 0 ELSE 3 END, 'a': CASE WHEN initial = 'u' THEN 'K' ELSE 'R' END || n2.a}]
             || CASE WHEN initial = 's' THEN [{'c': n1.c + more, 'a': 'K' || n1.a}] ELSE [] END END) AS b0,
           list_min([{'c': n1.c + 4, 'a': 'D' || n1.a}] || CASE WHEN blank OR duplicate THEN [] ELSE
             [{'c': n2.c + more + CASE WHEN initial = 'u' THEN 0 ELSE 3 END, 'a': CASE WHEN initial = 'u' THEN 'K' ELSE 'R' END || n2.a}] END) AS b1,
           list_min([{'c': n2.c + 4, 'a': 'D' || n2.a}] || CASE WHEN blank OR duplicate THEN [] ELSE
             [{'c': n3.c + more + CASE WHEN initial = 'a' THEN 0 ELSE 3 END, 'a': CASE WHEN initial = 'a' THEN 'K' ELSE 'R' END || n3.a}] END) AS b2,
           list_min([{'c': n3.c + 4, 'a': 'D' || n3.a}] || CASE WHEN blank OR duplicate THEN [] ELSE
             [{'c': n2.c + more + CASE WHEN initial = 'u' THEN 0 ELSE 3 END, 'a': CASE WHEN initial = 'u' THEN 'K' ELSE 'R' END || n2.a}] END) AS b3
    FROM r JOIN (SELECT *, CASE WHEN truncated THEN 3 ELSE 0 END AS more FROM f) f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i - 1)),
best AS (SELECT conv_id, n0.c AS cost, n0.a AS audit FROM r WHERE i = 1),
-- The edits one by one; all turns written but the first system turn alternate, the user's first.
e AS (SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS p FROM best WHERE audit <> ''),
g AS (SELECT *, sum(CASE WHEN edit <> 'I' THEN 1 ELSE 0 END) OVER w AS i, sum(CASE WHEN edit <> 'D' THEN 1 ELSE 0 END) OVER w AS seat FROM e
      WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
h AS (SELECT g.conv_id, p, edit, seat, f.role, f.text, max(CASE WHEN seat = 1 AND edit = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY g.conv_id) AS led
      FROM g LEFT JOIN f ON edit <> 'I' AND f.conv_id IS NOT DISTINCT FROM g.conv_id AND f.i = g.i),
w AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (seat - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS whole
      FROM h WHERE edit <> 'D' GROUP BY conv_id),
s AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (truncated) AS truncated, count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM c.conv_id
"""


OP13 = rf"""
WITH p AS (
  SELECT lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, coalesce(text, '') AS text FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
g AS (
  SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda i: array_to_string(words[i:i + size - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3)) AS s(size)),
f AS (SELECT lang, size, phrase, count(*)::HUGEINT AS n FROM g GROUP BY ALL),
k AS (
  SELECT c.lang, c.phrase, c.n AS a, cut, l.n AS l, r.n AS r, (1000000::HUGEINT * c.n * c.n) // (l.n * r.n) AS score,
         row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (1000000::HUGEINT * c.n * c.n) // (l.n * r.n), cut) AS place
  FROM (SELECT f.*, cut, array_to_string(string_split(phrase, ' ')[:cut], ' ') AS head, array_to_string(string_split(phrase, ' ')[cut + 1:], ' ') AS tail
        FROM f, (VALUES (1), (2)) AS x(cut) WHERE size > cut AND n >= {phrases.LEAST}) c
  JOIN f l ON l.lang = c.lang AND l.phrase = c.head JOIN f r ON r.lang = c.lang AND r.phrase = c.tail),
held AS (
  SELECT lang, phrase, max(n) AS n FROM (
    SELECT lang, n, unnest([array_to_string(string_split(phrase, ' ')[:2], ' '), array_to_string(string_split(phrase, ' ')[2:], ' ')]) AS phrase
    FROM f WHERE size = 3 AND n >= {phrases.LEAST}) GROUP BY ALL),
ranked AS (
  SELECT k.*, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, k.phrase COLLATE "binary") AS rank
  FROM k LEFT JOIN held ON held.lang = k.lang AND held.phrase = k.phrase
  WHERE place = 1 AND (held.n IS NULL OR 100 * held.n < {phrases.WITHIN} * a))
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN (SELECT lang, sum(n) AS n FROM f WHERE size = 1 GROUP BY lang) t USING (lang) WHERE rank <= {phrases.TOP}
"""


def all_oracles() -> dict[str, str]:
    return {"op1_pq_duplicates": OP1, "op3_minhash": OP3, "op4_mix_sources": OP4, "op5_repetition": OP5, "op10_secret_scan": OP10,
            "op12_conversation_repair": OP12, "op13_phrase_graph": OP13}
