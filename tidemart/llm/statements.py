"""The operators' results as DuckDB statements, where SQL can express them."""

from __future__ import annotations

OP11_SQL = r"""
WITH RECURSIVE rows AS (
  SELECT *, row_number() OVER () AS row,
    sha256(coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
        || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-')
        || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    sha256(coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
        || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode((n_chars + 1)::VARCHAR)) || ':' || (n_chars + 1), '-')
        || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS tampered,
    -- crc32, bit by bit over the digits of the id
    xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(list_filter(string_split(doc_id::VARCHAR, ''), lambda c: c <> ''),
          lambda c: [1000 + ascii(c), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]))),
        lambda h, x: CASE WHEN x >= 1000 THEN xor(h, x - 1000) WHEN h & 1 = 1 THEN xor(h >> 1, 3988292384) ELSE h >> 1 END), 4294967295) % 7 = 0 AS chosen
  FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS pos FROM rows),
groups AS (SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM leaves GROUP BY lang),
nodes AS (
  SELECT g.place AS tree, 0 AS level, pos, leaf AS hash, n AS size FROM leaves JOIN groups g ON leaves.lang IS NOT DISTINCT FROM g.lang
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (max(size) + 1) // 2 FROM nodes WHERE size > 1 GROUP BY tree, level, pos // 2),
tops AS (
  SELECT 0 AS level, tree AS pos, hash, (SELECT count(*) FROM groups) AS size FROM nodes WHERE size = 1
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (max(size) + 1) // 2 FROM tops WHERE size > 1 GROUP BY level, pos // 2),
steps AS (
  SELECT l.row, n.level AS step, (l.pos >> n.level) % 2 AS slot, n.hash
  FROM leaves l JOIN groups g ON l.lang IS NOT DISTINCT FROM g.lang
  JOIN nodes own ON own.tree = g.place AND own.size > 1 AND own.pos = l.pos >> own.level
  LEFT JOIN nodes n ON n.tree = g.place AND n.level = own.level AND n.pos = xor(own.pos, 1)
  WHERE n.hash IS NOT NULL
  UNION ALL
  SELECT l.row, 1000 + n.level, (g.place >> n.level) % 2, n.hash
  FROM leaves l JOIN groups g ON l.lang IS NOT DISTINCT FROM g.lang
  JOIN tops own ON own.size > 1 AND own.pos = g.place >> own.level
  JOIN tops n ON n.level = own.level AND n.pos = xor(own.pos, 1)),
heights AS (SELECT tree, max(level) AS height FROM nodes GROUP BY tree),
levels AS (
  SELECT l.row, x.step FROM leaves l JOIN groups g ON l.lang IS NOT DISTINCT FROM g.lang JOIN heights h ON h.tree = g.place,
    unnest(list_concat(range(h.height), range(1000, 1000 + (SELECT max(level) FROM tops)))) AS x(step)),
paths AS (
  SELECT v.row, sha256(coalesce(string_agg(s.hash, '' ORDER BY v.step), '')) AS proof,
    list(CASE WHEN s.hash IS NULL THEN '-' WHEN s.slot = 1 THEN '<' || s.hash ELSE '>' || s.hash END ORDER BY v.step) AS path
  FROM levels v LEFT JOIN steps s ON s.row = v.row AND s.step = v.step GROUP BY v.row),
folded AS (
  SELECT l.row, list_reduce(list_prepend(CASE WHEN l.chosen AND l.n_chars IS NOT NULL THEN l.tampered ELSE l.leaf END, coalesce(p.path, [])),
      lambda h, s: sha256(CASE WHEN s[1] = '<' THEN s[2:] || h WHEN s[1] = '>' THEN h || s[2:] ELSE h END)) AS root, coalesce(p.proof, sha256('')) AS proof
  FROM leaves l LEFT JOIN paths p ON p.row = l.row)
SELECT l.doc_id, l.leaf, n.hash AS subroot, t.hash AS root, f.proof AS proof_sha256, f.root AS folded_root, f.root = t.hash AS verified
FROM leaves l JOIN groups g ON l.lang IS NOT DISTINCT FROM g.lang JOIN nodes n ON n.tree = g.place AND n.size = 1
JOIN tops t ON t.size = 1 JOIN folded f ON f.row = l.row
"""

#: Kinds of op12 with their patterns, in the order of the list.
_KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z][A-Z][0-9][0-9](?:\x20?[A-Z0-9][A-Z0-9][A-Z0-9][A-Z0-9]){2,7}(?:\x20?[A-Z0-9]{1,3})?",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "local": r"(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}",
}
_PROPOSED = " UNION ALL ".join(
    f"SELECT id, {k} AS place, '{kind}' AS kind, regexp_extract_all(text, '{p}') AS matches, regexp_split_to_array(text, '{p}') AS gaps FROM d"
    for k, (kind, p) in enumerate(_KINDS.items())
)

OP12_SQL = (
    r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
p AS ("""
    + _PROPOSED
    + r"""),
o AS (SELECT id, place, kind, matches[i] AS m, right(gaps[i], 48) AS before, left(gaps[i + 1], 48) AS after,
        list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(matches[1:i - 1], lambda x: length(x))), 0) AS start
      FROM (SELECT *, unnest(range(1, len(matches) + 1)) AS i FROM p)),
t AS (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS n, unnest(CASE WHEN kind = 'iban'
          THEN [m, regexp_replace(m, '\x20[^\x20]*$', ''), regexp_replace(regexp_replace(m, '\x20[^\x20]*$', ''), '\x20[^\x20]*$', '')] ELSE [m] END) AS cut FROM o),
c AS (SELECT *, replace(cut, ' ', '') AS a FROM t),
v AS (SELECT *, CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(m, '.'), lambda x: x::HUGEINT > 255)) = 0
    WHEN 'card' THEN length(n) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(n) + 1), lambda k:
        CASE WHEN (length(n) - k) % 2 = 1 THEN CASE WHEN n[k]::INT > 4 THEN 2 * n[k]::INT - 9 ELSE 2 * n[k]::INT END ELSE n[k]::INT END)) % 10 = 0
    WHEN 'phone' THEN length(n) BETWEEN 9 AND 15
    WHEN 'iban' THEN length(a) BETWEEN 15 AND 34
        AND NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT (cut = m AND regexp_matches(after, '^[A-Za-z0-9]'))
        AND list_reduce(list_prepend(0, list_transform(string_split(a[5:] || a[:4], ''), lambda x: CASE WHEN x = '' THEN -1 WHEN ascii(x) < 65 THEN ascii(x) - 48 ELSE ascii(x) - 55 END)),
              lambda r, x: CASE WHEN x < 0 THEN r WHEN x < 10 THEN (r * 10 + x) % 97 ELSE (r * 100 + x) % 97 END) = 1
    WHEN 'ssn' THEN NOT regexp_matches(before, '[A-Za-z0-9-]$') AND NOT regexp_matches(after, '^[A-Za-z0-9-]')
        AND regexp_matches(lower(before || ' ' || after), '\b(ssn|social)')
    ELSE NOT regexp_matches(before, '([A-Za-z0-9(.-]|\+[0-9]{0,3}[\x20.-]{0,2})$') AND NOT regexp_matches(after, '^[A-Za-z0-9-]')
        AND regexp_matches(lower(before || ' ' || after), '\b(phone|tel|call|mobile|fax|whatsapp|handy)') END AS good FROM c),
s AS (SELECT id, place, kind, start, max(start + length(cut)) AS stop FROM v WHERE good GROUP BY id, place, kind, start),
l AS (SELECT id, count(*) FILTER (WHERE kind = 'email') AS n_email, count(*) FILTER (WHERE kind = 'ip') AS n_ip, count(*) FILTER (WHERE kind = 'card') AS n_card,
        count(*) FILTER (WHERE kind = 'phone') AS n_phone,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY place, start) FILTER (WHERE place < 4) AS base,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY place, start) AS spans FROM s GROUP BY id)
SELECT d.doc_id, coalesce(l.n_email, 0)::BIGINT AS n_email, coalesce(l.n_ip, 0)::BIGINT AS n_ip, coalesce(l.n_card, 0)::BIGINT AS n_card,
  coalesce(l.n_phone, 0)::BIGINT AS n_phone, sha256(coalesce(l.base, '')) AS base_sha256, coalesce(l.spans, '') AS spans
FROM d LEFT JOIN l ON l.id = d.id
"""
)

OP13_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT id, lang, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS k FROM t),
w AS (SELECT lang, id, k, words, unnest(range(1, len(words) + 1)) AS i FROM (SELECT *, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p)),
g AS (SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase FROM w, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE i + size - 1 <= len(words)),
f AS (SELECT lang, size, phrase, count(*) AS n FROM g GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND n >= 30),
cuts AS (SELECT lang, phrase, a, k, array_to_string(words[:k], ' ') AS first, array_to_string(words[k + 1:], ' ') AS rest
         FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
s AS (SELECT cuts.lang, cuts.phrase, cuts.a, cuts.k, x.n AS l, y.n AS r, ((2000000::HUGEINT * cuts.a) // (x.n::HUGEINT + y.n))::BIGINT AS score
      FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.first JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.rest),
lowest AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, array_to_string(words[b:b + n - 1], ' ') AS phrase, max(a) AS around
           FROM (SELECT *, unnest(range(1, size - n + 2)) AS b FROM c, (SELECT unnest([2, 3]) AS n) WHERE n < size) GROUP BY ALL),
open AS (SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE NOT coalesce(100::HUGEINT * around >= 80::HUGEINT * a, false)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM open)
SELECT lang, rank, phrase, a, l, r, totals.n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
