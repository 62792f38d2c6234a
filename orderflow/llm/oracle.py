"""DuckDB SQL for the queries that SQL can express.

Not here: extraction of page text, learned language profiles and references, template trees, and
links of secrets, which are tested against brute force, held-out rows and fixtures.
"""

from orderflow.llm.licenses import NOTICES, PHRASES
from orderflow.llm.licenses import WORD as LICENSE_WORD

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"


def _lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


def _escapes(text: str) -> str:
    """How many characters escaping puts into a text."""
    counts = [f"(length({text}) - length(replace({text}, '{mark}', ''))) // {len(mark)}" for mark in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "\\")]
    return " + ".join(counts)


_CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(7 + sum(25 + length(role) + length(text) + {_escapes('role')} + {_escapes('text')}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

_LINES = f"""
WITH documents_keyed AS (
  SELECT row_number() OVER () AS nth, doc_id, coalesce(CAST(doc_id AS BIGINT), 9223372036854775807) AS doc, text FROM documents
),
lines AS (
  SELECT nth, doc, text, i - 1 AS line,
    array_to_string(regexp_extract_all(string_split(text, chr(10))[i], '{_WORD}'), ' ') AS words,
    len(regexp_extract_all(string_split(text, chr(10))[i], '{_WORD}')) AS n
  FROM (SELECT *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents_keyed WHERE text IS NOT NULL)
),
entries AS (
  SELECT words, any_value(n) AS n, min(row(doc, text, line)) AS first FROM lines WHERE n >= 5 GROUP BY words
),
gaps AS (
  SELECT words, n, first, g,
    array_to_string(list_concat(string_split(words, ' ')[:g - 1], string_split(words, ' ')[g + 1:]), ' ') AS rest
  FROM (SELECT *, unnest(range(1, n + 1)) AS g FROM entries WHERE n >= 10)
),
near AS (
  SELECT words FROM (SELECT words, first, min(first) OVER (PARTITION BY n, g, rest) AS earliest FROM gaps) WHERE first > earliest
  UNION
  SELECT CASE WHEN gaps.first < entries.first THEN entries.words ELSE gaps.words END
  FROM gaps JOIN entries ON gaps.rest = entries.words AND entries.n >= 10
),
marked AS (
  SELECT nth, line, row(doc, text, line) > first AS again, near.words IS NOT NULL AS close
  FROM lines JOIN entries USING (words) LEFT JOIN near USING (words)
),
counts AS (
  SELECT nth, count(*) FILTER (again) AS n_exact, count(*) FILTER (close AND NOT again) AS n_near,
    list(line) FILTER (again OR close) AS gone
  FROM marked GROUP BY nth
)
SELECT doc_id,
  CAST(CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS BIGINT) AS n_lines,
  CAST(coalesce(n_exact, 0) AS BIGINT) AS n_exact, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
  sha256(array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(coalesce(gone, []), i - 1)), chr(10)))
    AS kept_sha256
FROM documents_keyed LEFT JOIN counts USING (nth)
"""

_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BENCHMARK = f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_lowered('text')}, '{_TERM}') AS w FROM benchmark
),
windows AS (
  SELECT DISTINCT item, array_to_string(w[i:i + 12], ' ') AS win, least(13, len(w)) AS size
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM items WHERE len(w) > 0)
),
docs AS (
  SELECT row_number() OVER () AS nth, doc_id, regexp_extract_all({_lowered('text')}, '{_TERM}') AS w FROM documents
),
places AS (
  SELECT nth, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
),
hits AS (SELECT places.*, item FROM places JOIN windows USING (win, size)),
hit_words AS (SELECT nth, count(DISTINCT spot) AS n_hit FROM (SELECT nth, unnest(range(i, i + size)) AS spot FROM hits) GROUP BY nth),
hit_items AS (SELECT nth, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY nth)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM docs LEFT JOIN hit_words USING (nth) LEFT JOIN hit_items USING (nth)
"""

_MIX = f"""
WITH sized AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
    coalesce(md5(CAST(doc_id AS VARCHAR)), 'g') AS place
  FROM documents
),
sources AS (
  SELECT *, [5, 2, 1][(nth - 1) % 3 + 1] AS weight, [1.5, 1.0, 0.5][(nth - 1) % 3 + 1]::DOUBLE AS a, [0.5, 1.0, 1.5][(nth - 1) % 3 + 1]::DOUBLE AS b
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM sized GROUP BY source)
),
rooms AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER before, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS unit
  FROM sources
  WINDOW before AS (ORDER BY 2 * source_size::DOUBLE / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (
  SELECT source, source_size, a, b,
    CASE WHEN 2 * source_size <= unit * weight THEN 2 * source_size::DOUBLE
      ELSE weight * (SELECT arg_min(unit, row(2 * source_size::DOUBLE / weight, nth)) FROM rooms WHERE 2 * source_size > unit * weight) END AS target
  FROM rooms
),
ordered AS (
  SELECT doc_id, size, source_size, target, a, b, CAST(round(target) AS BIGINT) AS wanted,
    coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
),
shared AS (
  SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS whole FROM ordered
),
taken AS (
  SELECT *, greatest(0, least(size, wanted - whole * source_size - start)) AS part FROM shared
),
first_pass AS (
  SELECT *, CASE WHEN whole > 0 THEN size ELSE part END AS words FROM taken
),
spent AS (
  SELECT *, CASE WHEN words > 0 THEN least(1.0::DOUBLE, (start + words::DOUBLE / 2) / target) END AS share FROM first_pass
)
SELECT doc_id, size, source_size, target, CAST(whole * size + part AS BIGINT) AS taken,
  CASE WHEN a = b THEN share ELSE (sqrt(a * a + (b - a) * (a + b) * share) - a) / (b - a) END AS position
FROM spent
"""

_JACCARD = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS nth, CAST(doc_id AS BIGINT) AS doc_id, regexp_extract_all({_lowered('text')}, '{_WORD}') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT nth, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT nth, count(*) AS n FROM shingles GROUP BY nth),
links AS (
  SELECT a.nth AS a, b.nth AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.nth <> b.nth
  JOIN sizes na ON na.nth = a.nth JOIN sizes nb ON nb.nth = b.nth
  WHERE 100 * least(na.n, nb.n) >= 75 * greatest(na.n, nb.n)
  GROUP BY a.nth, b.nth, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))
),
reached AS (
  SELECT nth AS a, nth AS b FROM docs
  UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
)
SELECT d.doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles,
  CASE WHEN sizes.n IS NULL THEN d.doc_id ELSE min(o.doc_id) END AS component_id
FROM docs d LEFT JOIN sizes USING (nth) JOIN reached ON reached.a = d.nth JOIN docs o ON o.nth = reached.b
GROUP BY d.nth, d.doc_id, sizes.n
"""

_TEMPLATES = ",\n    ".join(
    f"({k}, '{t.label}', {str(t.ordered).lower()}, {len(t.words)}, {t.needed}, {t.span}, {t.sequence})" for k, t in enumerate(PHRASES + NOTICES)
)

_LICENSES = rf"""
WITH templates(t, label, ordered, size, needed, span, sequence) AS (VALUES
    {_TEMPLATES}
),
docs AS (
  SELECT row_number() OVER () AS nth, doc_id, regexp_extract_all({_lowered('text')}, '{LICENSE_WORD}') AS w FROM documents
),
placed AS (SELECT nth, place - 1 AS place, w[place] AS word FROM (SELECT *, unnest(range(1, len(w) + 1)) AS place FROM docs)),
places AS (
  SELECT p.*, v.* EXCLUDE (word) FROM placed p
  JOIN (SELECT DISTINCT t, label, ordered, size, needed, span, unnest(sequence) AS word FROM templates) v ON p.word = v.word
),
blocks AS (
  SELECT a.nth, a.t, a.label, a.place, count(DISTINCT b.word) / a.size AS share
  FROM places a JOIN places b ON a.nth = b.nth AND a.t = b.t AND b.place >= a.place AND b.place < a.place + a.span
  WHERE NOT a.ordered GROUP BY a.nth, a.t, a.label, a.place, a.size, a.needed HAVING count(DISTINCT b.word) >= a.needed
),
phrases AS (
  SELECT p.nth, t.label, p.place FROM placed p JOIN templates t ON t.ordered AND p.word = t.sequence[1]
  JOIN docs d ON d.nth = p.nth WHERE d.w[p.place + 1:p.place + len(t.sequence)] = t.sequence
),
base AS (
  SELECT nth, count(*) AS n, min(place) AS first, max(place) AS last, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM phrases GROUP BY nth
),
every AS (
  SELECT nth, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT nth, label, share FROM blocks UNION ALL SELECT nth, label, 1.0 FROM phrases) GROUP BY nth
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base,
  CAST(base.first AS BIGINT) AS first_word, CAST(base.last AS BIGINT) AS last_word,
  coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels, CAST(coalesce(every.score, 0) AS DOUBLE) AS score
FROM docs d LEFT JOIN base ON base.nth = d.nth LEFT JOIN every ON every.nth = d.nth
"""

_FIELDS = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "text")


def _leaf(*fields: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({x})) || ':' || {x}, '-')" for x in fields) + ")"


#: CRC-32 of an id in decimal, bit by bit.
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""
_PARENTS = "list_transform(range(0, (len(d) + 1) // 2), lambda i: sha256(d[2 * i + 1] || coalesce(d[2 * i + 2], '')))"
#: The sibling of a leaf on a level, with its side; a dash where it has none.
_STEP = "CASE WHEN len(d) > 1 THEN CASE WHEN (place >> level) % 2 = 1 THEN 'L' || d[(place >> level)] ELSE coalesce('R' || d[(place >> level) + 2], '-') END END"
_MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM (
    SELECT doc_id, lang, {_leaf(*_FIELDS)} AS leaf,
      CASE WHEN {_CRC} % 7 = 0 AND n_chars IS NOT NULL THEN {_leaf(_FIELDS[0], _FIELDS[1], _FIELDS[2], "CAST(n_chars + 1 AS VARCHAR)", _FIELDS[4])} END AS tampered
    FROM documents)
),
levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS d FROM leaves GROUP BY lang
  UNION ALL SELECT lang, level + 1, {_PARENTS} FROM levels WHERE len(d) > 1
),
subroots AS (
  SELECT lang, d[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM levels WHERE len(d) = 1
),
tops AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS d FROM subroots
  UNION ALL SELECT level + 1, {_PARENTS} FROM tops WHERE len(d) > 1
),
lower_paths AS (
  SELECT l.lang, l.place, list({_STEP} ORDER BY level) AS path FROM leaves l JOIN levels v ON l.lang IS NOT DISTINCT FROM v.lang GROUP BY l.lang, l.place
),
upper_paths AS (
  SELECT lang, subroot, list({_STEP} ORDER BY level) AS path FROM subroots CROSS JOIN tops GROUP BY lang, subroot
),
paths AS (
  SELECT l.doc_id, l.leaf, u.subroot, l.tampered, list_filter(list_concat(p.path, u.path), lambda x: x IS NOT NULL) AS path
  FROM leaves l JOIN lower_paths p ON l.lang IS NOT DISTINCT FROM p.lang AND l.place = p.place
  JOIN upper_paths u ON l.lang IS NOT DISTINCT FROM u.lang
),
folded AS (
  SELECT *, (SELECT d[1] FROM tops WHERE len(d) = 1) AS root, sha256(array_to_string(list_transform(path, lambda x: substr(x, 2)), '')) AS proof_sha256,
    list_reduce(list_concat([coalesce(tampered, leaf)], path), lambda a, x: sha256(
      CASE left(x, 1) WHEN 'L' THEN substr(x, 2) || a WHEN 'R' THEN a || substr(x, 2) ELSE a END)) AS folded_root
  FROM paths
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""

ORACLE_SQL: dict[str, str] = {
    "op5_chat_formatting": _CHAT,
    "op6_line_dedup": _LINES,
    "op8_decontamination": _BENCHMARK,
    "op9_curriculum": _MIX,
    "op10_jaccard_join": _JACCARD,
    "op11_license_scans": _LICENSES,
    "op12_merkle_manifest": _MERKLE,
}
