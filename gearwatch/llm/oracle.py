"""SQL, written for DuckDB over the given tables, that must give the rows of the text queries."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = r"[\x20\x09-\x0D]+"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{BLANKS}'), lambda x: x <> '')"


TEXTS = f"""texts AS (SELECT doc_id, coalesce(text, '') AS text, {words("coalesce(text, '')")} AS words FROM documents)"""

QUALITY = f"""WITH {TEXTS},
counted AS (SELECT *, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines,
  length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')) AS letters, length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) AS capitals,
  length(regexp_replace(text, '[^!]', '', 'g')) AS closers FROM texts),
windows AS (SELECT doc_id, pos, array_to_string(words[pos:pos + 7], ' ') AS content FROM counted, unnest(range(1, greatest(n_words - 6, 1))) r(pos)),
repeated AS (SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, content) > 1),
covered AS (SELECT doc_id, count(DISTINCT place) AS n FROM repeated, unnest(range(pos, pos + 8)) r(place) GROUP BY doc_id),
judged AS (SELECT c.*, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(v.n, 0) AS n_repeat_words FROM counted c LEFT JOIN covered v USING (doc_id)),
based AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM judged)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > len(lines) OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 2 * capitals > letters
    OR 2 * letters < word_chars OR 3 * closers > n_words OR (n_words >= 50 AND 20 * len(list_distinct(words)) < n_words)) AS kept FROM based"""

JACCARD = f"""WITH RECURSIVE lowered AS (SELECT doc_id, {words(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS words FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(words[pos:pos + 3], ' ') AS s FROM lowered, unnest(range(1, greatest(len(words) - 2, least(len(words), 1) + 1))) r(pos)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS b FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)"""

BYTES = """WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
windows AS (SELECT doc_id, pos, md5(substr(h, 2 * pos + 1, 200)) AS w FROM texts, unnest(range(0, greatest(n - 99, 0))) r(pos)),
starts AS (SELECT doc_id, pos FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) > 1),
places AS (SELECT t.doc_id, p.pos, substr(h, 2 * p.pos + 1, 2) AS byte, s.pos AS start FROM texts t, unnest(range(0, n)) p(pos) LEFT JOIN starts s ON s.doc_id = t.doc_id AND s.pos = p.pos),
marked AS (SELECT *, coalesce(max(start) OVER (PARTITION BY doc_id ORDER BY pos) > pos - 100, false) AS gone FROM places),
edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM marked),
summed AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans, string_agg(byte, '' ORDER BY pos) FILTER (NOT gone) AS kept FROM edges GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM texts LEFT JOIN summed USING (doc_id)"""

PASSAGES = f"""WITH {TEXTS},
windows AS (SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) AS w FROM texts, unnest(range(1, greatest(len(words) - 48, 1))) r(pos)),
starts AS (SELECT doc_id, pos FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY w)),
places AS (SELECT t.doc_id, p.pos, words[p.pos] AS word, s.pos AS start FROM texts t, unnest(range(1, len(words) + 1)) p(pos) LEFT JOIN starts s ON s.doc_id = t.doc_id AND s.pos = p.pos),
marked AS (SELECT *, coalesce(max(start) OVER (PARTITION BY doc_id ORDER BY pos) > pos - 50, false) AS gone FROM places),
summed AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM marked GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM texts LEFT JOIN summed USING (doc_id)"""


def licenses(templates: dict[str, tuple[str, ...]], phrases: dict[str, str]) -> str:
    def tokens(text: str) -> str:
        return f"regexp_extract_all(translate({text}, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

    def literal(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    rows = ", ".join(f"({literal(label)}, {literal(text)})" for label, texts in templates.items() for text in texts)
    known = ", ".join(f"({literal(label)}, string_split({literal(phrase)}, ' '))" for phrase, label in phrases.items())
    return f"""WITH texts AS (SELECT doc_id, {tokens("coalesce(text, '')")} AS words FROM documents),
phrases AS (SELECT * FROM (VALUES {known}) v(label, phrase)),
base AS (SELECT doc_id, count(*) AS n_base, min(pos) - 1 AS first_word, max(pos) - 1 AS last_word, list(DISTINCT label) AS found
  FROM texts, phrases, unnest(range(1, len(words) + 1)) r(pos) WHERE list_contains(words, phrase[-1]) AND words[pos:pos + len(phrase) - 1] = phrase GROUP BY doc_id),
templates AS (SELECT label, {tokens("content")} AS ts FROM (VALUES {rows}) v(label, content)),
sized AS (SELECT row_number() OVER () AS nth, label, list_distinct(ts) AS kinds, len(ts) + len(ts) // 2 AS width FROM templates),
apart AS (SELECT a.nth, unnest(a.kinds) AS word, b.kinds AS others FROM sized a JOIN sized b ON a.label <> b.label AND len(list_intersect(a.kinds, b.kinds)) >= 0.8 * len(a.kinds)),
must AS (SELECT nth, list(DISTINCT word) AS musts FROM apart WHERE NOT list_contains(others, word) GROUP BY nth),
likely AS (SELECT doc_id, label, words, kinds, coalesce(musts, []) AS musts, least(width, len(words)) AS width FROM texts, sized LEFT JOIN must USING (nth)
  WHERE len(list_intersect(list_distinct(words), kinds)) >= 0.8 * len(kinds) AND list_has_all(list_distinct(words), coalesce(musts, []))),
shares AS (SELECT doc_id, label, len(list_intersect(list_distinct(words[pos:pos + width - 1]), kinds)) / len(kinds) AS share
  FROM likely, unnest(range(1, len(words) - width + 2)) r(pos) WHERE list_has_all(words[pos:pos + width - 1], musts)),
blocks AS (SELECT doc_id, list(DISTINCT label) AS found, max(share) AS score FROM shares WHERE share >= 0.8 - 1e-12 GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(list_sort(b.found), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.found, []), coalesce(k.found, [])))), ','), '') AS labels, coalesce(score, 0.0) AS score
FROM texts LEFT JOIN base b USING (doc_id) LEFT JOIN blocks k USING (doc_id)"""


MIXING = """WITH RECURSIVE counts AS (SELECT coalesce('s' || source, '') AS key, count(*) AS n FROM documents GROUP BY 1),
roots AS (SELECT key, n, CAST(floor(sqrt(n) * 1000) AS BIGINT) AS size FROM counts),
shares AS (SELECT key, n, greatest(1, size * 1000 // greatest((SELECT sum(size) FROM roots), 1))::BIGINT AS slots FROM roots),
one AS (SELECT list(key ORDER BY key) AS keys, list(slots ORDER BY key) AS c, sum(slots)::BIGINT AS period FROM shares),
steps AS (SELECT -1::BIGINT AS t, list_transform(c, lambda x: 0::BIGINT) AS done, 0::BIGINT AS pick FROM one
  UNION ALL
  SELECT t + 1, list_transform(done, lambda d, i: d + CASE WHEN i = chosen THEN 1 ELSE 0 END), chosen FROM (
    SELECT t, done, list_sort(list_filter(list_transform(c, lambda x, i: CASE WHEN floor(done[i] * period / x) <= t + 1 THEN {'deadline': ceil((done[i] + 1) * period / x), 'i': i} END), lambda x: x IS NOT NULL))[1].i AS chosen
    FROM steps, one WHERE t + 1 < period)),
plan AS (SELECT keys[pick] AS key, t AS pos, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS nth FROM steps, one WHERE t >= 0),
ends AS (SELECT min((missing // slots) * period + pos) AS horizon FROM (SELECT *, (n + 7) // 8 AS missing FROM shares) s JOIN plan p ON p.key = s.key AND p.nth = missing % slots, one),
numbered AS (SELECT doc_id, source, coalesce('s' || source, '') AS key, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS number FROM documents),
timed AS (SELECT d.*, slots, number // 8 AS block, (number // 8) % slots AS nth, ((number // 8) // slots) * period AS start, period, horizon FROM numbered d JOIN shares USING (key), one, ends)
SELECT doc_id, source, block, CAST(start + floor(t.nth * period / slots) AS BIGINT) AS release, CAST(start + ceil((t.nth + 1) * period / slots) AS BIGINT) AS deadline,
  start + pos AS slot, (start + pos) * 8 + number % 8 AS position, start + pos < horizon AS in_mix
FROM timed t JOIN plan p ON p.key = t.key AND p.nth = t.nth"""


def clusters(centroids: int = 8, rounds: int = 10, dimensions: int = 64, scale: int = 1024, salt: str = "3") -> str:
    """All exact distances in every round, without bounds."""

    def assigned(number: int) -> str:
        return f"""a{number} AS MATERIALIZED (SELECT row, vec_id, e, k, distance FROM (
  SELECT v.row, v.vec_id, v.e, c.k, list_sum(list_transform(list_zip(v.e, c.m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance FROM points v, c{number} c)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, k) = 1)"""

    def moved(number: int) -> str:
        return f"""c{number + 1} AS MATERIALIZED (SELECT c.k, coalesce(g.m, c.m) AS m FROM c{number} c LEFT JOIN (
  SELECT k, list(m ORDER BY d) AS m FROM (SELECT k, d, ((sum(e[d]) - ((sum(e[d]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
    FROM a{number}, range(1, {dimensions + 1}) r(d) GROUP BY k, d) GROUP BY k) g USING (k))"""

    steps = ",\n".join(f"{assigned(i)},\n{moved(i)}" for i in range(rounds))
    return f"""WITH points AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS k, e AS m FROM (SELECT e, sha256('{salt}:' || vec_id) AS h FROM points ORDER BY h LIMIT {centroids})),
{steps},
{assigned(rounds)}
SELECT vec_id, k::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (k)"""


VARIANTS = f"""WITH RECURSIVE halves AS (SELECT b, list_reduce(list_prepend(b::BIGINT, range(0, 8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t FROM range(0, 256) r(b)),
bits AS (SELECT list(t ORDER BY b) AS tab FROM halves),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), '{UPPER}', '{LOWER}') AS run FROM documents) GROUP BY ALL),
bytes AS (SELECT *, list_transform(range(0, strlen(doc_id || ':' || run)), lambda i: ('0x' || substr(hex(encode(doc_id || ':' || run)), 2 * i::INT + 1, 2))::BIGINT) AS b FROM runs),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, bits),
drawn AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed),
vocabulary AS (SELECT word, sum(n)::BIGINT AS n FROM drawn WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
holes AS (SELECT word, n, left(word, i::INT) || '*' || substr(word, i::INT + 2) AS hole, left(word, i::INT) || substr(word, i::INT + 2) AS short FROM vocabulary, unnest(range(0, length(word))) r(i)),
near AS (SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT h.word, v.word, v.n FROM holes h JOIN vocabulary v ON v.word = h.short UNION SELECT v.word, h.word, h.n FROM holes h JOIN vocabulary v ON v.word = h.short),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS other, max(n) AS other_n FROM near GROUP BY word),
formed AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form, CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n FROM vocabulary v LEFT JOIN best b USING (word)),
walk AS (SELECT word, word AS at FROM formed UNION ALL SELECT w.word, f.form FROM walk w JOIN formed f ON f.word = w.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN walk w ON w.word = f.word JOIN formed e ON e.word = w.at WHERE e.form IS NULL"""
