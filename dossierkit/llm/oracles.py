"""DuckDB SQL that states what the queries must return."""

from __future__ import annotations

from dossierkit.llm import embeddings, licenses, negatives, preferences, sharding, spelling

_BYTES = "list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::bigint)"


# CRC-32's table from the rule of its polynomial, as the one row of a table.
_STEP = "case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end"
CRC_TABLE = f"(SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda v, i: {_STEP}, b)) AS crc_table)"


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8, byte by byte; needs ``CRC_TABLE`` beside the text."""
    walk = "lambda v, b: xor(v >> 8, crc_table[(xor(v, b) & 255) + 1])"
    return f"xor(list_reduce({_BYTES.format(text=text)}, {walk}, 4294967295::bigint), 4294967295)"


def _shard(shards: int) -> str:
    scores = []
    for s in range(shards):
        total = " + ".join(f"h[{i + 1}] * {f}" for i, f in enumerate(sharding.factors(s)))
        scores.append(f"{{'v': ({total}) % {sharding.PRIME}, 's': {-s}}}")
    return f"(-list_max([{', '.join(scores)}]).s)::integer"


SHARDING = f"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, list_transform(range(4), lambda i: ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 8 * i + 1, 8))::bigint) AS h
  FROM documents),
dealt AS (
  SELECT doc_id, (strlen(t) + 1)::bigint AS size, {crc32('t')}::bigint AS text_crc32, 'key' AS law, h[1] AS a,
         {_shard(16)} AS shard, {_shard(17)} AS grown_shard
  FROM hashed, {CRC_TABLE})
SELECT doc_id, size, text_crc32, law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY a, doc_id, size, text_crc32) - 1)::bigint AS slot, grown_shard
FROM dealt
"""


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LOWER = "translate(coalesce({0}, ''), '" + licenses.UPPER + "', '" + licenses.LOWER + "')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _places() -> str:
    parts = []
    for phrase, label in licenses.PHRASES.items():
        words = licenses.words_of(phrase)
        same = " AND ".join(f"w[i + {k + 1}] = {_sql(x)}" for k, x in enumerate(words))
        parts.append(f"SELECT doc_id, unnest(list_filter(range(len(w)), lambda i: {same})) AS start, {_sql(label)} AS label FROM words")
    return " UNION ALL ".join(parts)


def _templates() -> str:
    """Label, distinct words, those of the label and the longest window of each template."""
    rows = []
    for name, text in licenses.TEMPLATES.items():
        words, label = [w for w in licenses.words_of(text) if w], name.split("/")[0]
        own = sorted(set(licenses.words_of(label)) & set(words))
        lists = ", ".join(f"[{', '.join(map(_sql, x))}]" if x else "[]::varchar[]" for x in (sorted(set(words)), own))
        rows.append(f"({_sql(label)}, {lists}, {licenses.SPREAD * len(words)})")
    return f"(VALUES {', '.join(rows)}) AS t(label, need, own, span)"


_WINDOW = "list_distinct(w[i:i + span - 1])"
_HELD = f"CASE WHEN len(list_intersect({_WINDOW}, own)) = len(own) THEN len(list_intersect({_WINDOW}, need)) ELSE 0 END"
LICENSES = f"""
WITH words AS (SELECT row_number() OVER () AS id, doc_id, {_WORDS.format('text')} AS w FROM documents),
places AS ({_places().replace("SELECT doc_id", "SELECT id")}),
base AS (
  SELECT id, count(*) AS n, min(start) AS lo, max(start) AS hi, list(DISTINCT label) AS labels
  FROM places GROUP BY id),
likely AS (
  SELECT id, w, label, need, own, span FROM words, {_templates()}
  WHERE len(list_intersect(list_distinct(w), need)) >= {licenses.THRESHOLD} * len(need)),
windows AS (
  SELECT id, label, need, list_max(list_transform(list_filter(range(1, len(w) + 1), lambda i: list_contains(need, w[i])), lambda i: {_HELD})) AS best
  FROM likely),
method AS (
  SELECT id, list(DISTINCT label) AS labels, max(best / len(need)) AS best FROM windows
  WHERE best >= {licenses.THRESHOLD} * len(need) GROUP BY id)
SELECT d.doc_id, len(d.w)::bigint AS n_words, coalesce(b.n, 0)::bigint AS n_base, b.lo::bigint AS first_word,
       b.hi::bigint AS last_word, coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ','), '') AS labels,
       coalesce(m.best, 0.0)::double AS score
FROM words d LEFT JOIN base b USING (id) LEFT JOIN method m USING (id)
"""


EMBEDDINGS = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::double[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {embeddings.COSINE}),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id)::bigint AS n_links, r.low AS component_id, r.low = e.vec_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) r ON r.a = e.vec_id
"""


def _text(value: str) -> str:
    return _sql(value).replace("\n", "' || chr(10) || '")


_HEAD = f"{_text(preferences.OPEN)} || coalesce(role, '') || {_text(preferences.AFTER_ROLE)}"
_BODY = f"coalesce(text, '') || {_text(preferences.CLOSE)}"


def _side(name: str) -> str:
    """Rendered completion and mask of a side, behind the common turns."""
    return f"""
  SELECT s.conv_id, string_agg(head || body, '' ORDER BY pos) AS whole,
         coalesce(string_agg((begun + length(head))::varchar || '-' || (begun + length(head) + length(body))::varchar, ','
                  ORDER BY pos) FILTER (role = '{preferences.LEARNED}'), '') AS mask
  FROM (SELECT {name}.conv_id, pos, role, {_HEAD} AS head, {_BODY} AS body,
               coalesce(sum(length({_HEAD}) + length({_BODY})) OVER (
                 PARTITION BY {name}.conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS begun
        FROM {name} JOIN prefix USING (conv_id) WHERE pos > n) s GROUP BY s.conv_id"""


_ORDER = "row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos"
PREFERENCES = f"""
WITH replies AS (
  SELECT conv_id, max({{'turn': turn, 'text': text}}) AS last FROM conversations WHERE role = '{preferences.LEARNED}' GROUP BY conv_id),
changed AS (
  SELECT c.conv_id, turn, role,
         CASE WHEN role = '{preferences.LEARNED}' AND r.last.turn IS NOT DISTINCT FROM turn AND r.last.text IS NOT DISTINCT FROM text
              THEN coalesce(o.last.text, '') ELSE text END AS text
  FROM conversations c LEFT JOIN replies r ON r.conv_id = c.conv_id LEFT JOIN replies o ON o.conv_id = c.conv_id + 1),
a AS (SELECT conv_id, role, text, {_ORDER} FROM conversations WHERE conv_id IS NOT NULL),
b AS (SELECT conv_id, role, text, {_ORDER} FROM changed WHERE conv_id IS NOT NULL),
prefix AS (
  SELECT a.conv_id, coalesce(min(a.pos) FILTER (a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text), max(a.pos) + 1) - 1 AS n
  FROM a JOIN b ON a.conv_id = b.conv_id AND a.pos = b.pos GROUP BY a.conv_id),
prompts AS (
  SELECT conv_id, string_agg({_HEAD} || {_BODY}, '' ORDER BY pos) AS prompt FROM a JOIN prefix USING (conv_id) WHERE pos <= n GROUP BY conv_id),
ca AS ({_side("a")}),
cb AS ({_side("b")})
SELECT p.conv_id, n::bigint AS n_prompt_turns, coalesce(prompt, '') AS prompt, coalesce(ca.whole, '') AS chosen,
       coalesce(cb.whole, '') AS rejected, coalesce(ca.mask, '') AS chosen_mask, coalesce(cb.mask, '') AS rejected_mask
FROM prefix p LEFT JOIN prompts USING (conv_id) LEFT JOIN ca ON ca.conv_id = p.conv_id LEFT JOIN cb ON cb.conv_id = p.conv_id
"""


NEGATIVES = f"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({negatives.SCALE} * x::double)::bigint) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS anchor, a.label AS own, b.vec_id AS id, b.label, list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::bigint AS score
  FROM usable a JOIN usable b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT anchor, id, score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= {negatives.POSITIVES}),
found AS (
  SELECT p.anchor, p.id AS positive, p.score AS positive_score, s.id, s.score,
         row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM positive p JOIN scored s ON s.anchor = p.anchor AND s.label <> s.own
   AND {negatives.LOW} * p.score <= 100 * s.score AND 100 * s.score <= {negatives.HIGH} * p.score)
SELECT anchor AS anchor_id, positive AS positive_id, rank::integer AS rank, id AS negative_id, positive_score, score AS negative_score
FROM found WHERE rank <= {negatives.NEGATIVES}
"""


_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, {_A_TO_Z}), '[{spelling.LETTERS}]+')) AS run FROM documents),
hashed AS (
  SELECT run, {crc32("coalesce(doc_id::varchar, '') || ':' || run")} AS h
  FROM runs, {CRC_TABLE} WHERE length(run) >= {spelling.SHORTEST}),
words AS (
  SELECT CASE WHEN h % {spelling.DAMAGE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, count(*) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= {spelling.SHORTEST} AND n >= {spelling.LEAST_COUNT}),
rests AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) AS t(i)),
pairs AS (
  SELECT a.word, b.word AS other FROM rests a JOIN rests b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM rests a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM rests a JOIN words b ON a.rest = b.word),
best AS (
  SELECT p.word, count(*) AS n_near, min({{'less': -o.n, 'other': p.other}}) AS top
  FROM pairs p JOIN words o ON o.word = p.other GROUP BY p.word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.less >= {spelling.TIMES} * w.n THEN top.other END AS form,
         CASE WHEN -top.less >= {spelling.TIMES} * w.n THEN -top.less END AS form_n
  FROM words w LEFT JOIN best USING (word)),
path AS (
  SELECT word, word AS at, form AS next FROM formed
  UNION ALL SELECT path.word, f.word, f.form FROM path JOIN formed f ON f.word = path.next)
SELECT f.word, f.form, p.at AS root, f.n::bigint AS n, f.n_near::bigint AS n_near, f.form_n::bigint AS form_n
FROM formed f JOIN path p ON p.word = f.word AND p.next IS NULL
"""
