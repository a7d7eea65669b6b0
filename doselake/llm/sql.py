"""DuckDB SQL of the registered queries, where SQL can express them."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def near_duplicates(words: int, similarity: int) -> str:
    """Components over exact similarities, for tables whose pairs SQL can list."""
    tokens = WORDS.format(LOWER.format("coalesce(text, '')"))
    return f"""
WITH RECURSIVE
words AS (SELECT doc_id, {tokens} AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' '))
  END)) AS s FROM words),
classes AS (SELECT s, min(doc_id) AS node, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
members AS (SELECT node, n, unnest(s) AS shingle FROM classes),
pairs AS (
  SELECT a.node AS a, b.node AS b FROM members a JOIN members b USING (shingle)
  WHERE a.node < b.node AND 100 * least(a.n, b.n) >= {similarity} * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n
  HAVING 100 * count(*) >= {similarity} * (a.n + b.n - count(*))),
twoway AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (
  SELECT node AS a, node AS b FROM classes
  UNION
  SELECT reach.a, twoway.b FROM reach JOIN twoway ON reach.b = twoway.a),
least_of AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a)
SELECT doc_id, len(sets.s) AS n_shingles, coalesce(component, doc_id) AS component_id,
       doc_id = coalesce(component, doc_id) AS kept
FROM sets LEFT JOIN classes ON sets.s = classes.s LEFT JOIN least_of USING (node)"""


def pareto_mix(max_copies: int = 3, cycle: int = 3, seed: str = "mix") -> str:
    """The mix by its definition: targets by trying every set of capped sources."""
    tokens = WORDS.format("coalesce(text, '')")
    return f"""
WITH
docs AS (SELECT doc_id, source, len({tokens})::BIGINT AS size FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, {max_copies} * sum(size)::BIGINT AS lim,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {cycle} + 1 AS weight
  FROM docs GROUP BY source),
ordered AS (SELECT *, row_number() OVER (ORDER BY lim::DOUBLE / weight, source NULLS LAST) AS nth FROM sizes),
levels AS (
  SELECT o.nth, ((SELECT sum(source_size) FROM sizes) - coalesce((SELECT sum(lim) FROM ordered p WHERE p.nth < o.nth), 0))::DOUBLE
         / (SELECT sum(weight) FROM ordered p WHERE p.nth >= o.nth)::DOUBLE AS level,
         o.lim::DOUBLE / o.weight AS rate
  FROM ordered o),
first_open AS (SELECT nth, level FROM levels WHERE level < rate ORDER BY nth LIMIT 1),
goals AS (
  SELECT source, source_size,
         CASE WHEN nth < coalesce((SELECT nth FROM first_open), 1 << 60) THEN lim::DOUBLE
              ELSE weight * (SELECT level FROM first_open) END AS target
  FROM ordered),
wanted AS (
  SELECT d.*, g.source_size, g.target,
         CASE WHEN size > 0 THEN least(target / g.source_size, {max_copies}.0) ELSE 0.0 END AS wanted,
         (('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5)
           / {float(1 << 52)!r} AS draw
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
ranked AS (
  SELECT *, floor(wanted)::BIGINT AS whole, wanted - floor(wanted) AS chance,
         CASE WHEN wanted > floor(wanted) THEN draw / (1.0 - draw)
           / ((wanted - floor(wanted)) / (1.0 - (wanted - floor(wanted)))) END AS rank
  FROM wanted),
placed AS (
  SELECT *, target - sum(size * whole) OVER (PARTITION BY source) AS rest,
         coalesce(sum(CASE WHEN chance > 0 THEN size END) OVER (
           PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM ranked)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN chance > 0 AND ahead < rest AND ahead + size - rest <= rest - ahead THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed"""


def chat_formatting(control: str) -> str:
    """Digests of the conversations themselves, and the length of their formatted text."""
    escapes = r"'\\|###|</turn>'"
    return f"""
WITH
rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{control}'
  UNION ALL SELECT -7, 1, 'assistant', '{control}'),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY nth), '')) AS loss_sha256,
       sum(length('### ' || role || ':' || chr(10) || text || '</turn>' || chr(10))
           + len(regexp_extract_all(text, {escapes})) + len(regexp_extract_all(role, '\\|###|</turn>|:')))::BIGINT AS formatted_chars
FROM ordered GROUP BY conv_id"""


def collocations(support: int = 30, best: int = 2000, covered: int = 80) -> str:
    """All phrases of 2 to 4 words counted by a plain group by."""
    spelt = "array_to_string(w[i:i + {} - 1], ' ')"
    return f"""
WITH
pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex({LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
spelt AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM spelt WHERE len(w) > 0),
runs AS (
  SELECT lang, m AS words, {spelt.format("m")} AS phrase
  FROM starts, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE i + m - 1 <= len(w)),
totals AS (SELECT lang, count(*) AS n FROM runs WHERE words = 1 GROUP BY lang),
counts AS (SELECT lang, words, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= {support}),
many AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE words > 1),
cuts AS (SELECT *, unnest(range(1, words)) AS k FROM many),
halves AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r,
         (2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS score
  FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
weakest AS (
  SELECT * FROM halves QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
subs AS (
  SELECT lang, a AS longer, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, a, w, words, unnest(range(1, words)) AS i FROM many), (SELECT unnest([2, 3]) AS m)
  WHERE m < words AND i + m - 1 <= words),
longest AS (SELECT lang, phrase, max(longer) AS longer FROM subs GROUP BY ALL),
kept AS (
  SELECT weakest.*, n FROM weakest JOIN totals USING (lang) LEFT JOIN longest USING (lang, phrase)
  WHERE longer IS NULL OR 100::HUGEINT * longer < {covered}::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked WHERE rank <= {best}"""


def hard_negatives(every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> str:
    """Every anchor scored against every row."""
    return f"""
WITH
used AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM used a JOIN used b ON a.vec_id <> b.vec_id WHERE a.vec_id % {every} = 0),
pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {positives}),
neg AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
  FROM pos p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> s.own
   AND {low} * positive_score <= 100 * s.score AND 100 * s.score <= {high} * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= {negatives}"""
