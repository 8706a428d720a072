"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

from farelake.llm import chat, mixing, quality, spelling, warc

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> str:
    return _WORDS.format(text=f"coalesce({text}, '')")


def folded(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


_STATEMENTS: dict[str, str] = {}


def statements() -> dict[str, str]:
    return dict(_STATEMENTS)


_STATEMENTS["op10_ngram_jaccard_join"] = f"""
WITH RECURSIVE split AS (SELECT doc_id, {words(folded('text'))} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3),
      lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]))) END AS s
  FROM split),
held AS (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM held a JOIN held b ON a.token = b.token AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
  least(doc_id, (SELECT min(b) FROM reach WHERE a = doc_id)) AS component_id
FROM sets
"""

_RULES = ", ".join(
    f"('{rule}', {step}, CAST({cutoff} AS DOUBLE))"
    for rule, (_, grid) in quality.RULES.items() for step, cutoff in enumerate(grid))
_VALUES = " ".join(f"WHEN '{rule}' THEN {value}" for rule, (value, _) in quality.RULES.items())

_STATEMENTS["op5_quality_rules"] = f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t, {words('text')} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM (
    SELECT r, i, concat_ws(' ', w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS s
    FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM split))),
covered AS (
  SELECT r, sum(least(5, coalesce(next - i, 5))) AS n FROM (
    SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM windows WHERE n > 1) GROUP BY r),
counted AS (
  SELECT split.r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(length(t) - length(regexp_replace(t, '!', '', 'g')) AS BIGINT) AS n_exclamations,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN covered ON covered.r = split.r),
based AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
rules(rule, step, cutoff) AS (VALUES {_RULES}),
known AS (SELECT doc_id, min(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT based.*, q FROM based JOIN known ON known.doc_id = based.doc_id WHERE NOT base_failed),
strata AS (
  SELECT lang, pooled, CASE WHEN NOT pooled THEN lang END AS own FROM (
    SELECT lang, pow(1 - {quality.TOTAL_RISK}, count(*) FILTER (q = 1)) > {quality.LEVEL} / count(*) OVER () AS pooled
    FROM held GROUP BY lang)),
candidates AS (
  SELECT pooled, own, rule, step, cutoff, count(*) FILTER (q = 1) AS n,
    count(*) FILTER (q = 1 AND CASE rule {_VALUES} END > cutoff) AS good,
    count(*) FILTER (q = 0 AND CASE rule {_VALUES} END > cutoff) AS bad
  FROM held JOIN strata ON held.lang IS NOT DISTINCT FROM strata.lang, rules GROUP BY pooled, own, rule, step, cutoff),
hits AS (
  SELECT pooled, own, rule, max(bad) AS hits, sum(max(bad)) OVER (PARTITION BY pooled, own) AS all_hits
  FROM candidates GROUP BY pooled, own, rule),
weighed AS (
  SELECT candidates.*, hits / all_hits AS weight, {quality.TOTAL_RISK} * weight AS risk
  FROM candidates JOIN hits ON candidates.pooled = hits.pooled AND candidates.own IS NOT DISTINCT FROM hits.own AND candidates.rule = hits.rule
  WHERE hits > 0),
tested AS (
  SELECT *, CASE WHEN good >= n * risk THEN 1.0 ELSE
    list_sum(list_transform(range(0, good + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
      + i * ln(risk) + (n - i) * ln(1 - risk)))) END AS p,
    {quality.LEVEL} * weight / (SELECT count(*) FROM (SELECT DISTINCT pooled, own FROM strata)) AS most
  FROM weighed),
proven AS (
  SELECT *, bool_and(p <= most) OVER (PARTITION BY pooled, own, rule ORDER BY step) AS usable FROM tested),
best AS (
  SELECT pooled, own, rule, first(cutoff ORDER BY bad - good DESC, step) AS cutoff FROM proven WHERE usable GROUP BY pooled, own, rule),
rejected AS (
  SELECT DISTINCT r FROM based JOIN strata ON based.lang IS NOT DISTINCT FROM strata.lang
  JOIN best ON best.pooled = strata.pooled AND best.own IS NOT DISTINCT FROM strata.own
  WHERE CASE rule {_VALUES} END > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM rejected) AS kept
FROM based
"""

_STATEMENTS["op3_source_mixing"] = f"""
WITH sized AS (SELECT doc_id, source, text, CAST(len({words('text')}) AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
levels AS (
  -- the words that all sources take if every source gets x a weight, at each x where a source reaches its cap
  SELECT a.x, (SELECT sum(least({mixing.MOST} * source_size, a.x * weight)) FROM sources) AS taken
  FROM (SELECT DISTINCT {mixing.MOST} * source_size / weight AS x FROM sources) a),
full_up AS (
  SELECT coalesce(max(x), 0) AS x FROM levels WHERE taken <= (SELECT sum(source_size) FROM sources)),
mix AS (
  SELECT source, source_size, CASE WHEN {mixing.MOST} * source_size / weight <= x THEN CAST({mixing.MOST} * source_size AS DOUBLE)
    ELSE weight * (((SELECT sum(source_size) FROM sources)
      - coalesce((SELECT sum({mixing.MOST} * source_size) FROM sources s, full_up f WHERE {mixing.MOST} * s.source_size / s.weight <= f.x), 0))
      / (SELECT sum(weight) FROM sources s, full_up f WHERE {mixing.MOST} * s.source_size / s.weight > f.x)) END AS target
  FROM sources, full_up),
numbered AS (SELECT *, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) AS source_no FROM mix),
laid AS (
  SELECT doc_id, size, source_size, target, source_no, round(target) AS filled, coalesce(sum(size) OVER (
    PARTITION BY s.source ORDER BY md5('{mixing.SEED}' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN numbered ON s.source IS NOT DISTINCT FROM numbered.source),
whole AS (SELECT CAST(ceil(sum(target) / {mixing.BLOCK}) AS BIGINT) AS slots FROM mix),
ends AS (SELECT source_no, sum(target) OVER (ORDER BY source_no) / (SELECT sum(target) FROM mix) AS hi FROM numbered WHERE target > 0),
intervals AS (
  SELECT source_no, coalesce(lag(hi) OVER (ORDER BY source_no), 0) AS lo,
    CASE WHEN source_no = max(source_no) OVER () THEN 1 ELSE hi END AS hi FROM ends),
needed AS (SELECT source_no, CAST(ceil(round(target) / {mixing.BLOCK}) AS BIGINT) AS blocks FROM numbered WHERE target > 0),
timed AS (
  SELECT slot, source_no, row_number() OVER (PARTITION BY source_no ORDER BY slot) - 1 AS block_no
  FROM (SELECT unnest(range(0, slots)) AS slot FROM whole) JOIN intervals
    ON (slot * CAST({mixing.GOLDEN!r} AS DOUBLE)) % 1 >= lo AND (slot * CAST({mixing.GOLDEN!r} AS DOUBLE)) % 1 < hi),
missing AS (
  SELECT source_no, block_no FROM (SELECT source_no, unnest(range(0, blocks)) AS block_no FROM needed)
  WHERE (source_no, block_no) NOT IN (SELECT (source_no, block_no) FROM timed)),
scheduled AS (
  SELECT slot, timed.source_no, block_no FROM timed JOIN needed ON needed.source_no = timed.source_no AND block_no < blocks
  UNION ALL SELECT slots - 1 + row_number() OVER (ORDER BY block_no, source_no), source_no, block_no FROM missing, whole)
SELECT doc_id, size, source_size, target,
  CAST(list_sum(list_transform(range(0, {mixing.MOST}), lambda k:
    greatest(0, least(filled, k * source_size + start + size) - least(filled, k * source_size + start)))) AS BIGINT) AS taken,
  slot AS first_slot
FROM laid LEFT JOIN scheduled ON size > 0 AND start < filled AND scheduled.source_no = laid.source_no
  AND scheduled.block_no = start // {mixing.BLOCK}
"""

_STATEMENTS["op4_warc"] = f"""
WITH held AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS digest FROM pages),
heads AS (
  SELECT payload, max(page_id) AS head FROM held WHERE size >= {warc.REVISIT_BYTES} GROUP BY payload HAVING count(*) > 1)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
  CASE WHEN head > page_id OR (page_id IS NULL AND head IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN head > page_id OR page_id IS NULL THEN head END AS refers_to
FROM held LEFT JOIN heads ON heads.payload = held.payload
"""


def _escaped(text: str) -> str:
    text = f"replace({text}, '\\', '\\\\')"
    for c in chat.CONTROL:
        text = f"replace({text}, '{c}', '{c[0]}\\{c[1:]}')"
    return text


_STATEMENTS["op6_chat_formatting"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, {len(chat.ROLE + chat.TEXT + chat.END)} + length({_escaped('role')}) + length({_escaped('text')}) AS size,
    row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role COLLATE "C", text COLLATE "C")),
summed AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY place) AS so_far FROM sized)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(so_far) FILTER (role = 'assistant' OR place = n) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id
"""

_STATEMENTS["op9_exact_top_k"] = """
WITH held AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, q.r, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
  FROM held q, held d WHERE q.vec_id % 20 = 0 AND q.r <> d.r),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 20
"""


#: CRC-32 of every byte, as the list t.
_CRC_TABLE = """crc AS (
  SELECT list(list_reduce(range(0, 8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), i) ORDER BY i) AS t FROM range(0, 256) r(i))"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes; the table t is in scope."""
    return (
        f"xor(4294967295, list_reduce(list_transform(range(0, strlen({text})), "
        f"lambda i: CAST('0x' || substring(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)), "
        f"lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)))")


_STATEMENTS["op12_conversation_trie"] = f"""
WITH {_CRC_TABLE},
turns AS (
  SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
    len({words('text')}) AS w FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'d': d, 'w': w}} ORDER BY turn NULLS FIRST, d) AS turns FROM turns GROUP BY conv_id),
shared AS (SELECT conv_id, turns, {_crc32('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM own, crc),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:h], a.turns[h + 1:]) AS turns
  FROM shared a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
openings AS (
  SELECT conv_id, len(turns) AS n, turns[1:d] AS path, d FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(path[d].w, 0) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM openings GROUP BY path, d),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children ON children.path = nodes.path),
beneath AS (
  SELECT path[1:a] AS path, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM counted) GROUP BY 1)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, b.n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN beneath b ON b.path = c.path LEFT JOIN nodes p ON c.depth > 0 AND p.path = c.path[1:c.depth - 1]
"""

_STATEMENTS["op13_spelling_variants"] = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all({folded('text')}, '{spelling.RUN}')) AS run FROM documents),
placed AS (SELECT id || ':' || run AS place, run, count(*) AS n FROM runs GROUP BY id, run),
checked AS (SELECT run, n, {_crc32('place')} AS c FROM placed, crc),
written AS (
  SELECT CASE WHEN c % {spelling.SLIPS} = 0 THEN left(run, c % length(run)) || substring(run, c % length(run) + 2) ELSE run END AS word, n FROM checked),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written WHERE length(word) >= {spelling.LEAST_CHARS} GROUP BY word
  HAVING sum(n) >= {spelling.LEAST_COUNT}),
cuts AS (
  SELECT word, n, i, left(word, i - 1) || substring(word, i + 1) AS cut
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word AS a, b.word AS b, b.n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
best AS (SELECT a, count(*) AS n_near, first(b ORDER BY n DESC, b COLLATE "C") AS form, max(n) AS form_n FROM near GROUP BY a),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form,
    CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best ON best.a = words.word),
chain(word, reached) AS (
  SELECT word, word FROM formed UNION ALL SELECT chain.word, f.form FROM chain JOIN formed f ON f.word = chain.reached WHERE f.form IS NOT NULL),
ends AS (SELECT chain.word, reached AS root FROM chain JOIN formed f ON f.word = chain.reached WHERE f.form IS NULL)
SELECT formed.word, form, root, n, n_near, form_n FROM formed JOIN ends ON ends.word = formed.word
"""
