"""DuckDB SQL for the queries whose whole result SQL can express.

The other queries rest on trained models, vocabularies, hash functions or
regular expressions that DuckDB doesn't have; their tests hold them against
brute force.
"""

from __future__ import annotations

from . import op5_rules, op7_vectors, op8_mix, op10_lm, op12_variants, op13_search

_SPACE = "[\\x20\\x09-\\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def jaccard(size: int = 3, percent: int = 90) -> str:
    joined = f"list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_SPACE}'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')] ELSE {joined} END) AS g FROM d
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * m >= {percent} * (p.n + q.n - m)
), r(doc, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.y, r.c FROM r JOIN l ON r.doc = l.x)
SELECT d.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM d JOIN r ON r.doc = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id"""


def cosine(link: float = op7_vectors.LINK) -> str:
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND list_bool_and(list_transform(embedding, lambda x: isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {link}
), r(vec, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.y, r.c FROM r JOIN l ON r.vec = l.x)
SELECT e.vec_id, CAST(coalesce(max(k.n), 0) AS BIGINT) AS n_links, min(r.c) AS component_id, e.vec_id = min(r.c) AS kept
FROM embeddings e JOIN r ON r.vec = e.vec_id LEFT JOIN (SELECT x, count(*) AS n FROM l GROUP BY x) k ON k.x = e.vec_id GROUP BY e.vec_id"""


def divergence() -> str:
    o = op5_rules
    lists = lambda t: " ".join(f"WHEN '{k}' THEN [{', '.join(map(repr, v))}]" for k, v in t.items() if k)
    chars = f"CASE lang {lists(o.CHAR_REFERENCE)} ELSE [{', '.join(map(repr, o.CHAR_REFERENCE['']))}] END"
    common = f"CASE lang {lists(o.COMMON_WORDS)} END"
    size = len(o.COMMON_WORDS["en"])
    shares = "[" + ", ".join([f"({o.COMMON_SHARE!r}::DOUBLE / {size})"] * size + [f"{1 - o.COMMON_SHARE!r}::DOUBLE"]) + "]"
    half = lambda p: f"CASE WHEN {p} > 0 THEN 0.5::DOUBLE * {p} * log2({p} / ((c[i] / t + r[i]) / 2)) ELSE 0 END"
    js = lambda counts, ref, k: f"(SELECT CASE WHEN t > 0 THEN sqrt(greatest(list_sum(list_transform(range(1, {k + 1}), lambda i: {half('(c[i] / t)')} + {half('r[i]')})), 0)) END FROM (SELECT c, list_sum(c) AS t, CAST({ref} AS DOUBLE[]) AS r FROM (SELECT CAST({counts} AS DOUBLE[]) AS c)))"
    count = lambda what: f"length(rest) - length(regexp_replace(rest, '{what}', '', 'g'))"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang FROM documents
), w AS (
  SELECT *, list_filter(string_split_regex(t, '{_SPACE}'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
    regexp_replace(t, '[\\p{{Ll}}\\p{{Lt}}\\p{{Lm}}\\p{{Lo}}]+', '', 'g') AS rest FROM d
), g AS (
  SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)
), twice AS (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1
), rep AS (SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n FROM twice GROUP BY rid
), m AS (
  SELECT doc_id, lang, w, rest, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, length(t) AS n, length(t) - length(rest) AS letters,
    {count("\\p{Lu}")} AS upper_, {count("\\p{Nd}")} AS digits, {count(_SPACE)} AS space_, {count("[.,;:!?''\"()\\-]")} AS stops
  FROM w LEFT JOIN rep ON rep.rid = w.rid
), j AS (
  SELECT *, CASE WHEN n >= {o.LEAST_CHARS} THEN {js("[letters, upper_, digits, space_, stops, n - letters - upper_ - digits - space_ - stops]", chars, 6)} END AS cd,
    CASE WHEN lang IN ({", ".join(repr(k) for k in o.COMMON_WORDS)}) AND n_words >= {o.LEAST_COMMON_OF} THEN
      {js("list_append(hits, len(w) - list_sum(hits))", shares, size + 1)} END AS wd
  FROM (SELECT *, list_transform({common}, lambda x: len(list_filter(w, lambda y: y = x OR y = concat(upper(x[1]), x[2:])))) AS hits FROM m)
), f AS (SELECT *, n_words < {o.LEAST_WORDS} OR 100 * n_repeat_words > {o.MOST_REPEATED} * n_words AS base_failed FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(cd, 0) <= {o.MOST_CHAR_DISTANCE} AND coalesce(wd, 0) <= {o.MOST_WORD_DISTANCE} AS kept,
  round(cd, 6) AS char_distance, round(wd, 6) AS word_distance FROM f"""


def fair_queue() -> str:
    weights = " ".join(f"WHEN {i} THEN {float(w)}::DOUBLE" for i, w in enumerate(op8_mix.WEIGHTS))
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source IS NULL AS gone, coalesce(source, '') AS s, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    CAST(concat('0x', substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), 'null'), '@', md5(coalesce(text, '')))), 1, 15)) AS BIGINT) AS place FROM documents
), p AS (SELECT gone, s, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY gone, s
), w AS (SELECT *, CASE (row_number() OVER (ORDER BY gone, s) - 1) % {len(op8_mix.WEIGHTS)} {weights} END AS weight, source_size * {op8_mix.MOST_EPOCHS}.0::DOUBLE AS cap FROM p
), l AS (
  SELECT *, cap / weight AS fills, ((SELECT CAST(sum(source_size) AS DOUBLE) FROM p) - (sum(cap) OVER o - cap)) / ((SELECT sum(weight) FROM w) - (sum(weight) OVER o - weight)) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, gone, s)
), c AS (SELECT level AS common FROM l WHERE level * weight <= cap ORDER BY fills, level LIMIT 1
), t AS (SELECT gone, s, source_size, least(cap, coalesce((SELECT common FROM c), CAST('inf' AS DOUBLE)) * weight) AS target FROM l
), q AS (
  SELECT rid, doc_id, size, source_size, target, CAST(sum(size) OVER (PARTITION BY gone, s ORDER BY place, doc_id NULLS FIRST, size, rid ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM d JOIN t USING (gone, s)
), f AS (SELECT rid, size, (e * source_size + upto) / target AS f FROM q, range({op8_mix.MOST_EPOCHS}) r(e) WHERE target > 0
), a AS (SELECT max(f) AS last FROM (SELECT f, sum(size) OVER (ORDER BY f) AS total FROM f) WHERE total <= (SELECT sum(size) FROM d)
), n AS (SELECT rid, count(*) AS n FROM f WHERE f <= (SELECT last FROM a) GROUP BY rid)
SELECT doc_id, size, source_size, target, CAST(size * coalesce(n.n, 0) AS BIGINT) AS taken FROM q LEFT JOIN n USING (rid)"""


def cross_entropy() -> str:
    own = lambda count, mine: f"({count} - {mine} * CAST(inside AS INTEGER))"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), FALSE) AS good,
    list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_SPACE}'), lambda x: x <> '') AS w FROM documents
), e AS (
  SELECT rid, good, v, x, count(*) AS op FROM (SELECT rid, good, unnest(list_concat([''], w[1:len(w) - 1])) AS v, unnest(w) AS x FROM d WHERE len(w) > 0) GROUP BY ALL
), ow AS (SELECT rid, x, sum(op) AS ow FROM e GROUP BY ALL
), oc AS (SELECT rid, v, sum(op) AS oc FROM e GROUP BY ALL
), m AS (SELECT unnest([TRUE, FALSE]) AS whole
), gw AS (SELECT whole, x, coalesce(sum(op) FILTER (whole OR good), 0) AS gw FROM e, m GROUP BY ALL
), gc AS (SELECT whole, v, coalesce(sum(op) FILTER (whole OR good), 0) AS gc FROM e, m GROUP BY ALL
), gp AS (SELECT whole, v, x, coalesce(sum(op) FILTER (whole OR good), 0) AS gp FROM e, m GROUP BY ALL
), n AS (SELECT whole, coalesce(sum(len(w)) FILTER (whole OR good), 0) AS n FROM d, m GROUP BY ALL
), k AS (
  SELECT rid, whole, whole OR e.good AS inside, e.op, ow, oc, gw, gc, gp, n.n, len(d.w) AS nd, (SELECT count(DISTINCT x) FROM e) AS vocabulary
  FROM e JOIN d USING (rid) JOIN ow USING (rid, x) JOIN oc USING (rid, v) CROSS JOIN m JOIN gw USING (whole, x) JOIN gc USING (whole, v) JOIN gp USING (whole, v, x) JOIN n USING (whole)
), b AS (
  SELECT *, {1 - op10_lm.UNIFORM!r}::DOUBLE * {own("gw", "ow")} / greatest({own("n", "nd")}, 1) + CASE WHEN {own("n", "nd")} > 0 THEN {op10_lm.UNIFORM!r}::DOUBLE ELSE 1 END / vocabulary AS base FROM k
), f AS (
  SELECT rid, whole, op, {op10_lm.BLEND!r}::DOUBLE * CASE WHEN {own("gc", "oc")} > 0 THEN {own("gp", "op")}::DOUBLE / {own("gc", "oc")} ELSE base END + {1 - op10_lm.BLEND!r}::DOUBLE * base AS p FROM b
), s AS (SELECT rid, sum(-ln(p) * op) FILTER (NOT whole) AS t, sum(-ln(p) * op) FILTER (whole) AS a FROM f GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(t / len(w), 0), 6) AS target_loss, round(coalesce(a / len(w), 0), 6) AS background_loss, round(coalesce((t - a) / len(w), 0), 6) AS score
FROM d LEFT JOIN s USING (rid)"""


def variants() -> str:
    o = op12_variants
    return rf"""
WITH RECURSIVE bits AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tbl),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
keyed AS (SELECT id, run, count(*) AS times, hex(encode(id || ':' || run)) AS hx FROM runs WHERE length(run) >= {o.LEAST_LENGTH} GROUP BY id, run),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(length(hx) // 2), lambda i:
    16 * (instr('0123456789ABCDEF', hx[2 * i + 1]) - 1) + instr('0123456789ABCDEF', hx[2 * i + 2]) - 1)), lambda c, b: xor(tbl[(xor(c, b) & 255) + 1], c >> 8))) AS h
  FROM keyed CROSS JOIN bits),
said AS (SELECT CASE WHEN h % {o.MARKED} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM said WHERE length(word) >= {o.LEAST_LENGTH} GROUP BY word HAVING sum(times) >= {o.LEAST_COUNT}),
gaps AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
less AS (SELECT DISTINCT left(word, i - 1) || substr(word, i + 1) AS short, word, n FROM gaps),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.i = b.i AND left(a.word, a.i - 1) = left(b.word, b.i - 1) AND substr(a.word, a.i + 1) = substr(b.word, b.i + 1) AND a.word <> b.word
  UNION ALL SELECT w.word, l.word, l.n FROM words w JOIN less l ON w.word = l.short
  UNION ALL SELECT l.word, w.word, w.n FROM words w JOIN less l ON w.word = l.short),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY word),
named AS (SELECT b.word, b.n_near, b.top, min(x.other) AS other FROM best b JOIN near x ON x.word = b.word AND x.other_n = b.top GROUP BY ALL),
judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= {o.RATIO} * w.n THEN other END AS form, CASE WHEN top >= {o.RATIO} * w.n THEN top END AS form_n
  FROM words w LEFT JOIN named ON named.word = w.word),
way AS (
  SELECT word, form AS root, 1 AS step FROM judged WHERE form IS NOT NULL
  UNION ALL SELECT way.word, j.form, step + 1 FROM way JOIN judged j ON way.root = j.word WHERE j.form IS NOT NULL)
SELECT j.word, form, coalesce(r.root, j.word) AS root, n, n_near, form_n
FROM judged j LEFT JOIN (SELECT word, arg_max(root, step) AS root FROM way GROUP BY word) r ON r.word = j.word"""


def ranked_search() -> str:
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return f"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{term}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
dl AS (SELECT doc_id, count(*) AS n FROM t GROUP BY ALL),
totals AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM dl),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{term}')) AS term FROM benchmark),
qf AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf CROSS JOIN totals WHERE term IN (SELECT term FROM qf) GROUP BY term, docs),
parts AS (
  SELECT tf.doc_id, tf.term, w.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))) AS part
  FROM tf JOIN w ON w.term = tf.term JOIN dl ON dl.doc_id = tf.doc_id CROSS JOIN totals),
scores AS (SELECT item_id, doc_id, CAST(sum(times * part) AS BIGINT) AS score FROM qf JOIN parts ON parts.term = qf.term GROUP BY ALL HAVING sum(times * part) > 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {op13_search.BEST}"""


SQL: dict[str, str] = {
    "op3_adaptive_prefix_join": jaccard(),
    "op5_divergence_rules": divergence(),
    "op7_product_quantised_dedup": cosine(),
    "op8_fair_queue_mix": fair_queue(),
    "op10_cross_entropy_difference": cross_entropy(),
    "op12_chunked_variants": variants(),
    "op13_reversed_search": ranked_search(),
}
