"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from rampline.llm import merkle, mixing, quality, runs

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _op8() -> str:
    measure_sql = {
        "mean_word_chars": "word_chars / nullif(n_words, 0)",
        "symbols_per_word": "n_symbols / nullif(n_words, 0)",
        "stop_word_ratio": "(n_stop_words + 1) / nullif(n_words, 0)",
        "dup_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
    }
    tests = []
    for rule in quality.RULES:
        value = f"coalesce({measure_sql[rule.measure]}, 0.0)"
        tests += [f"{value} >= {rule.low}"] if rule.low is not None else []
        tests += [f"{value} <= {rule.high}"] if rule.high is not None else []
    stops = ", ".join(f"'{word}'" for word in dict.fromkeys(quality.STOP_WORDS))
    symbols = "".join(f"\\{c}" for c in quality.SYMBOLS)
    return rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i : i + 4], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM split)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id
), filled AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM filled GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^{symbols}]', '', 'g'))::BIGINT AS n_symbols,
    len(list_filter(words, lambda w: lower(w) IN ({stops})))::BIGINT AS n_stop_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), based AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(tests)} AS kept
FROM based
"""


def _op5() -> str:
    weights = ", ".join(f"{w}.0::DOUBLE" for w in mixing.WEIGHTS)
    most = f"{mixing.MOST_PASSES}.0::DOUBLE"
    return rf"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
    ('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))), 1, 15))::BIGINT AS hash
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS nr FROM totals
), cycled AS (
  SELECT *, ([{weights}])[((nr - 1) % {len(mixing.WEIGHTS)} + 1)::INT] AS weight FROM weighted
), shared AS (
  SELECT *, row_number() OVER filled AS rank,
    (sum(source_size) OVER ()::DOUBLE - {most} * coalesce(sum(source_size) OVER (filled ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / sum(weight) OVER (filled ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unit
  FROM cycled WINDOW filled AS (ORDER BY source_size / weight, nr)
), targets AS (
  SELECT source, source_size, least({most} * source_size, weight * coalesce(
    min_by(unit, rank) FILTER (unit * weight <= {most} * source_size) OVER (), 0.0)) AS target
  FROM shared
), planned AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS passes FROM targets
), running AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.passes,
    greatest(0.0, p.target - p.passes * p.source_size) AS rest,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash ROWS UNBOUNDED PRECEDING)::BIGINT - s.size AS before
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  size * (passes + CASE WHEN before + size / 2 <= rest THEN 1 ELSE 0 END) AS taken
FROM running
"""


def _crc32(text: str) -> str:
    """CRC-32 of a text of digits, a bit at a time."""
    byte = "list_reduce(list_concat([x], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))"
    bytes_ = f"list_transform(string_split({text}, ''), lambda d: ord(d)::BIGINT)"
    state = f"list_reduce(list_concat([4294967295::BIGINT], {bytes_}), lambda s, b: list_transform([xor(s, b)], lambda x: {byte})[1])"
    return f"xor({state}, 4294967295)"


def _op12() -> str:
    width = runs.shortest_repeat(runs.LEAST, runs.EXPONENT)
    return f"""
WITH numbered AS (
  SELECT doc_id, {WORDS} AS words, {_crc32("doc_id::VARCHAR")} AS h FROM documents
), sized AS (
  SELECT doc_id, words, len(words) AS n, h, h // 10 AS g FROM numbered
), looped AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE words END AS words
  FROM (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM sized))
), grams AS (
  SELECT doc_id, i, array_to_string(words[i + 1 : i + {width}], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(n - {width - 1})) AS i FROM looped WHERE n >= {width})
), matches AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i
), stretches AS (
  SELECT doc_id, q, min(i) AS start, max(i) - min(i) + {width} + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM matches)
  GROUP BY doc_id, q, island
), found AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches
  WHERE length >= greatest({runs.LEAST}, {runs.EXPONENT} * q) GROUP BY doc_id, start, length
), judged AS (
  SELECT doc_id, count(*) AS n_runs, sha256(string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period)) AS runs_sha256
  FROM found GROUP BY doc_id
), most AS (
  SELECT * FROM found x WHERE NOT EXISTS (
    SELECT 1 FROM found y WHERE x.doc_id = y.doc_id AND (y.length * x.period > x.length * y.period
      OR y.length * x.period = x.length * y.period AND (y.start, y.period) < (x.start, x.period)))
), dropped AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM found
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(n)) AS i FROM looped) ANTI JOIN dropped USING (doc_id, i)
  GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
  (1000 * length // period)::BIGINT AS exponent_milli,
  coalesce(runs_sha256, sha256('')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM looped LEFT JOIN judged USING (doc_id) LEFT JOIN most USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


# eight to this power are the leaves that the twin of the manifest may see
_MERKLE_LEVELS = 9


def _merkle_field(name: str) -> str:
    return f"coalesce(octet_length(encode({name}::VARCHAR))::VARCHAR || ':' || {name}::VARCHAR, '-')"


def _merkle_tree(prefix: str, line: str) -> str:
    """CTEs of the levels over ``{prefix}0`` (line, pos, n, h), of siblings in each, and of the tops."""
    parts = []
    for k in range(_MERKLE_LEVELS):
        near = f"PARTITION BY {line}, pos // 8"
        parts.append(f"""{prefix}s{k} AS (
  SELECT {line}, pos, n, h,
    coalesce(string_agg(h, '' ORDER BY pos) OVER ({near} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(h, '') OVER ({near} ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {prefix}{k} WHERE n > 1
), {prefix}{k + 1} AS (
  SELECT {line}, pos // 8 AS pos, (n + 7) // 8 AS n, sha256(string_agg(h, '' ORDER BY pos)) AS h
  FROM {prefix}{k} WHERE n > 1 GROUP BY {line}, pos // 8, n
)""")
    every = " UNION ALL ".join(f"SELECT {line}, h FROM {prefix}{k} WHERE n = 1" for k in range(_MERKLE_LEVELS + 1))
    return ", ".join(parts) + f", {prefix}top AS ({every})"


def _merkle_folds(first: str, tree: str, line: str, claim: str) -> tuple[str, str, str]:
    """CTEs that carry the claim and the siblings up a tree, from ``first`` with its line, pos, claim and path."""
    parts, last = [], first
    for k in range(_MERKLE_LEVELS):
        parts.append(f"""{tree}f{k} AS (
  SELECT f.* REPLACE (f.pos // 8 AS pos, CASE WHEN s.n IS NULL THEN f.{claim} ELSE sha256(s.before || f.{claim} || s.after) END AS {claim},
    f.path || coalesce(s.before || s.after, '') AS path)
  FROM {last} f LEFT JOIN {tree}s{k} s ON f.{line} = s.{line} AND f.pos = s.pos
)""")
        last = f"{tree}f{k}"
    return ", ".join(parts), last, claim


def _op13() -> str:
    leaf, claim = (" || ".join(_merkle_field(f"{of}.{name}") for name in merkle.FIELDS) for of in "dc")
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    claimed = f"CASE WHEN {_crc32('doc_id::VARCHAR')} % 3 = 0 THEN {lowered} ELSE text END"
    low_folds, low_last, _ = _merkle_folds("placed", "t", "line", "claim")
    high_folds, high_last, _ = _merkle_folds("raised", "u", "a", "claim")
    return f"""
WITH claims AS (SELECT * REPLACE ({claimed} AS text) FROM documents), leaves AS (
  SELECT d.doc_id, coalesce('=' || d.lang, '') AS line, sha256({leaf}) AS h, sha256({claim}) AS claim
  FROM documents d JOIN claims c USING (doc_id)
), placed AS (
  SELECT doc_id, line, h, claim, h AS leaf, '' AS path,
    row_number() OVER (PARTITION BY line ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY line) AS n
  FROM leaves
), t0 AS (SELECT line, pos, n, h FROM placed), {_merkle_tree("t", "line")},
u0 AS (
  SELECT 0 AS a, line, h, row_number() OVER (ORDER BY encode(line)) - 1 AS pos, count(*) OVER () AS n FROM ttop
), {_merkle_tree("u", "a")}, {low_folds}, raised AS (
  SELECT f.doc_id, f.leaf, f.claim, f.path, 0 AS a, u0.pos, u0.h AS subroot
  FROM {low_last} f JOIN u0 ON f.line = u0.line
), {high_folds}
SELECT doc_id, leaf, subroot, utop.h AS root, sha256(path) AS proof_sha256, claim AS folded_root, claim = utop.h AS verified
FROM {high_last} JOIN utop USING (a)
"""


ORACLES = {
    "op11_phrase_dedup": rf"""
WITH split AS (
  SELECT doc_id, {WORDS} AS words FROM documents
), phrases AS (
  SELECT doc_id, i, array_to_string(words[i : i + 19], ' ') AS phrase
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM split)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY phrase ORDER BY doc_id, i) AS nr FROM phrases) WHERE nr > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later
), placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
""",
    "op12_periodic_runs": _op12(),
    "op13_merkle_manifest": _op13(),
    "op8_quality_rules": _op8(),
    "op5_source_mix": _op5(),
    "op2_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, n, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents)
), owners AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT doc_id, n, line, coalesce(owner <> doc_id, false) AS dropped FROM lines LEFT JOIN owners USING (key)
)
SELECT doc_id, count(*) AS n_lines, (count(*) FILTER (dropped)) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op9_suffix_dedup": r"""
WITH hexed AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), strings AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM hexed WHERE n >= 50)
), least AS (
  SELECT s, min(doc_id) AS first FROM strings GROUP BY s HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap
  FROM strings JOIN least USING (s) WHERE first < doc_id
), spans AS (
  SELECT doc_id, min(i) AS b, max(i) + 50 AS e FROM (
    SELECT *, count(*) FILTER (gap IS NULL OR gap > 50) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked
  ) GROUP BY doc_id, run
), pieces AS (
  SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS before FROM spans
), cut AS (
  SELECT doc_id, sum(e - b)::BIGINT AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, (2 * before + 1)::BIGINT, (2 * (b - before))::BIGINT), '' ORDER BY b) AS kept, max(e) AS last
  FROM pieces JOIN hexed USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN last IS NULL THEN h ELSE kept || substr(h, (2 * last + 1)::BIGINT) END)) AS kept_sha256
FROM hexed LEFT JOIN cut USING (doc_id)
""",
    "op10_embedding_groups": r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
), valid AS (
  SELECT vec_id, v FROM vectors
  WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM vectors
  UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), component AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a
), counts AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM component LEFT JOIN counts USING (vec_id)
""",
}
