"""DuckDB SQL for operators of this subpackage: computed another way than the operators (token
lists instead of hashes, whole conversations at once, plain rounds over all distances)."""

from __future__ import annotations

_SPACE = r"\t\n\x0b\f\r "
_FINITE = ("embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0")
_GAP = "list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
_MEAN = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"


_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def line_templates(min_docs: int = 5, similarity: float = 0.7, depth: int = 3) -> str:
    constants = "len(list_filter({}, lambda x: x <> '<*>'))"
    return rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS n FROM d),
r AS (SELECT doc_id, n, list_filter(regexp_split_to_array(line, '{_WHITE}'), lambda x: x <> '') AS raw FROM l),
k AS MATERIALIZED (SELECT doc_id, n, raw, list_transform(raw, lambda x: CASE WHEN regexp_matches(x, '\p{{Nd}}') THEN '<*>' ELSE x END) AS m,
        len(raw) AS size FROM r WHERE len(raw) > 0),
h AS MATERIALIZED (SELECT *, m[1:{depth}] AS head, CAST(ceil(CAST({similarity} AS DOUBLE) * size) AS INTEGER) AS need,
        list_contains(m, '<*>') AND {constants.format("m")} < CAST({similarity} AS DOUBLE) * size AS few FROM k),
leaf AS MATERIALIZED (SELECT size, head, count(DISTINCT doc_id) AS docs FROM h GROUP BY ALL HAVING docs >= {min_docs}),
line AS MATERIALIZED (SELECT m, count(DISTINCT doc_id) AS docs FROM h GROUP BY m HAVING docs >= {min_docs}),
exact AS MATERIALIZED (SELECT raw FROM h WHERE few GROUP BY raw HAVING count(DISTINCT doc_id) >= {min_docs}),
c AS MATERIALIZED (SELECT h.*, leaf.docs AS leaf_docs, coalesce(line.docs, 0) AS line_docs
      FROM h JOIN leaf USING (size, head) LEFT JOIN line ON line.m = h.m),
tok AS MATERIALIZED (SELECT doc_id, n, size, head, line_docs, unnest(m) AS w, generate_subscripts(m, 1) AS p FROM c),
constant AS MATERIALIZED (SELECT size, head, p, w, count(DISTINCT doc_id) AS docs,
      count(DISTINCT doc_id) FILTER (WHERE line_docs = 0) >= {min_docs} AS loose
      FROM tok WHERE w <> '<*>' GROUP BY ALL HAVING docs >= {min_docs}),
known AS (SELECT tok.doc_id, tok.n, list(coalesce(k.docs, 0) ORDER BY tok.p) AS docs, list(coalesce(k.loose, FALSE) ORDER BY tok.p) AS loose
      FROM tok LEFT JOIN constant k ON k.size = tok.size AND k.head = tok.head AND k.p = tok.p AND k.w = tok.w GROUP BY tok.doc_id, tok.n),
f AS (SELECT c.*, known.docs, known.loose, list_reverse_sort(known.docs)[need] AS least, 2 * line_docs >= leaf_docs AS steady
      FROM c JOIN known ON known.doc_id = c.doc_id AND known.n = c.n WHERE NOT few),
g AS (SELECT *, list_filter(range(1, 40), lambda x: least * (CAST(1 AS BIGINT) << x) >= leaf_docs)[1] AS halvings FROM f),
template AS (
  SELECT doc_id, n, size, head, m AS t, need FROM g WHERE steady OR line_docs > 0
  UNION ALL SELECT doc_id, n, size, head, list_transform(list_zip(m, docs),
      lambda x: CASE WHEN x[2] * (CAST(1 AS BIGINT) << halvings) >= leaf_docs THEN x[1] ELSE '<*>' END), need FROM g WHERE NOT steady AND least > 0
  UNION ALL SELECT doc_id, n, size, head, list_transform(list_zip(m, loose), lambda x: CASE WHEN x[2] THEN x[1] ELSE '<*>' END), need
      FROM g WHERE NOT steady AND line_docs = 0),
enough AS MATERIALIZED (SELECT doc_id, n, size, head, t FROM template WHERE {constants.format("t")} >= need
  UNION ALL SELECT doc_id, n, -1, [], raw FROM h WHERE few AND raw IN (SELECT raw FROM exact)),
recurring AS (SELECT size, head, t, min(ROW(doc_id, n)) AS first FROM enough GROUP BY size, head, t HAVING count(DISTINCT doc_id) >= {min_docs}),
gone AS (SELECT DISTINCT e.doc_id, e.n FROM enough e JOIN recurring r ON e.size = r.size AND e.head = r.head AND e.t = r.t
         WHERE ROW(e.doc_id, e.n) <> r.first)
SELECT l.doc_id, count(*) AS n_lines, count(gone.n) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY l.n) FILTER (WHERE gone.n IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.n = l.n GROUP BY l.doc_id"""


def chat_windows(budget: int = 1024, history_tokens: int = 256, history_turns: int = 4, block_turns: int = 256) -> str:
    return rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    len(regexp_extract_all(text, ' ?\p{{L}}{{1,6}}| ?\p{{N}}{{1,3}}| ?[^{_SPACE}\p{{L}}\p{{N}}]{{1,3}}|[{_SPACE}]+')) + 5 AS tokens,
    24 + length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\\\1|', 'g'))
       + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS chars,
    floor(turn / {block_turns}) AS block FROM given),
headed AS (SELECT *, i = 1 AND role = 'system' AS is_system,
    coalesce(max(CASE WHEN i = 1 AND role = 'system' THEN tokens END) OVER (PARTITION BY conv_id), 0) AS system_tokens,
    coalesce(max(CASE WHEN i = 1 AND role = 'system' THEN chars END) OVER (PARTITION BY conv_id), 0) AS system_chars FROM placed),
summed AS (SELECT *, sum(tokens) OVER w AS t1, sum(chars) OVER w AS c1 FROM headed WHERE NOT is_system
           WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
past AS (SELECT a.conv_id, a.i, max(a.t1 - b.t1 + b.tokens - a.tokens) AS past_tokens, max(a.c1 - b.c1 + b.chars - a.chars) AS past_chars
         FROM summed a JOIN summed b ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i < a.i AND b.turn >= a.turn - {history_turns}
          AND a.t1 - b.t1 + b.tokens - a.tokens <= {history_tokens}
          AND a.t1 - b.t1 + b.tokens <= {budget} - a.system_tokens GROUP BY a.conv_id, a.i),
ready AS (SELECT s.*, coalesce(past_tokens, 0) AS past_tokens, coalesce(past_chars, 0) AS past_chars,
            s.i = min(s.i) OVER (PARTITION BY s.conv_id) AS is_first
          FROM summed s LEFT JOIN past p ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND p.i = s.i),
walk AS (SELECT conv_id, i, block, TRUE AS begins, 0::HUGEINT AS repeated, t1 - tokens + {budget} - system_tokens AS room_end FROM ready WHERE is_first
  UNION ALL SELECT r.conv_id, r.i, r.block, r.t1 > w.room_end OR r.block IS DISTINCT FROM w.block,
    CASE WHEN r.t1 > w.room_end OR r.block IS DISTINCT FROM w.block THEN r.past_chars + r.system_chars ELSE 0 END,
    CASE WHEN r.t1 > w.room_end OR r.block IS DISTINCT FROM w.block THEN r.t1 - r.tokens - r.past_tokens + {budget} - r.system_tokens
         ELSE w.room_end END
  FROM walk w JOIN ready r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1),
extra AS (SELECT conv_id, sum(repeated) AS repeated, count(*) FILTER (WHERE begins) AS n FROM walk GROUP BY conv_id),
whole AS (SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars, string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS said,
          coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '') AS learned FROM placed GROUP BY conv_id)
SELECT w.conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars, sha256(learned) AS loss_sha256,
       CAST(chars + coalesce(repeated, 0) AS BIGINT) AS formatted_chars, CAST(coalesce(e.n, 1) AS BIGINT) AS n_windows
FROM whole w LEFT JOIN extra e ON e.conv_id IS NOT DISTINCT FROM w.conv_id"""


def centroid_rounds(k: int = 8, rounds: int = 10, dimension: int = 64, steps: int = 1024, seed: int = 3) -> str:
    parts = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
  list_transform(embedding, lambda x: CAST(floor({steps} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dimension} AND {_FINITE}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), x) - 1 AS k, x FROM kept
  WHERE vec_id IS NOT NULL QUALIFY k < {k})"""]
    gap = _GAP.format(a="c", b="x")
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT rid, vec_id, x, list_min(ds) AS d, list_position(ds, list_min(ds)) - 1 AS k
  FROM (SELECT rid, vec_id, x, list_transform(cs, lambda c: CAST({gap} AS BIGINT)) AS ds
        FROM kept, (SELECT list(x ORDER BY k) AS cs FROM c{r})))""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT k, list({_MEAN} ORDER BY i) AS x
  FROM (SELECT k, i, sum(v) AS s, count(*) AS n FROM (SELECT k, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY k, i)
  GROUP BY k UNION ALL SELECT k, x FROM c{r} WHERE k NOT IN (SELECT k FROM a{r}))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT a.vec_id, CAST(a.k AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.k = a.k"""


def part_codes(parts: int = 16, entries: int = 64, rounds: int = 2, steps: int = 256) -> str:
    text = [f"""whole AS (SELECT row_number() OVER () AS rid, vec_id, label,
  list_transform(embedding, lambda x: CAST(floor({steps} * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings WHERE {_FINITE}),
kept AS MATERIALIZED (SELECT * FROM whole WHERE len(x) > 0 AND len(x) % {parts} = 0 AND len(x) =
  (SELECT len(x) FROM whole WHERE len(x) > 0 GROUP BY len(x) ORDER BY count(*) DESC, len(x) LIMIT 1)),
part AS MATERIALIZED (SELECT rid, p, x[p * (len(x) // {parts}) + 1 : (p + 1) * (len(x) // {parts})] AS v
  FROM kept, (SELECT unnest(range({parts})) AS p)),
b0 AS MATERIALIZED (SELECT p, k, v FROM part JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id, x) - 1 AS k FROM kept
  WHERE vec_id IS NOT NULL QUALIFY k < {entries}) USING (rid))"""]
    gap = _GAP.format(a="e", b="v")
    for r in range(rounds + 1):
        text.append(f"""a{r} AS MATERIALIZED (SELECT rid, p, v, list_min(ds) AS d, list_position(ds, list_min(ds)) - 1 AS k
  FROM (SELECT rid, p, part.v, list_transform(es, lambda e: CAST({gap} AS BIGINT)) AS ds
        FROM part JOIN (SELECT p, list(v ORDER BY k) AS es FROM b{r} GROUP BY p) USING (p)))""")
        if r < rounds:
            text.append(f"""b{r + 1} AS MATERIALIZED (SELECT p, k, list({_MEAN} ORDER BY i) AS v
  FROM (SELECT p, k, i, sum(y) AS s, count(*) AS n FROM (SELECT p, k, unnest(v) AS y, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY p, k, i)
  GROUP BY p, k UNION ALL SELECT p, k, v FROM b{r} WHERE (p, k) NOT IN (SELECT (p, k) FROM a{r}))""")
    return "WITH " + ",\n".join(text) + f""",
coded AS (SELECT rid, string_agg(lower(printf('%02x', CAST(k AS INTEGER))), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, k)) FROM b{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (rid)"""
