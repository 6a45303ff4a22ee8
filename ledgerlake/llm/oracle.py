"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

OP2 = """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(greatest(length(h) // 2 - 49, 0))) AS p FROM doc)),
early AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s),
gone AS (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM win JOIN early USING (s) WHERE first < doc_id),
run AS (SELECT doc_id, p, sum((gap IS NULL OR gap > 50)::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM gone),
span AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM run GROUP BY 1, 2),
piece AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY run), 0) AS since FROM span),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY run) AS body, max(b) AS last, sum(b - a) AS n_removed, count(*) AS n_spans
  FROM piece JOIN doc USING (doc_id) GROUP BY 1)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(body || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""

OP3 = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[s + 1 : s + least(len(w), 13)], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 12, 1))) AS s FROM item WHERE len(w) > 0)),
spot AS (
  SELECT doc_id, s, size, array_to_string(w[s + 1 : s + size], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(greatest(len(w) - size + 1, 0))) AS s FROM doc, (SELECT DISTINCT size FROM win))),
met AS (SELECT doc_id, s, spot.size, item_id FROM spot JOIN win ON spot.phrase = win.phrase AND spot.size = win.size),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM met) GROUP BY 1),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
        FROM (SELECT DISTINCT doc_id, item_id FROM met) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)
"""

OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM (SELECT * FROM v WHERE vec_id % 50 = 0) q JOIN v c ON c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

OP9 = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
cost AS (
  SELECT *, ceil(length(role || text) / 4.0)::BIGINT + 4 AS tokens,
    length(regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g'))
      + length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')) + 20 AS chars FROM said),
placed AS (
  SELECT *, row_number() OVER w - 1 AS pos, sum(tokens) OVER w - tokens AS before, sum((tokens > 384)::INT) OVER w AS large FROM cost
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
span AS (
  SELECT conv_id, min(pos) AS first, min(before) AS at FROM placed
  GROUP BY conv_id, large, CASE WHEN tokens > 384 THEN -1 ELSE before // 384 END),
opening AS (SELECT conv_id, tokens AS kept FROM placed WHERE pos = 0 AND role = 'system'),
again AS (
  SELECT p.conv_id, p.pos, count(*) AS times FROM placed p JOIN span s ON p.conv_id = s.conv_id AND s.first > p.pos
  LEFT JOIN opening o ON o.conv_id = p.conv_id
  WHERE (p.pos = 0 AND p.role = 'system') OR s.at - p.before <= 256 - coalesce(o.kept, 0) GROUP BY ALL)
SELECT p.conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars * (1 + coalesce(times, 0)))::BIGINT AS formatted_chars
FROM placed p LEFT JOIN again USING (conv_id, pos) GROUP BY p.conv_id
"""

OP10 = """
WITH line AS (
  SELECT doc_id, pos, l, length(l) >= 20 AS long_line,
         count(l) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) = 4 AS has_four,
         list(l) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS four
  FROM (SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS l
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
copy AS (
  SELECT *, row_number() OVER (PARTITION BY l ORDER BY doc_id, pos) > 1 AND long_line AS one,
         row_number() OVER (PARTITION BY four ORDER BY doc_id, pos) > 1 AND has_four AS run FROM line),
gone AS (
  SELECT doc_id, pos, l, one OR coalesce(bool_or(run) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), false) AS gone
  FROM copy),
edge AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS first FROM gone)
SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_removed, count_if(first)::BIGINT AS n_runs,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM edge GROUP BY doc_id
"""


def url_filter(depth: int = 8, branches: int = 16) -> str:
    """The template tree with its levels written out."""
    steps = [r"""
label AS (SELECT doc_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
page AS (
  SELECT page_id, coalesce(url, '') AS url,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
part AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(url, '://[^/?#]*/[^?#]*?([0-9]{1,18})(?:\.html)?/?(?:[?#]|$)', 1) AS number FROM page),
cutup AS (SELECT *, CASE WHEN path = '' THEN [] ELSE string_split(substr(path, 2), '/') END AS raw FROM part),
shaped AS (
  SELECT c.page_id, host, path, l.good,
    list_concat(list_transform(raw[:DEPTH], lambda s: CASE WHEN length(s) > 64 THEN '*' ELSE regexp_replace(s, '[0-9]+', '#', 'g') END),
                CASE WHEN len(raw) > DEPTH THEN ['**'] ELSE [] END) AS shape
  FROM cutup c LEFT JOIN label l ON l.doc_id = TRY_CAST(number AS BIGINT)),
shapes AS MATERIALIZED (
  SELECT host, shape, coalesce(sum((good = 1)::INT), 0)::DOUBLE AS good, count(good)::DOUBLE AS labelled FROM shaped GROUP BY 1, 2),
prior AS (SELECT (coalesce(sum(good), 0) + 10.0 * 0.5) / (coalesce(sum(labelled), 0) + 10.0) AS p FROM shapes),
hosts AS (SELECT host, (sum(good) + 10.0 * any_value(p)) / (sum(labelled) + 10.0) AS purity FROM shapes, prior GROUP BY 1),
t0 AS MATERIALIZED (SELECT s.*, purity, '' AS template FROM shapes s JOIN hosts USING (host))""".replace("DEPTH", str(depth))]
    for k in range(depth + 1):
        steps.append(f"""
here{k} AS MATERIALIZED (SELECT *, shape[{k + 1}] AS segment FROM t{k}),
kid{k} AS MATERIALIZED (
  SELECT host, template, segment, sum(good) AS good, sum(labelled) AS labelled, any_value(purity) AS parent
  FROM here{k} WHERE segment IS NOT NULL GROUP BY 1, 2, 3),
wide{k} AS MATERIALIZED (
  SELECT host, template, (sum(good) + 10.0 * any_value(parent)) / (sum(labelled) + 10.0) AS wild FROM kid{k} GROUP BY 1, 2
  HAVING count(*) > {branches}),
near{k} AS (
  SELECT *, CASE WHEN labelled > 0 THEN good / labelled END AS share FROM kid{k} ANTI JOIN wide{k} USING (host, template)),
step{k} AS (
  SELECT *, lag(good) OVER w AS good0, lag(labelled) OVER w AS labelled0 FROM near{k}
  WINDOW w AS (PARTITION BY host, template ORDER BY share NULLS LAST, segment)),
test{k} AS (
  SELECT *, coalesce(CASE WHEN labelled > 0 AND labelled0 > 0 THEN
      (good / labelled - good0 / labelled0) * (good / labelled - good0 / labelled0) > 1.96 * 1.96 * ((good + good0) / (labelled + labelled0))
        * (1 - (good + good0) / (labelled + labelled0)) * (1 / labelled + 1 / labelled0) END, false)::INT AS cut FROM step{k}),
branch{k} AS (
  SELECT *, sum(cut) OVER (PARTITION BY host, template ORDER BY share NULLS LAST, segment ROWS UNBOUNDED PRECEDING) AS branch FROM test{k}),
merged{k} AS MATERIALIZED (
  SELECT host, template, string_agg(segment, '|' ORDER BY segment) AS label, list(segment) AS segments,
    (sum(good) + 10.0 * any_value(parent)) / (sum(labelled) + 10.0) AS own FROM branch{k} GROUP BY host, template, branch),
own{k} AS (SELECT host, template, unnest(segments) AS segment, label, own FROM merged{k}),
t{k + 1} AS MATERIALIZED (
  SELECT h.host, h.shape, h.good, h.labelled,
    CASE WHEN h.segment IS NULL THEN h.purity ELSE coalesce(wild, own) END AS purity,
    CASE WHEN h.segment IS NULL THEN h.template ELSE h.template || '/' || CASE WHEN wild IS NULL THEN label ELSE '*' END END AS template
  FROM here{k} h LEFT JOIN wide{k} w ON w.host = h.host AND w.template = h.template
  LEFT JOIN own{k} o ON o.host = h.host AND o.template = h.template AND o.segment = h.segment)""")
    return "WITH" + ",".join(steps) + f""",
ruled AS (
  SELECT page_id, host, path, shape, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM shaped)
SELECT page_id, r.host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN purity < 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled r LEFT JOIN t{depth + 1} t ON t.host = r.host AND t.shape = r.shape
"""


ORACLE: dict[str, str] = {"op2_suffix_array_dedup": OP2, "op3_decontamination": OP3, "op7_top_k": OP7, "op9_chat_formatting": OP9, "op10_line_dedup": OP10,
                          "op11_url_filter": url_filter()}
