"""DuckDB oracle SQL for the registered queries (same names, same output columns).

The views ``region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations`` are registered by the checker.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_LI_T = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_quantity, 7) AS l_quantity,
  round(l_extendedprice, 7) AS l_extendedprice, round(l_discount, 7) AS l_discount, round(l_tax, 7) AS l_tax,
  l_returnflag, l_linestatus, l_shipdate FROM lineitem"""
_LI_N = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_quantity, 7) AS l_quantity,
  round(l_extendedprice + 1e-9, 7) AS l_extendedprice,
  round(l_discount + CASE WHEN l_quantity = 50 THEN 1e-3 ELSE 0.0 END, 7) AS l_discount, round(l_tax, 7) AS l_tax,
  l_returnflag, l_linestatus, l_shipdate FROM lineitem"""
_LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
            "l_returnflag, l_linestatus, l_shipdate")
_LI_NET = f"""li_t AS ({_LI_T}), li_n AS ({_LI_N}),
li_s AS (SELECT *, 1 AS sgn FROM li_t UNION ALL SELECT *, -1 AS sgn FROM li_n),
li_g AS (SELECT {_LI_COLS}, sum(sgn) AS net FROM li_s GROUP BY {_LI_COLS})"""

ORACLE["row_diff"] = f"""WITH {_LI_NET}
SELECT {_LI_COLS}, CASE WHEN net > 0 THEN 'only_left' ELSE 'only_right' END AS side,
  CAST(abs(net) AS BIGINT) AS n_copies
FROM li_g WHERE net <> 0"""

ORACLE["schema_diff"] = """WITH l AS (SELECT column_name, column_type FROM (DESCRIBE lineitem)),
r0 AS (SELECT column_name, column_type FROM (DESCRIBE (SELECT l_orderkey, l_partkey, l_suppkey,
  CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax AS "l.tax",
  l_returnflag, l_linestatus, l_returnflag || l_linestatus AS l_comment FROM lineitem))),
r AS (SELECT replace(replace(column_name, '.', '_'), '-', '.') AS column_name, column_type FROM r0),
num AS (SELECT unnest(['TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'FLOAT', 'DOUBLE']) AS t)
SELECT column_name, 'only_left' AS side FROM l WHERE column_name NOT IN (SELECT column_name FROM r)
UNION ALL SELECT column_name, 'only_right' AS side FROM r WHERE column_name NOT IN (SELECT column_name FROM l)
UNION ALL SELECT l.column_name, 'type_mismatch' AS side FROM l JOIN r ON l.column_name = r.column_name
  WHERE l.column_type <> r.column_type
    AND NOT (l.column_type IN (SELECT t FROM num) AND r.column_type IN (SELECT t FROM num))"""

ORACLE["normalize_frame"] = """SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal + 3e-9, 7) AS s_acctbal,
  round((s_acctbal + 3e-9) / 7.0, 7) AS s_ratio FROM supplier"""

ORACLE["verify_report"] = f"""WITH {_LI_NET},
o_s AS (SELECT *, 1 AS sgn FROM orders UNION ALL SELECT *, -1 AS sgn FROM orders),
o_g AS (SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 7), o_orderdate, o_orderpriority,
  sum(sgn) AS net FROM o_s GROUP BY ALL),
o_c AS (SELECT CAST(coalesce(sum(CASE WHEN net > 0 THEN net END), 0) AS BIGINT) AS only_left,
  CAST(coalesce(sum(CASE WHEN net < 0 THEN -net END), 0) AS BIGINT) AS only_right FROM o_g),
li_c AS (SELECT CAST(coalesce(sum(CASE WHEN net > 0 THEN net END), 0) AS BIGINT) AS only_left,
  CAST(coalesce(sum(CASE WHEN net < 0 THEN -net END), 0) AS BIGINT) AS only_right FROM li_g)
SELECT 'orders' AS dataset, CASE WHEN only_left = 0 AND only_right = 0 THEN 'equal' ELSE 'rows differ' END AS status,
  only_left, only_right FROM o_c
UNION ALL SELECT 'lineitem', CASE WHEN only_left = 0 AND only_right = 0 THEN 'equal' ELSE 'rows differ' END,
  only_left, only_right FROM li_c
UNION ALL SELECT 'customer', 'schema differs', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
UNION ALL SELECT 'nation', 'no comparison', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
UNION ALL SELECT 'region', 'Not a dataframe, skipping', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
UNION ALL SELECT 'supplier', 'no comparison', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)"""
ORACLE["row_diff_exact"] = """WITH b AS (SELECT o_orderkey, 9007199254740992 + o_orderkey AS big FROM orders WHERE o_orderkey % 3 = 0)
SELECT o_orderkey, CAST(big AS VARCHAR) AS big, 'only_left' AS side, CAST(1 AS BIGINT) AS n_copies FROM b
UNION ALL SELECT o_orderkey, CAST(big + 1 AS VARCHAR), 'only_right', 1 FROM b"""

def _digest(table: str, cols: str, by: str = "", where: str = "") -> str:
    """SELECT of row count and digest: ``cols`` are column names, a trailing ``~`` marks a fractional one, ``~~`` an array of these."""
    fields = []
    for c in cols.split():
        if c.endswith("~~"):
            texts = f"list_transform({c[:-2]}, lambda x: CAST(CAST(x::DOUBLE AS DECIMAL(38,7)) AS VARCHAR))"
            items = f"array_to_string(list_transform({texts}, lambda t: coalesce(CAST(length(t) AS VARCHAR) || ':' || t, 'N')), '')"
            fields.append(f"coalesce('A' || CAST(len({c[:-2]}) AS VARCHAR) || '[' || {items} || ']', 'N')")
            continue
        text = f"CAST(CAST({c[:-1]} AS DECIMAL(38,7)) AS VARCHAR)" if c.endswith("~") else f"CAST({c} AS VARCHAR)"
        fields.append(f"coalesce(CAST(length({text}) AS VARCHAR) || ':' || {text}, 'N')")
    row = " || ".join(fields)
    sums = " || '-' || ".join(
        f"CAST(sum(CAST(CAST(('0x' || substr(h, {8 * i + 1}, 8)) AS BIGINT) AS HUGEINT)) AS VARCHAR)" for i in range(4))
    return (f"SELECT {by + ', ' if by else ''}count(*) AS n_rows, {sums} AS digest "
            f"FROM (SELECT {by + ', ' if by else ''}md5({row}) AS h FROM {table} {where}) {'GROUP BY ' + by if by else ''}")


ORACLE["dataset_digest"] = _digest("documents", "doc_id text lang source n_chars", "source")

_DOC_LINES = """SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
  CAST(unnest(generate_series(1, len(string_split(text, chr(10))))) AS INTEGER) AS line_no FROM documents"""

ORACLE["positional_diff"] = f"""WITH lines AS ({_DOC_LINES}),
nxt AS (SELECT doc_id, lead(doc_id) OVER (PARTITION BY source ORDER BY doc_id) AS next_doc FROM documents),
r AS (SELECT nxt.doc_id, l.line_no, l.line FROM lines l JOIN nxt ON l.doc_id = nxt.next_doc)
SELECT coalesce(a.doc_id, r.doc_id) AS doc_id, coalesce(a.line_no, r.line_no) AS line_no,
  a.line AS left_line, r.line AS right_line
FROM lines a FULL OUTER JOIN r ON a.doc_id = r.doc_id AND a.line_no = r.line_no
WHERE a.line IS DISTINCT FROM r.line"""

# ---------------------------------------------------------------- lineage graph

ORACLE["dependency_edges"] = """WITH pr AS (SELECT l_partkey AS dataset, min(l_orderkey) AS producer FROM lineitem GROUP BY l_partkey),
c AS (SELECT DISTINCT l_orderkey AS consumer, l_partkey AS dataset FROM lineitem)
SELECT DISTINCT c.consumer, pr.producer, c.dataset FROM c JOIN pr ON c.dataset = pr.dataset
WHERE c.consumer <> pr.producer"""

ORACLE["two_tier_lookup"] = """SELECT e.event_id, e.user_id, coalesce(s.s_name, c.c_name) AS name,
  CASE WHEN s.s_name IS NOT NULL THEN 'produced' WHEN c.c_name IS NOT NULL THEN 'external' END AS tier
FROM events e LEFT JOIN supplier s ON s.s_suppkey = e.user_id
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c ON c.c_custkey = e.user_id"""

_DAG_T = "t AS (SELECT p_partkey + 1 AS k, CAST(((p_partkey + 1) * 7919) % 1000003 AS INTEGER) AS idx FROM part)"
_DAG_INP = """inp AS (SELECT k, k // 2 AS j, 'ds' || (k // 2) AS arg FROM t WHERE k // 2 >= 1
  UNION SELECT k, k // 3, 'ds' || (k // 3) FROM t WHERE k // 3 >= 1
  UNION SELECT k, 0, 'ds0' FROM t WHERE k = 1)"""

ORACLE["external_sentinel"] = f"""WITH {_DAG_T}, {_DAG_INP}
SELECT 'T' || inp.k AS step, 'ds' || inp.j AS dataset, coalesce('T' || p.k, 'input_data') AS source
FROM inp LEFT JOIN t p ON p.k = inp.j"""

ORACLE["external_inputs"] = """SELECT o_custkey FROM orders
EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'"""

ORACLE["generated_outputs"] = "SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'"

ORACLE["duplicate_producer"] = """SELECT md5(text) AS dataset, count(DISTINCT doc_id) AS n_producers
FROM documents GROUP BY md5(text) HAVING count(DISTINCT doc_id) > 1"""

ORACLE["step_manifest"] = f"""WITH {_DAG_T}, {_DAG_INP},
src AS (SELECT inp.k, coalesce('T' || p.k, 'input_data') AS source FROM inp LEFT JOIN t p ON p.k = inp.j)
SELECT 'T' || t.k AS step, coalesce(string_agg(DISTINCT src.source, ',' ORDER BY src.source), '') AS sources,
  'template_T' || t.k || '.R' AS script, 'var_T' || t.k AS output
FROM t LEFT JOIN src ON src.k = t.k GROUP BY t.k"""

ORACLE["manifest_producers"] = f"""WITH {_DAG_T}, {_DAG_INP},
s AS (SELECT k, 'T' || k AS step FROM t UNION ALL SELECT k, 'U' || k FROM t WHERE k % 5 = 0),
src AS (SELECT s.step, coalesce(p.step, 'input_data') AS source
  FROM s JOIN inp ON inp.k = s.k LEFT JOIN s p ON p.k = inp.j)
SELECT s.step, coalesce(string_agg(DISTINCT src.source, ',' ORDER BY src.source), '') AS sources,
  'template_' || s.step || '.R' AS script, 'var_' || s.step AS output
FROM s LEFT JOIN src ON src.step = s.step GROUP BY s.step"""

ORACLE["external_names"] = """SELECT s_name AS step, 'var_' || s_name || '<-' || s_name || '(var_a' ||
  CAST(first_value(s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY (s_suppkey * 7919) % 1000003) AS VARCHAR) || ')' AS call
FROM supplier"""

ORACLE["topo_order"] = f"""WITH RECURSIVE {_DAG_T},
e AS (SELECT DISTINCT p.k AS parent, c.k AS child, CASE WHEN p.idx > c.idx THEN 1 ELSE 0 END AS w
  FROM t c JOIN t p ON p.k = c.k // 2 OR p.k = c.k // 3),
r(k, pass) AS (SELECT k, 1 FROM t WHERE k NOT IN (SELECT child FROM e)
  UNION SELECT e.child, r.pass + e.w FROM r JOIN e ON e.parent = r.k),
ps AS (SELECT k, max(pass) AS pass FROM r GROUP BY k)
SELECT 'T' || t.k AS step, t.idx, CAST(ps.pass AS INTEGER) AS pass,
  row_number() OVER (ORDER BY ps.pass, t.idx) AS seq
FROM t JOIN ps ON ps.k = t.k"""

ORACLE["unsatisfiable"] = f"""WITH RECURSIVE {_DAG_T},
inp AS (SELECT k, k // 2 AS j, 'ds' || (k // 2) AS arg FROM t WHERE k // 2 >= 1
  UNION SELECT k, k // 3, 'ds' || (k // 3) FROM t WHERE k // 3 >= 1
  UNION SELECT k, 0, 'ds0' FROM t WHERE k = 1
  UNION SELECT k, 10, 'ds10' FROM t WHERE k = 5
  UNION SELECT k, NULL, 'missing_arg' FROM t WHERE k = 7),
reach(k) AS (SELECT k FROM t WHERE k IN (5, 7)
  UNION SELECT inp.k FROM inp JOIN reach ON inp.j = reach.k)
SELECT 'T' || t.k AS step, t.idx,
  string_agg(DISTINCT inp.arg, ',' ORDER BY inp.arg) AS missing
FROM reach JOIN t ON t.k = reach.k JOIN inp ON inp.k = reach.k
WHERE inp.j IS NULL OR inp.j IN (SELECT k FROM reach)
GROUP BY t.k, t.idx"""

ORACLE["pinned_dataset"] = f"""WITH {_DAG_T}, {_DAG_INP},
kept AS (SELECT * FROM t WHERE k NOT IN (4, 6))
SELECT 'T' || inp.k AS step, 'ds' || inp.j AS dataset, coalesce('T' || p.k, 'input_data') AS source
FROM inp JOIN kept s ON s.k = inp.k LEFT JOIN kept p ON p.k = inp.j"""

# ---------------------------------------------------------------- lines, windows, rules

ORACLE["doc_lines"] = f"SELECT doc_id, line_no, line FROM ({_DOC_LINES})"
ORACLE["line_contains"] = f"SELECT doc_id, line_no, line FROM ({_DOC_LINES}) WHERE contains(line, 'License')"

_CONV_SECTIONS = """SELECT conv_id, turn, role, text, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END)
  OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS section
FROM conversations"""

ORACLE["sections"] = f"SELECT conv_id, turn, role, section FROM ({_CONV_SECTIONS})"
ORACLE["first_match"] = f"""SELECT conv_id, section, min(turn) AS turn, arg_min(text, turn) AS text
FROM ({_CONV_SECTIONS}) WHERE role = 'assistant' GROUP BY conv_id, section"""
ORACLE["section_body"] = f"""SELECT conv_id, section, string_agg(text, chr(10) ORDER BY turn) AS body
FROM ({_CONV_SECTIONS}) GROUP BY conv_id, section"""
ORACLE["seq_total"] = """SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS VARCHAR)
  || '/' || CAST(count(*) OVER (PARTITION BY conv_id) AS VARCHAR) AS label FROM conversations"""
ORACLE["null_group_scan"] = """WITH o AS (SELECT o_orderkey, nullif(o_custkey % 7, 3) AS grp, o_orderstatus FROM orders)
SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY grp) AS total,
  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_finished,
  last_value(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END IGNORE NULLS) OVER w AS last_finished,
  lag(o_orderkey) OVER w AS prev, lead(o_orderkey) OVER w AS next
FROM o WINDOW w AS (PARTITION BY grp ORDER BY o_orderkey)"""
ORACLE["null_value_join"] = """SELECT o_orderstatus || CAST(o_orderkey % 11 AS VARCHAR) AS grp,
  coalesce(string_agg(CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 1000 >= 400 THEN CAST(o_orderkey % 97 AS VARCHAR) END, ','
    ORDER BY o_orderkey), '') AS joined
FROM orders GROUP BY 1"""
ORACLE["carry_forward"] = """SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase
FROM events"""
ORACLE["prev_step"] = """SELECT o_orderkey, o_custkey,
  lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_orderkey FROM orders"""

_EMAIL = r"[0-9]+@mail[0-9]+\.example\.com"
_PHONE = r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"
ORACLE["rewrite_first_match"] = f"""SELECT doc_id, line_no, line FROM (SELECT doc_id, line_no, CASE
  WHEN regexp_matches(line, '^\\s*$') THEN NULL
  WHEN regexp_matches(line, 'token = "[0-9a-f]+"') THEN '# auto removed: ' || line
  WHEN regexp_matches(line, '^(Released|Licensed) under') THEN 'LICENSE NOTICE'
  WHEN regexp_matches(line, '{_EMAIL}') THEN regexp_replace(line, '{_EMAIL}', '<EMAIL>', 'g')
  WHEN regexp_matches(line, '{_PHONE}') THEN regexp_replace(line, '{_PHONE}', '<PHONE>', 'g')
  WHEN regexp_matches(line, '[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+')
    THEN regexp_replace(line, '[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+', '<IP>', 'g')
  ELSE regexp_replace(line, '(###|\\$\\$\\$|%%%|&&&|\\*\\*\\*)', '', 'g') END AS line FROM ({_DOC_LINES}))
WHERE line IS NOT NULL"""
ORACLE["rewrite_capture"] = f"""SELECT doc_id, line_no, CASE
  WHEN regexp_matches(line, '([0-9]+)@mail([0-9]+)\\.example\\.com')
    THEN regexp_replace(regexp_extract(line, '([0-9]+)@mail([0-9]+)\\.example\\.com', 0),
      '([0-9]+)@mail([0-9]+)\\.example\\.com', 'user\\1 at host\\2')
  WHEN regexp_matches(line, 'token = "([0-9a-f]{{8}})[0-9a-f]*"')
    THEN regexp_replace(regexp_extract(line, 'token = "([0-9a-f]{{8}})[0-9a-f]*"', 0),
      'token = "([0-9a-f]{{8}})[0-9a-f]*"', 'secret:\\1')
  ELSE line END AS line FROM ({_DOC_LINES})"""
ORACLE["rewrite_with_state"] = f"""SELECT doc_id, line_no, CASE WHEN regexp_matches(line, '{_PHONE}')
  THEN regexp_replace(line, '{_PHONE}', 'contact ' || coalesce(last_email, ''), 'g') ELSE line END AS line
FROM (SELECT *, last_value(nullif(regexp_extract(line, '{_EMAIL}', 0), '') IGNORE NULLS)
  OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_email
  FROM ({_DOC_LINES}))"""

# ---------------------------------------------------------------- scalar functions

_HOST = "^https?://([^/?#]+)"
ORACLE["regex_scalars"] = f"""SELECT page_id, regexp_extract(url, '{_HOST}', 1) AS host,
  nullif(regexp_extract(url, '[0-9]+', 0), '') AS first_num, regexp_replace(url, '[0-9]', 'N', 'g') AS masked,
  regexp_replace(url, '/', '|') AS first_slash, regexp_matches(url, '^https:') AS is_https,
  contains(url, '?') AS has_query, lower(url) AS lower_url, CAST(length(url) AS INTEGER) AS url_len,
  substr(url, 1, 12) AS head FROM pages"""
ORACLE["quoted_token"] = """SELECT event_id, split_part(props, '"', 2) AS token,
  regexp_replace(split_part(props, '"', 2), '^/', '') AS stripped, contains(split_part(props, '"', 2), '.') AS has_ext
FROM events"""
_CLEANED = """trim(regexp_replace(regexp_replace(translate(url, '=', ' '), '[",]', '', 'g'), ' +', ' ', 'g'))"""
ORACLE["clean_tokens"] = f"""SELECT page_id, pos, token FROM (SELECT page_id,
  unnest(string_split({_CLEANED}, ' ')) AS token,
  CAST(unnest(generate_series(1, len(string_split({_CLEANED}, ' ')))) AS INTEGER) AS pos FROM pages)
WHERE token <> ''"""
_PATH = "regexp_replace(url, '[?#].*$', '')"
ORACLE["array_first_match"] = f"""SELECT page_id, first_host, split_part(first_host, '.example', 1) AS site, paths
FROM (SELECT page_id,
  nullif(regexp_extract({_PATH}, '(?:^|/)([^/]*[.]example[^/]*)', 1), '') AS first_host,
  '/data/' || array_to_string(regexp_extract_all({_PATH}, '[^/]+'), ',/data/') AS paths
  FROM pages)"""
ORACLE["distinct_tokens"] = """SELECT DISTINCT split_part(regexp_replace(t, '^/', ''), ',', 1) AS token
FROM (SELECT unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS t FROM pages)"""
ORACLE["first_element"] = "SELECT doc_id, split_part(text, ' ', 1) AS first_word FROM documents"
ORACLE["token_first_last"] = f"""SELECT doc_id, line_no, string_split_regex(trim(line), ' +')[1] AS first_token,
  string_split_regex(trim(line), ' +')[-1] AS last_token FROM ({_DOC_LINES})"""

# ---------------------------------------------------------------- projections / filters

ORACLE["rename_select_isin"] = """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderpriority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"""
ORACLE["prefix_mode"] = """SELECT p_partkey, p_brand, 'R' AS mode FROM part
  WHERE starts_with(p_brand, 'Brand#1') OR starts_with(p_brand, 'Brand#2')
UNION ALL SELECT p_partkey, p_brand, 'Python' FROM part
  WHERE NOT (starts_with(p_brand, 'Brand#1') OR starts_with(p_brand, 'Brand#2'))
UNION ALL SELECT p_partkey, p_brand, 'All' FROM part"""
ORACLE["null_default"] = """SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN 'unlabeled'
  ELSE printf('q=%d,t=%d', l.quality, l.toxic) END AS label
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""
ORACLE["drop_null_ids"] = """SELECT o_orderkey, status FROM (SELECT o_orderkey,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'NULL' ELSE nullif(o_orderstatus, 'P') END AS status FROM orders)
WHERE status IS NOT NULL AND status <> 'NULL'"""
ORACLE["derived_string"] = "SELECT p_partkey, printf('step %d of %s: %s', p_partkey, p_brand, p_type) AS label FROM part"

# ---------------------------------------------------------------- packages, JSON

ORACLE["resolve_version"] = """SELECT d.doc_id, coalesce(CAST(d.doc_id AS VARCHAR) || '=' || CAST(l.quality AS VARCHAR),
  CAST(d.doc_id AS VARCHAR)) AS resolved FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""
ORACLE["translate_default"] = """SELECT event_id, event_type, CASE event_type WHEN 'click' THEN 'tap'
  WHEN 'view' THEN 'impression' ELSE event_type END AS translated FROM events"""
ORACLE["ci_first_match"] = """WITH lk(pos, name) AS (VALUES (1, 'Urgent'), (2, 'HIGH'), (3, 'urgent'), (4, 'Low'), (5, 'LOW')),
f AS (SELECT lower(name) AS low, arg_min(name, pos) AS matched FROM lk GROUP BY lower(name))
SELECT o.o_orderkey, o.word, f.matched FROM (SELECT o_orderkey, split_part(o_orderpriority, '-', 2) AS word FROM orders) o
LEFT JOIN f ON lower(o.word) = f.low"""
ORACLE["last_wins"] = "SELECT user_id, arg_max(value, ts) AS value FROM events GROUP BY user_id"
ORACLE["append_constants"] = """SELECT spec, row_number() OVER (ORDER BY spec) AS pos FROM (
  SELECT DISTINCT 'r-' || lower(replace(p_brand, '#', '')) AS spec FROM part
  UNION ALL SELECT 'r-renv' UNION ALL SELECT 'r-biocmanager')"""
ORACLE["two_key_order"] = """WITH n AS (SELECT p_partkey AS pos,
  split_part(split_part('r-' || string_split(p_name, ' ')[-1] || '=1.0', '=', 1), '-', 2) AS name FROM part),
t AS (SELECT pos, CASE name WHEN 'ring' THEN 'RingLib' WHEN 'widget' THEN 'WidgetLib' END AS lib, name FROM n
  WHERE name <> 'base')
SELECT row_number() OVER (ORDER BY lib IS NOT NULL, pos) AS seq, coalesce(lib, name) AS library,
  lib IS NOT NULL AS translated FROM t"""
ORACLE["json_props"] = """SELECT event_type, count(*) AS n, CAST(sum(json_extract(props, '$.k')::INTEGER) AS BIGINT) AS sum_k
FROM events GROUP BY event_type"""
ORACLE["json_assembly"] = """SELECT o_orderkey, CAST(to_json({'order': o_orderkey, 'customer': o_custkey, 'status': o_orderstatus,
  'items': items}) AS VARCHAR) AS doc
FROM orders JOIN (SELECT l_orderkey, list({'line': l_linenumber, 'part': l_partkey, 'supplier': l_suppkey}
    ORDER BY l_linenumber, l_partkey, l_suppkey) AS items FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey"""

ORACLE["environment_flow"] = """WITH n AS (SELECT p_partkey, 'r-' || split_part(p_name, ' ', 1) AS name, p_size FROM part),
v AS (SELECT name, arg_max(p_size, p_partkey) AS size FROM n GROUP BY name),
specs AS (SELECT name || '=' || CAST(size AS VARCHAR) || '.0' AS spec FROM v
  UNION ALL SELECT * FROM (VALUES ('r-seurat'), ('r-renv'), ('r-biocmanager')) x(spec)
  WHERE EXISTS (SELECT 1 FROM part) OR x.spec <> 'r-seurat'),
env AS (SELECT row_number() OVER (ORDER BY spec) AS pos, spec FROM specs),
named AS (SELECT pos, split_part(split_part(spec, '=', 1), '-', 2) AS name FROM env),
lib AS (SELECT pos, CASE name WHEN 'seurat' THEN 'Seurat' WHEN 'biocmanager' THEN 'BiocManager' ELSE name END AS library,
  name IN ('seurat', 'biocmanager') AS translated FROM named)
SELECT 'spec' AS kind, pos AS seq, spec AS value FROM env
UNION ALL SELECT 'library', row_number() OVER (ORDER BY translated, pos), library FROM lib"""

# ---------------------------------------------------------------- membership, mapping, lists

ORACLE["semi_join"] = """SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"""
ORACLE["anti_join"] = """SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"""
ORACLE["two_hop"] = """SELECT c.c_custkey, n.n_name, r.r_name FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""
ORACLE["unmet_requirements"] = """SELECT pattern FROM (VALUES ('MIT License'), ('Apache License'),
  ('GNU General Public License'), ('BSD License'), ('token = "'), ('password'), ('@mail'),
  ('SPDX-License-Identifier')) t(pattern)
WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE contains(d.text, t.pattern))"""
ORACLE["ordered_args"] = "SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id"
ORACLE["ordered_ids"] = """SELECT p_brand, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS part_keys
FROM part GROUP BY p_brand"""
ORACLE["base64_roundtrip"] = "SELECT item_id, md5(from_base64(to_base64(encode(text)))) AS digest FROM benchmark"

# ---------------------------------------------------------------- sources, snapshots

ORACLE["load_parts"] = "SELECT * FROM orders"
# the rule as the reference states it: a csv is read only when it is the one file there
ORACLE["format_dispatch"] = f"""SELECT host, CASE WHEN bool_or(name LIKE '%.parquet') THEN 'parquet'
  WHEN count(*) = 1 AND bool_and(name LIKE '%.csv') THEN 'csv' WHEN bool_or(name LIKE '%abc') THEN 'abc'
  WHEN bool_or(name LIKE '%.rds') THEN 'rds' WHEN bool_or(name LIKE '%.h5') THEN 'h5' ELSE 'paths' END AS format,
  count(*) AS n_files
FROM (SELECT regexp_extract(url, '{_HOST}', 1) || '/' || CAST(page_id % 41 AS VARCHAR) AS host,
  string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1] ||
    ['.csv', '.rds', '.parquet', 'abc', '.h5', '.txt', '.csv'][((page_id * 7) % 7 + page_id % 3) % 7 + 1] AS name FROM pages) GROUP BY host"""
ORACLE["csv_text_load"] = """SELECT doc_id, 'say "hi", ok: ' || text AS text, lang FROM documents"""
ORACLE["load_dataset"] = """SELECT 'parts' AS folder, 'parquet' AS format, s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT 'single', 'csv', s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 1
UNION ALL SELECT 'several', 'paths', NULL, NULL"""
ORACLE["csv_load"] = """SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"""
ORACLE["basename_last_wins"] = """SELECT basename, arg_max(page_id, page_id) AS page_id, arg_max(url, page_id) AS url
FROM (SELECT page_id, url, string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1] AS basename FROM pages)
GROUP BY basename"""
_LATEST = """SELECT o_custkey AS dataset_rid, 'master' AS branch, o_orderkey AS txn_rid, o_orderdate AS close_time
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1"""
ORACLE["latest_committed"] = _LATEST
ORACLE["snapshot_rows"] = f"""SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT txn_rid FROM ({_LATEST}))"""
_REV = """SELECT n.n_nationkey, n.n_name, count(*) AS n_orders,
  CAST(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS BIGINT) AS revenue_cents
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"""
ORACLE["materialize_reload"] = f"SELECT * FROM ({_REV} GROUP BY n.n_nationkey, n.n_name)"
ORACLE["publish_read"] = "SELECT * FROM orders WHERE o_orderstatus = 'O'"
ORACLE["run_workbook"] = """SELECT n.n_name, count(*) AS n_orders,
  CAST(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS BIGINT) AS revenue_cents
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_orderstatus = 'F' GROUP BY n.n_name"""

ORACLE["image_export"] = """SELECT 'doc_' || CAST(doc_id AS VARCHAR) || '.png' AS file_name, md5(text) AS digest
FROM documents WHERE lang = 'en'"""
ORACLE["step_scripts"] = f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS seq,
  string_split_regex(trim(line), ' +')[1] AS call, string_split_regex(trim(line), ' +')[-1] AS script,
  regexp_replace(string_split_regex(trim(line), ' +')[-1], '\\.$', '') AS name
FROM ({_DOC_LINES}) WHERE contains(line, 'License')"""

ORACLE["script_topo_order"] = f"SELECT step, pass, seq FROM ({ORACLE['topo_order']})"
ORACLE["two_scripts_order"] = f"""WITH o AS ({ORACLE['topo_order']})
SELECT CAST(d.doc_id AS BIGINT) AS doc_id, step, pass, seq + (d.doc_id - 1) * (SELECT count(*) FROM o) AS seq
FROM o, (VALUES (1), (2)) d(doc_id)"""
ORACLE["bound_calls"] = f"""WITH {_DAG_T}, {_DAG_INP},
a AS (SELECT inp.k, inp.j, 'var_' || coalesce('T' || p.k, 'ds' || inp.j) AS var,
  CASE WHEN inp.j = inp.k // 2 THEN 1 ELSE 2 END AS pos FROM inp LEFT JOIN t p ON p.k = inp.j),
d AS (SELECT k, pos, var FROM a UNION ALL SELECT k, 2, var FROM a WHERE k // 2 = k // 3 AND k // 3 >= 1)
SELECT 'T' || t.k AS step, 'var_T' || t.k || '<-T' || t.k || '(' || string_agg(d.var, ',' ORDER BY d.pos) || ')' AS call
FROM t JOIN d ON d.k = t.k GROUP BY t.k"""

_HASHED = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey", "supplier": "s_suppkey s_name s_nationkey s_acctbal~",
    "customer": "c_custkey c_name c_nationkey c_acctbal~ c_mktsegment", "part": "p_partkey p_name p_brand p_type p_size p_retailprice~",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice~ o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity~ l_extendedprice~ l_discount~ l_tax~ l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value~ props", "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding~~ label", "pages": "page_id url html",
    "benchmark": "item_id text", "labels": "doc_id quality toxic", "conversations": "conv_id turn role text",
}
ORACLE["output_hashes"] = " UNION ALL ".join(
    f"SELECT {i + 1} AS pos, '{t}' AS dataset, n_rows, digest FROM ({_digest(t, c)})" for i, (t, c) in enumerate(_HASHED.items()))
ORACLE["golden_hash_diff"] = f"""SELECT 'customer' AS dataset, p.digest AS produced, g.digest AS golden, 'changed' AS status
FROM ({_digest('customer', _HASHED['customer'])}) p, ({_digest('customer', _HASHED['customer'], where='WHERE c_custkey <> 7')}) g
UNION ALL SELECT 'orders', digest, NULL, 'extra' FROM ({_digest('orders', _HASHED['orders'])})
UNION ALL SELECT 'region', NULL, digest, 'missing' FROM ({_digest('region', _HASHED['region'])})"""

ORACLE["workbook_verify"] = """WITH fin AS (SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 7) AS p,
  o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'F'),
rev AS (SELECT n.n_name, count(*) AS n_orders, CAST(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE o.o_orderstatus = 'F' GROUP BY n.n_name),
produced_rev AS (SELECT n_name, count(*) AS n_orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM (SELECT * FROM orders WHERE o_orderstatus = 'F') f JOIN customer c ON f.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n_name),
counts AS (
  SELECT 'finished_orders' AS dataset,
    (SELECT count(*) FROM (SELECT * FROM fin EXCEPT ALL SELECT * FROM fin)) AS only_left,
    (SELECT count(*) FROM (SELECT * FROM fin EXCEPT ALL SELECT * FROM fin)) AS only_right
  UNION ALL SELECT 'revenue',
    (SELECT count(*) FROM (SELECT * FROM rev EXCEPT ALL SELECT * FROM produced_rev)),
    (SELECT count(*) FROM (SELECT * FROM produced_rev EXCEPT ALL SELECT * FROM rev)))
SELECT dataset, CASE WHEN only_left = 0 AND only_right = 0 THEN 'equal' ELSE 'rows differ' END AS status,
  CAST(only_left AS BIGINT) AS only_left, CAST(only_right AS BIGINT) AS only_right FROM counts
UNION ALL SELECT 'orders_by_nation', 'schema differs', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
UNION ALL SELECT 'missing_step', 'no comparison', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)"""

ORACLE["run_plan"] = f"""WITH o AS ({ORACLE['topo_order']}),
c AS ({ORACLE['bound_calls']}),
m AS ({ORACLE['step_manifest']})
SELECT o.seq, o.step, CAST(o.seq AS VARCHAR) || '/' || CAST((SELECT count(*) FROM o) AS VARCHAR) AS label,
  c.call, m.sources, m.script, m.output
FROM o JOIN c ON c.step = o.step JOIN m ON m.step = o.step"""


ORACLE["node_aliases"] = """SELECT CAST(o_orderkey AS VARCHAR) AS output_id, c_name AS alias
FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F'"""
ORACLE["missing_report"] = f"SELECT coalesce(string_agg(pattern, ', ' ORDER BY pattern), '') AS missing FROM ({ORACLE['unmet_requirements']})"
ORACLE["snapshot_files"] = f"""WITH l AS ({_LATEST})
SELECT o_custkey AS dataset_rid, 'f' || CAST(l_partkey % 3 AS VARCHAR) || '.parquet' AS basename,
  max(l_linenumber * 1000000 + l_partkey) AS position
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN l ON l.dataset_rid = o_custkey AND l.txn_rid = l_orderkey
WHERE l_linenumber % 5 > 0 GROUP BY 1, 2"""

ORACLE["snapshot_branches"] = """WITH t AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'master' ELSE 'dev' END AS branch, o_orderdate
  FROM orders WHERE o_orderstatus = 'F'),
l AS (SELECT o_custkey, branch, o_orderkey FROM t
  QUALIFY row_number() OVER (PARTITION BY o_custkey, branch ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT o_custkey AS dataset_rid, branch, 'f' || CAST(l_partkey % 3 AS VARCHAR) || '.parquet' AS basename,
  max(l_linenumber * 1000000 + l_partkey) AS position
FROM lineitem JOIN l ON l_orderkey = o_orderkey WHERE l_linenumber % 5 > 0 GROUP BY 1, 2, 3"""
ORACLE["publish_branches"] = """SELECT *, 'master' AS branch FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT *, 'dev/new' FROM orders WHERE o_orderstatus = 'P'"""
ORACLE["group_sums"] = """WITH o AS (SELECT o_orderkey, o_custkey % 5 AS grp,
  CASE WHEN o_custkey % 5 = 0 THEN 1e17::DOUBLE WHEN o_custkey % 5 = 1 THEN 0.25::DOUBLE
    WHEN o_custkey % 5 = 2 AND o_orderkey % 50 = 7 THEN 'NaN'::DOUBLE ELSE 0.5::DOUBLE END AS value,
  CAST(o_orderkey % 1000 AS DECIMAL(12,2)) + 0.75 AS exact FROM orders),
s AS (SELECT o_orderkey, grp, sum(value) OVER w AS total, sum(exact) OVER w AS total_exact FROM o
  WINDOW w AS (PARTITION BY grp ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING))
SELECT o_orderkey, grp, isnan(total) AS is_nan, CASE WHEN isnan(total) THEN -1.0::DOUBLE ELSE total END AS total,
  CAST(CAST(total_exact AS DECIMAL(38,2)) AS VARCHAR) AS total_exact FROM s"""
ORACLE["chain_order"] = """SELECT 'T' || (p_partkey + 1) AS step, CAST(1000003 - p_partkey - 1 AS INTEGER) AS idx,
  CAST(p_partkey + 1 AS INTEGER) AS pass, CAST(p_partkey + 1 AS BIGINT) AS seq FROM part"""
ORACLE["unmet_patterns"] = """WITH p AS (
  SELECT unnest([p_name, p_type, '@mail' || CAST(p_partkey % 50 AS VARCHAR) || '.example.com']) AS pattern FROM part
  UNION SELECT unnest([text, substr(text, 10, 30), text || '!?']) FROM benchmark
  UNION SELECT unnest(['', 'e', '~', '###', '#!#', chr(252), 'token =', r_name]) FROM region)
SELECT pattern FROM p WHERE pattern IS NOT NULL AND NOT EXISTS (SELECT 1 FROM documents WHERE contains(text, pattern))"""
ORACLE["image_files"] = ORACLE["image_export"]
ORACLE["workbook_binding"] = """SELECT c_mktsegment, CASE o_orderpriority WHEN '1-URGENT' THEN '10' WHEN '2-HIGH' THEN '20' WHEN '3-MEDIUM' THEN '30' END AS code,
  count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""
ORACLE["shared_steps"] = """WITH l AS (SELECT l_returnflag, l_linestatus, l_partkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem WHERE l_quantity >= 10)
SELECT l_returnflag AS key, CAST(sum(cents) AS BIGINT) AS cents, 'by_flag' AS output FROM l GROUP BY 1
UNION ALL SELECT l_linestatus, CAST(sum(cents) AS BIGINT), 'by_status' FROM l GROUP BY 1
UNION ALL SELECT CAST(l_partkey % 10 AS VARCHAR), CAST(sum(cents) AS BIGINT), 'by_part' FROM l GROUP BY 1"""
