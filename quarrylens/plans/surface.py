"""The relational surface of the analysed dialect, one query for each construct, re-expressed in Spark SQL.

A query is its Spark text and, where the two engines spell a construct differently, the text of the other engine.
"""

from __future__ import annotations

from .sql import over_tables

MONEY = "DECIMAL(18,2)"

#: name -> (Spark SQL, other SQL or None where the Spark text serves both)
QUERIES: dict[str, tuple[str, str | None]] = {
    # scans and table sources
    "scan_from_list": ("SELECT n_name, r_name FROM nation, region WHERE n_regionkey = r_regionkey", None),
    "scan_subquery": ("SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n FROM (SELECT c_mktsegment FROM customer WHERE c_acctbal > 0) q GROUP BY c_mktsegment", None),
    "scan_collection": ("SELECT doc_id, w FROM documents LATERAL VIEW explode(array(lang, source)) t AS w", "SELECT doc_id, unnest([lang, source]) AS w FROM documents"),
    "scan_partition_filter": ("SELECT doc_id, source FROM documents WHERE lang = 'fr'", None),
    "json_table": ("SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM events", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"),
    "json_nested_path": ("SELECT n, p.v AS v, p.w AS w FROM (SELECT n_nationkey AS n, from_json(concat('[{\"v\":', n_nationkey, ',\"w\":1},{\"v\":', n_nationkey + 1, ',\"w\":2}]'), 'array<struct<v: int, w: int>>') AS a FROM nation) LATERAL VIEW explode(a) t AS p", "SELECT n_nationkey AS n, n_nationkey + o AS v, o + 1 AS w FROM nation, (VALUES (0), (1)) x(o)"),
    "cursor_expression": ("SELECT r_name, CAST(size(collect_list(struct(n_name))) AS BIGINT) AS nations, min(n_name) AS first_name FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name", "SELECT r_name, CAST(count(*) AS BIGINT) AS nations, min(n_name) AS first_name FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name"),
    # projection, filter, predicates
    "select_distinct": ("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders", None),
    "predicate_logic": ("SELECT c_custkey FROM customer WHERE (c_acctbal > 5000 OR c_mktsegment = 'BUILDING') AND NOT c_nationkey IN (1, 2, 3)", None),
    "predicate_is": ("SELECT CAST(count(*) AS BIGINT) AS n FROM (SELECT nullif(o_orderstatus, 'O') AS s FROM orders) q WHERE s IS NULL", None),
    "predicate_between": ("SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20", None),
    "predicate_like": (r"SELECT c_custkey, c_name FROM customer WHERE c_name LIKE '%!_0%' ESCAPE '!' OR c_name LIKE 'Cust%5'", None),
    "predicate_in_subquery": ("SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)", None),
    "predicate_relational": ("SELECT o_orderkey FROM orders WHERE o_totalprice >= 100000 AND o_orderstatus <> 'F' AND o_totalprice < 150000", None),
    "quantified_exists": ("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)", None),
    "quantified_all": ("SELECT p_partkey FROM part WHERE p_retailprice >= (SELECT max(p_retailprice) FROM part WHERE p_size < 10)", None),
    "quantified_any": ("SELECT s_suppkey FROM supplier WHERE s_acctbal > (SELECT min(c_acctbal) FROM customer)", None),
    "multiset_ops": ("SELECT n_nationkey AS k, array_size(array_union(array(n_nationkey, 1), array(1, 2))) AS u, array_size(array_intersect(array(n_nationkey, 1), array(1, 2))) AS i, array_size(array_except(array(n_nationkey, 1), array(1, 2))) AS e FROM nation", "SELECT n_nationkey AS k, CAST(len(list_distinct(list_concat([n_nationkey, 1], [1, 2]))) AS INT) AS u, CAST(len(list_intersect([n_nationkey, 1], [1, 2])) AS INT) AS i, CAST(len(list_filter(list_distinct([n_nationkey, 1]), lambda x: NOT list_contains([1, 2], x))) AS INT) AS e FROM nation"),
    "case_expression": ("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'other' END AS simple_case, CASE WHEN o_totalprice > 200000 THEN 'big' ELSE 'small' END AS searched FROM orders", None),
    "concatenation": ("SELECT n_nationkey, n_name || '-' || CAST(n_regionkey AS STRING) AS label, n_nationkey % 3 AS m, CAST(power(n_regionkey, 2) AS BIGINT) AS sq FROM nation", "SELECT n_nationkey, n_name || '-' || CAST(n_regionkey AS VARCHAR) AS label, n_nationkey % 3 AS m, CAST(power(n_regionkey, 2) AS BIGINT) AS sq FROM nation"),
    # joins
    "join_inner": (f"SELECT o_orderkey, c_name, CAST(o_totalprice AS {MONEY}) AS price FROM orders JOIN customer ON o_custkey = c_custkey", None),
    "join_left": ("SELECT c_custkey, CAST(count(o_orderkey) AS BIGINT) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey", None),
    "join_right": ("SELECT n_name, s_suppkey FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey", None),
    "join_full": ("SELECT s_suppkey, c_custkey FROM supplier FULL JOIN customer ON s_suppkey = c_custkey + 5", None),
    "join_cross": ("SELECT r_name, n_name FROM region CROSS JOIN nation", None),
    "join_natural": ("SELECT k, a, b FROM (SELECT n_nationkey AS k, n_name AS a FROM nation) x NATURAL JOIN (SELECT s_nationkey AS k, s_suppkey AS b FROM supplier) y", None),
    "join_using": ("SELECT doc_id, lang, toxic FROM documents JOIN labels USING (doc_id)", None),
    "join_theta": ("SELECT a.n_name AS a_name, b.n_name AS b_name FROM nation a JOIN nation b ON a.n_regionkey < b.n_regionkey AND a.n_nationkey > b.n_nationkey", None),
    "join_semi": ("SELECT s_suppkey FROM supplier LEFT SEMI JOIN lineitem ON l_suppkey = s_suppkey AND l_quantity > 49", "SELECT s_suppkey FROM supplier WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity > 49)"),
    "join_anti": ("SELECT c_custkey FROM customer LEFT ANTI JOIN orders ON o_custkey = c_custkey", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)"),
    "join_apply": (f"SELECT r_name, t.n FROM region, LATERAL (SELECT CAST(count(*) AS BIGINT) AS n FROM nation WHERE n_regionkey = r_regionkey) t", None),
    "join_partitioned_outer": ("SELECT k.lang, k.source, CAST(count(d.doc_id) AS BIGINT) AS n FROM (SELECT lang, source FROM (SELECT DISTINCT lang FROM documents) l, (SELECT DISTINCT source FROM documents) s) k LEFT JOIN documents d ON d.lang = k.lang AND d.source = k.source GROUP BY k.lang, k.source", None),
    # aggregation
    "group_having": (f"SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS {MONEY})) AS {MONEY}) AS qty, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus HAVING count(*) > 10", None),
    "agg_rollup": ("SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n, CAST(grouping(o_orderpriority) AS INT) AS g FROM orders GROUP BY ROLLUP(o_orderstatus, o_orderpriority)", None),
    "agg_cube": ("SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY CUBE(l_returnflag, l_linestatus)", None),
    "agg_grouping_sets": ("SELECT lang, source, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY GROUPING SETS ((lang), (source), ())", None),
    "agg_distinct": ("SELECT l_returnflag, CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY l_returnflag", None),
    "agg_keep_first": ("SELECT c_nationkey, max_by(c_custkey, struct(c_acctbal, c_custkey)) AS richest, min_by(c_custkey, struct(c_acctbal, c_custkey)) AS poorest FROM customer GROUP BY c_nationkey", "SELECT c_nationkey, arg_max(c_custkey, (c_acctbal, c_custkey)) AS richest, arg_min(c_custkey, (c_acctbal, c_custkey)) AS poorest FROM customer GROUP BY c_nationkey"),
    "agg_statistics": ("SELECT c_nationkey, CAST(round(CAST(var_pop(c_custkey) AS DECIMAL(30,10)), 3) AS DECIMAL(24,3)) AS v, CAST(round(CAST(stddev_samp(c_custkey) AS DECIMAL(30,10)), 3) AS DECIMAL(24,3)) AS s, CAST(round(CAST(median(c_custkey) AS DECIMAL(30,10)), 3) AS DECIMAL(24,3)) AS m FROM customer GROUP BY c_nationkey HAVING count(*) > 2", None),
    "agg_regression": ("SELECT l_returnflag, CAST(round(CAST(corr(l_linenumber, l_partkey) AS DECIMAL(20,10)), 4) AS DECIMAL(10,4)) AS r, CAST(round(CAST(covar_pop(l_linenumber, l_suppkey) AS DECIMAL(20,8)), 3) AS DECIMAL(16,3)) AS c, CAST(round(CAST(regr_slope(l_linenumber, l_suppkey) AS DECIMAL(20,10)), 5) AS DECIMAL(12,5)) AS b FROM lineitem GROUP BY l_returnflag", None),
    "agg_percentile": ("SELECT p_brand, CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY p_size) AS INT) AS mid, CAST(percentile_cont(0.25) WITHIN GROUP (ORDER BY p_size) AS DECIMAL(10,4)) AS q1 FROM part GROUP BY p_brand", "SELECT p_brand, CAST(quantile_disc(p_size, 0.5) AS INT) AS mid, CAST(quantile_cont(p_size, 0.25) AS DECIMAL(10,4)) AS q1 FROM part GROUP BY p_brand"),
    "agg_listagg": ("SELECT n_regionkey, listagg(n_name, ',') WITHIN GROUP (ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey"),
    "agg_collect_ordered": ("SELECT n_regionkey, array_join(transform(sort_array(collect_list(struct(n_nationkey, n_name))), x -> x.n_name), '|') AS names FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, string_agg(n_name, '|' ORDER BY n_nationkey) AS names FROM nation GROUP BY n_regionkey"),
    "agg_ratio_to_report": ("SELECT n_nationkey, CAST(CAST(n_nationkey AS DECIMAL(12,0)) / sum(CAST(n_nationkey AS DECIMAL(12,0))) OVER (PARTITION BY n_regionkey) AS DECIMAL(12,6)) > 0.25 AS large_share FROM nation WHERE n_nationkey > 0", None),
    # windows
    "window_ranking": ("SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS rk, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS dr FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)", "SELECT o_orderkey, CAST(row_number() OVER w AS INT) AS rn, CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS INT) AS rk, CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS INT) AS dr FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"),
    "window_frame_rows": (f"SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS {MONEY})) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS {MONEY}) AS s FROM orders", None),
    "window_frame_range": ("SELECT l_orderkey, l_linenumber, CAST(count(*) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS BIGINT) AS n FROM lineitem", None),
    "window_lead_lag": ("SELECT conv_id, turn, role, lag(role) OVER w AS before, lead(role, 1, 'end') OVER w AS after FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)", None),
    "window_first_last": ("SELECT conv_id, turn, first_value(role) OVER w AS f, last_value(role) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l, nth_value(role, 2) OVER w AS second FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)", None),
    "window_ignore_nulls": ("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END) IGNORE NULLS OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_user FROM conversations", "SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_user FROM conversations"),
    "window_ntile": ("SELECT c_custkey, ntile(4) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS q FROM customer", "SELECT c_custkey, CAST(ntile(4) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INT) AS q FROM customer"),
    "window_distribution": ("SELECT p_partkey, CAST(percent_rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS DECIMAL(12,8)) AS pr, CAST(cume_dist() OVER (PARTITION BY p_brand ORDER BY p_size) AS DECIMAL(12,8)) AS cd FROM part", None),
    # sort, limit, top-k
    "order_nulls_last": ("SELECT o_orderkey, s FROM (SELECT o_orderkey, nullif(o_orderstatus, 'O') AS s FROM orders) q ORDER BY s ASC NULLS LAST, o_orderkey LIMIT 40", None),
    "order_offset": ("SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 20 OFFSET 30", None),
    "fetch_with_ties": ("SELECT p_partkey, p_size FROM part WHERE p_size >= (SELECT min(p_size) FROM (SELECT p_size FROM part ORDER BY p_size DESC LIMIT 5) q)", "SELECT p_partkey, p_size FROM (SELECT p_partkey, p_size, rank() OVER (ORDER BY p_size DESC) AS r FROM part) q WHERE r <= 5"),
    "top_k_per_group": ("SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) q WHERE r <= 2", None),
    # set operations
    "set_union": ("SELECT n_nationkey AS k FROM nation UNION SELECT s_nationkey FROM supplier", None),
    "set_union_all": ("SELECT n_nationkey AS k FROM nation UNION ALL SELECT s_nationkey FROM supplier", None),
    "set_intersect": ("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier", None),
    "set_minus": ("SELECT n_nationkey AS k FROM nation MINUS SELECT s_nationkey FROM supplier WHERE s_acctbal < 0", "SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal < 0"),
    # CTE, hierarchy, pivot
    "with_clause": ("WITH big AS (SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey), top AS (SELECT * FROM big WHERE n > 12) SELECT c_name, n FROM top JOIN customer ON c_custkey = o_custkey", None),
    "pivot": ("SELECT * FROM (SELECT o_orderpriority, o_orderstatus, 1 AS one FROM orders) PIVOT (CAST(sum(one) AS BIGINT) FOR o_orderstatus IN ('F' AS f, 'O' AS o, 'P' AS p))", "SELECT o_orderpriority, CAST(nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS BIGINT) AS f, CAST(nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS BIGINT) AS o, CAST(nullif(count(*) FILTER (o_orderstatus = 'P'), 0) AS BIGINT) AS p FROM orders GROUP BY o_orderpriority"),
    "unpivot": ("SELECT doc_id, kind, v FROM labels UNPIVOT (v FOR kind IN (quality, toxic))", "SELECT doc_id, 'quality' AS kind, quality AS v FROM labels UNION ALL SELECT doc_id, 'toxic', toxic FROM labels"),
    # scalar functions
    "scalar_strings": ("SELECT c_custkey, substr(c_name, 2, 4) AS s, upper(c_mktsegment) AS u, trim('  x ') AS t, instr(c_name, '0') AS i, lpad(CAST(c_custkey AS STRING), 6, '0') AS l, replace(c_name, '0', 'o') AS r FROM customer", "SELECT c_custkey, substr(c_name, 2, 4) AS s, upper(c_mktsegment) AS u, trim('  x ') AS t, CAST(instr(c_name, '0') AS INT) AS i, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS l, replace(c_name, '0', 'o') AS r FROM customer"),
    "scalar_decode_nvl": ("SELECT o_orderkey, decode(o_orderstatus, 'F', 1, 'O', 2, 0) AS d, nvl(nullif(o_orderstatus, 'F'), 'none') AS v FROM orders", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END AS d, coalesce(nullif(o_orderstatus, 'F'), 'none') AS v FROM orders"),
    "scalar_dates": ("SELECT o_orderkey, extract(DAY FROM o_orderdate) AS d, day(last_day(o_orderdate)) AS days, date_format(o_orderdate, 'yyyy-MM') AS ym, CAST(date_trunc('MONTH', o_orderdate) AS DATE) AS m, CAST(add_months(o_orderdate, 2) AS DATE) AS later FROM orders", "SELECT o_orderkey, CAST(extract(DAY FROM o_orderdate) AS INT) AS d, CAST(day(last_day(o_orderdate)) AS INT) AS days, strftime(o_orderdate, '%Y-%m') AS ym, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(o_orderdate + INTERVAL 2 MONTH AS DATE) AS later FROM orders"),
    "scalar_json": ("SELECT doc_id, to_json(named_struct('lang', lang, 'n', n_chars)) AS j FROM documents", "SELECT doc_id, concat('{\"lang\":\"', lang, '\",\"n\":', n_chars, '}') AS j FROM documents"),
    "scalar_json_value": ("SELECT event_id, get_json_object(props, '$.k') AS v FROM events", "SELECT event_id, json_extract_string(props, '$.k') AS v FROM events"),
    "scalar_intervals": ("SELECT o_orderkey, CAST(o_orderdate + INTERVAL '3' DAY AS DATE) AS due, o_orderdate + INTERVAL '1' MONTH > TIMESTAMP '1996-01-01 00:00:00' AS late FROM orders", None),
    "scalar_math": ("SELECT p_partkey, mod(p_size, 7) AS m, abs(p_size - 25) AS a, sign(p_size - 25) AS s, CAST(floor(p_retailprice) AS BIGINT) AS f, CAST(ceil(p_retailprice) AS BIGINT) AS c FROM part", "SELECT p_partkey, p_size % 7 AS m, abs(p_size - 25) AS a, CAST(sign(p_size - 25) AS DOUBLE) AS s, CAST(floor(p_retailprice) AS BIGINT) AS f, CAST(ceil(p_retailprice) AS BIGINT) AS c FROM part"),
    # sampling, ordinality, documents
    "sample_clause": ("SELECT o_orderkey FROM orders WHERE CAST(conv(substr(md5(concat('seed|', o_orderkey)), 1, 6), 16, 10) AS BIGINT) % 100 < 10", "SELECT o_orderkey FROM orders WHERE CAST(concat('0x', substr(md5(concat('seed|', o_orderkey)), 1, 6)) AS BIGINT) % 100 < 10"),
    "json_table_ordinality": ("SELECT n_nationkey AS n, pos + 1 AS ord, CAST(v AS BIGINT) AS v FROM nation LATERAL VIEW posexplode(from_json(concat('[', n_nationkey * 2, ',', n_nationkey, ']'), 'array<bigint>')) t AS pos, v", "SELECT n_nationkey AS n, CAST(o AS INT) AS ord, CAST(CASE o WHEN 1 THEN n_nationkey * 2 ELSE n_nationkey END AS BIGINT) AS v FROM nation, (VALUES (1), (2)) x(o)"),
    "json_arrayagg": ("SELECT n_regionkey, to_json(transform(sort_array(collect_list(struct(n_nationkey, n_name))), x -> x.n_name)) AS names FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, '[' || string_agg('\"' || n_name || '\"', ',' ORDER BY n_nationkey) || ']' AS names FROM nation GROUP BY n_regionkey"),
    "json_objectagg": ("SELECT n_regionkey, to_json(map_from_entries(sort_array(collect_list(struct(n_name, n_nationkey))))) AS keys FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, '{' || string_agg('\"' || n_name || '\":' || n_nationkey, ',' ORDER BY n_name) || '}' AS keys FROM nation GROUP BY n_regionkey"),
    "json_transform": ("SELECT doc_id, to_json(map_concat(map_filter(from_json(to_json(named_struct('lang', lang, 'source', source)), 'map<string,string>'), (k, v) -> k <> 'source'), map('kind', 'doc'))) AS j FROM documents", "SELECT doc_id, '{' || CASE WHEN lang IS NULL THEN '' ELSE '\"lang\":\"' || lang || '\",' END || '\"kind\":\"doc\"}' AS j FROM documents"),
    "xml_elements": ("SELECT r_regionkey, concat('<r>', array_join(transform(sort_array(collect_list(n_name)), x -> concat('<n>', x, '</n>')), ''), '</r>') AS x FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey", "SELECT r_regionkey, '<r>' || string_agg('<n>' || n_name || '</n>', '' ORDER BY n_name) || '</r>' AS x FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey"),
    # outer joins of the old writing, hierarchies, rows computed from rows
    "outer_join_sign": ("SELECT r_name, CAST(count(s_suppkey) AS BIGINT) AS n FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 5000 GROUP BY r_name", "SELECT r_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS n FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY s_nationkey) ON s_nationkey = n_nationkey GROUP BY r_name"),
    "set_except_all": ("SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier", None),
    "set_intersect_all": ("SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier", None),
    "multiset_member": ("SELECT n_nationkey, array_contains(array(1, 5, 7), n_nationkey) AS member, size(array(n_nationkey, n_nationkey)) > size(array_distinct(array(n_nationkey, n_nationkey))) AS repeats FROM nation", "SELECT n_nationkey, list_contains([1, 5, 7], n_nationkey) AS member, TRUE AS repeats FROM nation"),
    "collection_methods": ("SELECT k, size(a) AS n_count, a[0] AS n_first, element_at(a, -1) AS n_last, array_append(a, 9) AS extended, slice(a, 1, size(a) - 1) AS trimmed, size(a) >= 3 AS third_exists, filter(a, (x, i) -> i <> 1) AS deleted FROM (SELECT n_nationkey AS k, array(n_nationkey, n_regionkey, 4) AS a FROM nation) q", "SELECT k, CAST(len(a) AS INT) AS n_count, a[1] AS n_first, a[len(a)] AS n_last, list_append(a, 9) AS extended, a[1:len(a) - 1] AS trimmed, len(a) >= 3 AS third_exists, [a[1], a[3]] AS deleted FROM (SELECT n_nationkey AS k, [n_nationkey, n_regionkey, 4] AS a FROM nation) q"),
    "record_types": ("SELECT c_custkey, r.called AS name, r.place.rk AS rk FROM (SELECT c_custkey, named_struct('called', c_name, 'place', named_struct('n', n_name, 'rk', n_regionkey)) AS r FROM customer JOIN nation ON c_nationkey = n_nationkey) q", "SELECT c_custkey, c_name AS name, n_regionkey AS rk FROM customer JOIN nation ON c_nationkey = n_nationkey"),
    "loop_numeric": ("SELECT p_partkey, i FROM part LATERAL VIEW explode(sequence(1, p_size)) t AS i WHERE i * i <= p_size", "SELECT p_partkey, CAST(i AS INT) AS i FROM part, LATERAL (SELECT unnest(range(1, p_size + 1)) AS i) WHERE i * i <= p_size"),
    "loop_while": ("WITH RECURSIVE w(k, v, turns) AS (SELECT n_nationkey, CAST(n_nationkey * 37 AS BIGINT), 0 FROM nation UNION ALL SELECT k, v DIV 2, turns + 1 FROM w WHERE v > 3) SELECT k, max(turns) AS turns FROM w GROUP BY k", "WITH RECURSIVE w(k, v, turns) AS (SELECT n_nationkey, CAST(n_nationkey * 37 AS BIGINT), 0 FROM nation UNION ALL SELECT k, v // 2, turns + 1 FROM w WHERE v > 3) SELECT k, max(turns) AS turns FROM w GROUP BY k"),
    "listagg_overflow": ("SELECT n_regionkey, CASE WHEN length(s) > 24 THEN concat(substr(s, 1, 21), '...') ELSE s END AS names FROM (SELECT n_regionkey, listagg(n_name, ',') WITHIN GROUP (ORDER BY n_name) AS s FROM nation GROUP BY n_regionkey) q", "SELECT n_regionkey, CASE WHEN length(s) > 24 THEN concat(substr(s, 1, 21), '...') ELSE s END AS names FROM (SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS s FROM nation GROUP BY n_regionkey) q"),
    "predicate_is_more": ("SELECT event_id, value IS NOT NULL AS there, isnan(value) AS nan, from_json(props, 'map<string,string>') IS NOT NULL AS json FROM events", "SELECT event_id, value IS NOT NULL AS there, coalesce(isnan(value), FALSE) AS nan, props IS NOT NULL AND json_valid(props) AS json FROM events"),
    "collate_compare": ("SELECT c_custkey FROM customer WHERE c_mktsegment COLLATE UTF8_LCASE = 'building'", "SELECT c_custkey FROM customer WHERE lower(c_mktsegment) = 'building'"),
    "bulk_collect": ("SELECT o_custkey, size(collect_list(o_orderkey)) AS fetched, array_join(slice(sort_array(collect_list(o_orderkey)), 1, 3), ',') AS first_batch FROM orders GROUP BY o_custkey", "SELECT o_custkey, CAST(count(*) AS INT) AS fetched, array_to_string(list_sort(list(o_orderkey))[1:3], ',') AS first_batch FROM orders GROUP BY o_custkey"),
    # DML re-expressed as new relations
    "dml_error_logging": ("SELECT event_id, try_cast(get_json_object(props, '$.k') AS INT) IS NULL AS bad FROM events", "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INT) IS NULL AS bad FROM events"),
    "dq_foreign_key": ("SELECT o_orderkey FROM orders LEFT ANTI JOIN customer ON o_custkey = c_custkey", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
    "dq_cascade_delete": ("SELECT l_orderkey, l_linenumber FROM lineitem LEFT ANTI JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') d ON l_orderkey = o_orderkey", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')"),
    "temporal_validity": ("SELECT a.o_orderkey AS earlier, b.o_orderkey AS later FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate > a.o_orderdate AND b.o_orderdate < a.o_orderdate + INTERVAL '10' DAY", None),
}


def queries():
    return {name: over_tables(spark) for name, (spark, _) in QUERIES.items()}


def oracle_sql():
    return {name: other or spark for name, (spark, other) in QUERIES.items()}
