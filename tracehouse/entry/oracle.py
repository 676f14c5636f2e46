"""The same queries in DuckDB's SQL, keyed as in ``queries``."""

from __future__ import annotations

from tracehouse.entry.queries import END_CUTOFF, SERVED_ROWS, SERVED_RUNS, TRIM_ROWS

# events as traces, in minutes of the month
_TRACE = """
trace AS (
    SELECT user_id AS runid, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 6e7 AS mins, value
    FROM events
)"""
_REZEROED = f"""{_TRACE},
rezeroed AS (
    SELECT runid, mins - min(mins) OVER (PARTITION BY runid) AS mins, value FROM trace
)"""
_POINTS = """
points AS (
    SELECT runid, mins, value,
           lag(value) OVER (PARTITION BY runid ORDER BY mins) AS prev_value,
           lag(mins) OVER (PARTITION BY runid ORDER BY mins) AS prev_mins,
           dense_rank() OVER (PARTITION BY runid ORDER BY mins) AS idx
    FROM {source}
)"""
_GRADIENTS = f"""{_REZEROED}, {_POINTS.format(source="rezeroed")},
gradients AS (
    SELECT runid, (value - prev_value) / mins AS gradient FROM points WHERE idx = 2
)"""
_NUMBERED = f"""{_TRACE},
numbered AS (
    SELECT *, row_number() OVER w - 1 AS idx, mins - lag(mins) OVER w AS step
    FROM trace WINDOW w AS (PARTITION BY runid ORDER BY mins)
)"""
_STATS = f"""{_NUMBERED},
stats AS (
    SELECT runid, min(mins) AS mins_min, max(mins) AS mins_max, count(mins) AS mins_count,
           min(value) AS abs_min, max(value) AS abs_max,
           arg_min(idx, (value, idx)) AS abs_argmin, arg_max(idx, (value, -idx)) AS abs_argmax,
           round(avg(1 / (60 * step)), 4) AS hertz
    FROM numbered GROUP BY runid
)"""
_STAT_COLUMNS = """runid, mins_min, mins_max, mins_count,
       abs_min, abs_max, abs_argmin, abs_argmax, hertz"""
_EVEN = f"""{_NUMBERED},
steps AS (
    SELECT runid, round_even((max(mins) - min(mins)) / (count(*) - 1), 9) AS step FROM trace GROUP BY runid
),
even AS (
    SELECT n.runid, n.idx * s.step AS mins, n.value, n.idx FROM numbered n JOIN steps s USING (runid)
)"""
_DIMENSION = "SELECT c_custkey AS runid, c_name, c_mktsegment, c_nationkey FROM customer"
_CELLS = f"""{_EVEN},
cells AS (
    SELECT runid, idx, mins, wavelength, value * factor AS absorbance
    FROM even CROSS JOIN (VALUES (256, 1), (300, 2)) w (wavelength, factor) WHERE idx < {TRIM_ROWS}
),
dimension AS ({_DIMENSION})"""
_EXCLUDED = f"""{_GRADIENTS},
excluded AS (
    SELECT runid, arg_min(reason, place) AS reason FROM (
        SELECT c_custkey AS runid, 'negative balance' AS reason, 0 AS place FROM customer
        WHERE c_acctbal < 0 AND c_custkey IN (SELECT user_id FROM events)
        UNION ALL
        SELECT runid, 'falling', 1 FROM gradients WHERE gradient < 0
    ) GROUP BY runid
)"""
_LANDED = """
landed AS (
    SELECT lpad(user_id::varchar, 4, '0') AS notebook, date_trunc('second', ts) AS acq_date, *
    FROM events
),
ranked AS (
    SELECT *, dense_rank() OVER (PARTITION BY notebook ORDER BY acq_date) AS rank FROM landed
),
keyed AS (
    SELECT *, CASE WHEN rank > 1 THEN concat(notebook, '_', rank) ELSE notebook END AS ch_runid FROM ranked
),
staged AS (
    SELECT ch_runid,
           CASE WHEN len(ch_runid) = 4 AND ch_runid[1] = '0' AND ch_runid[-1] IN ('1', '2')
                THEN ch_runid[2:3] WHEN ch_runid = '116' THEN 'sigurdcb' ELSE ch_runid END AS samplecode,
           acq_date, event_type AS acq_method, 5.0::double AS inj_vol,
           replace(strftime(ts, 'wines_%Y-%m-%d_%H-00-00'),
                   'wines_2023-03-15_11-33-51', '2023-03-15_11:33:51') AS seq_name,
           event_type AS seq_desc, 'Vial 1' AS vialnum, 'c:\\chem' AS originalfilepath,
           event_id::varchar AS id, NULL::varchar AS description, concat('/lib/', event_id) AS path
    FROM keyed
)"""
_REGISTER = """
register AS (
    SELECT CASE WHEN p_size > 10 THEN 'raw' ELSE 'cuprac' END AS detection, lower(p_type) AS sampler,
           concat('p', p_partkey) AS samplecode, p_size AS vintage, p_name AS wine,
           '1/2/2023' AS open_date, NULL::varchar AS sampled_date, p_retailprice > 1000 AS added_to_cellartracker,
           lower(p_brand) AS notes, p_retailprice::varchar AS size
    FROM part
),
known AS (SELECT DISTINCT p_name AS wine, p_size AS vintage FROM part WHERE p_type != 'PROMO')"""
_UNESCAPE = "html"
for _pattern, _char in (("&copy;?", "©"), ("&middot;?", "·"), ("&quot;?", '"'), ("&amp;?", "&")):
    _UNESCAPE = f"regexp_replace({_UNESCAPE}, '{_pattern}', '{_char}', 'g')"
_CATALOGUE_TEXTS = ", ".join(
    f"concat('{c}', ' ', s_suppkey) AS {c}"
    for c in "locale country region subregion appellation producer type color category varietal".split()
)

ORACLE: dict[str, str] = {
    "run_metadata": """
SELECT o_orderkey::varchar AS id, o_orderkey AS runid, o_orderdate AS acq_date, o_orderpriority AS acq_method,
       o_orderstatus AS seq_name, o_totalprice AS description, c_mktsegment AS detection,
       n_nationkey AS vintage, n_name AS wine, n_name AS locale, n_name AS country, r_name AS region,
       n_name AS subregion, n_name AS appellation, n_name AS producer, n_name AS type, n_name AS color,
       n_name AS category, n_name AS varietal
FROM orders
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey)
       ON n_name = concat('NATION_', c_nationkey) AND n_nationkey = c_nationkey
ANTI JOIN (SELECT o_orderkey AS runid FROM orders WHERE o_orderstatus = 'P') excluded ON o_orderkey = excluded.runid""",
    "clean_catalogue": f"""
SELECT concat(s_nationkey, ' ', wine) AS wine_key, '750ml' AS size, s_nationkey AS vintage, wine, {_CATALOGUE_TEXTS}
FROM (SELECT *, concat(lower(s_name), ' & ete') AS wine FROM supplier)""",
    "load_register": f"""
WITH {_REGISTER}
SELECT detection, wine, vintage, sampler, samplecode, open_date, sampled_date, added_to_cellartracker, notes,
       round(size::float::double, 2) AS size
FROM register SEMI JOIN known ON register.wine = known.wine AND register.vintage = known.vintage
WHERE detection = 'raw'""",
    "register_not_in_catalogue": f"""
WITH {_REGISTER}
SELECT register.* FROM register ANTI JOIN known ON register.wine = known.wine AND register.vintage = known.vintage""",
    "stage_runs": f"WITH {_LANDED} SELECT * FROM staged",
    "registered_runs": f"""
WITH {_LANDED}
SELECT ch_runid AS runid, samplecode, acq_date, acq_method, inj_vol, seq_name, vialnum, originalfilepath, id,
       description, path
FROM staged SEMI JOIN (SELECT c_custkey::varchar AS code FROM customer WHERE c_acctbal > 0) st ON samplecode = code""",
    "sequences": """
SELECT DISTINCT seq_name, CASE WHEN seq_name = 'singlesample' THEN NULL
       ELSE cast(concat(seq_name[-19:-10], ' ', replace(seq_name[-8:-1], '-', ':')) AS timestamp) END AS dt_run, seq_desc
FROM (SELECT CASE WHEN event_type = 'error' THEN 'singlesample'
                  ELSE strftime(ts, 'run_%Y-%m-%d_%H-00-00') END AS seq_name, event_type AS seq_desc FROM events)""",
    "attach_runid": """
SELECT c_name AS runid, user_id AS id, event_id, value
FROM events LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON user_id = c_custkey""",
    "normalise_text": """
SELECT doc_id, strip_accents(trim(lower(replace(replace(text, '''', ''), '"', '')))) AS quotes_first,
       replace(replace(strip_accents(trim(lower(text))), '"', ''), '''', '') AS trim_first
FROM documents""",
    "html_unescape": f"SELECT page_id, {_UNESCAPE} AS html FROM pages",
    "key_concat": """
SELECT c_custkey, concat(c_name, ' ', nullif(c_mktsegment, 'BUILDING')) AS joined,
       coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS segment
FROM customer""",
    "string_slices": """
SELECT c_custkey, c_name[1] AS first_char, c_name[-1] AS last_char, c_name[2:3] AS two_three, c_name[11] AS eleventh,
       c_name[-8:-1] AS last_eight, c_name[-19:-10] AS date_part, c_name[6:] AS from_six, c_name[0:4] AS year,
       len(c_name)::int AS len
FROM customer""",
    "path_pieces": r"""
SELECT page_id, regexp_replace(url, '/[^/]+$', '') AS parent,
       regexp_replace(regexp_extract(url, '([^/]+)$', 1), '\.[^./]*$', '') AS stem, url || '/data.parquet' AS data_path
FROM pages""",
    "flags_and_vintages": """
SELECT p_partkey, coalesce(CASE WHEN p_size > 25 THEN 'y' WHEN p_size > 10 THEN 'n' END = 'y', false) AS flag,
       CASE WHEN p_size > 40 OR p_size <= 5 THEN 9999 ELSE p_size END AS vintage
FROM part""",
    "remap_keys": """
SELECT o_orderkey,
       CASE WHEN len(k) = 4 AND k[1] = '0' AND (k[-1] = '1' OR k[-1] = '2') THEN k[2:3]
            WHEN k = '116' THEN 'sigurdcb' ELSE k END AS code
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN lpad(o_custkey::varchar, 4, '0')
                              ELSE o_custkey::varchar END AS k FROM orders)""",
    "parse_timestamps": """
SELECT event_id, strptime(strftime(ts, '%-d-%b-%y, %H:%M:%S'), '%d-%b-%y, %H:%M:%S') AS acq_date,
       CASE WHEN event_type != 'error' THEN strptime(strftime(ts, '%Y-%m-%d_%H-%M-%S'), '%Y-%m-%d_%H-%M-%S') END AS dt_run,
       replace(strftime(ts, 'wines_%Y-%m-%d_%H-%M-%S'), 'wines_2023-03-15_11-33-51', '2023-03-15_11:33:51') AS seq_name
FROM events""",
    "dedupe_keys": """
SELECT o_orderkey, CASE WHEN rank > 1 THEN concat(o_custkey, '_', rank) ELSE o_custkey::varchar END AS notebook, o_orderdate
FROM (SELECT *, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS rank FROM orders)""",
    "surrogate_key": """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS pk, o_orderdate, o_orderkey FROM orders""",
    "dup_key_check": """
SELECT o_custkey, o_orderdate, count(*) AS count FROM orders GROUP BY ALL HAVING count(*) > 1""",
    "constraint_violations": """
SELECT 'primary key' AS "check", 'l_orderkey,l_linenumber' AS columns,
       concat('{"l_orderkey":"', l_orderkey, '","l_linenumber":"', l_linenumber, '"}') AS key, count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'not null', 'l_tax', NULL, count(*) FROM lineitem WHERE l_tax = 0 HAVING count(*) > 0
UNION ALL SELECT 'foreign key to orders', 'l_orderkey', concat('{"l_orderkey":"', l_orderkey, '"}'), 1
FROM (SELECT DISTINCT l_orderkey FROM lineitem)
ANTI JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus != 'P') ON l_orderkey = o_orderkey
UNION ALL SELECT 'foreign key to part', 'l_partkey', concat('{"l_partkey":"', l_partkey, '"}'), 1
FROM (SELECT DISTINCT l_partkey FROM lineitem) ANTI JOIN part ON l_partkey = p_partkey""",
    "coverage_both_ways": """
SELECT 'left' AS side, count(*) AS rows FROM orders
ANTI JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey
UNION ALL
SELECT 'right', count(*) FROM customer ANTI JOIN orders ON o_custkey = c_custkey WHERE c_acctbal > 0""",
    "null_counts": """
SELECT count(*) FILTER (l_discount = 0) AS l_discount, count(*) FILTER (l_tax = 0) AS l_tax,
       count(*) FILTER (l_quantity = 0) AS l_quantity
FROM lineitem""",
    "row_count_range": """
SELECT min(n) AS n_min, max(n) AS n_max FROM (SELECT count(*) AS n FROM events GROUP BY user_id)""",
    "insert_or_ignore": """
SELECT DISTINCT o_custkey AS c_custkey FROM orders
ANTI JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey""",
    "distinct_params": """
SELECT DISTINCT l_orderkey AS runid, l_returnflag AS flow, l_linestatus AS pressure FROM lineitem""",
    "unpivot_channels": """
UNPIVOT (SELECT l_orderkey AS runid, l_linenumber::double AS mins, l_discount AS a, l_tax AS b FROM lineitem)
ON a, b INTO NAME channel VALUE percent""",
    "pivot_solvents": """
SELECT o_orderkey AS runid, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS a,
       CASE WHEN o_orderstatus != 'F' THEN o_orderpriority END AS b
FROM orders""",
    "pivot_first": """
SELECT l_orderkey, max(l_quantity) FILTER (l_linestatus = 'F') AS F, max(l_quantity) FILTER (l_linestatus = 'O') AS O
FROM lineitem GROUP BY l_orderkey""",
    "union_zero_point": """
SELECT l_orderkey AS runid, l_linenumber::double AS mins, 'a' AS channel, l_discount AS percent FROM lineitem
UNION SELECT l_orderkey, l_linenumber, 'b', l_tax FROM lineitem
UNION SELECT o_orderkey, 0, CASE WHEN o_orderstatus = 'F' THEN 'a' ELSE 'b' END, o_totalprice FROM orders""",
    "elution_table": f"""
WITH {_TRACE},
wide AS (
    SELECT runid AS num, mins AS "time", value AS a, -value AS b FROM trace
    UNION SELECT c_custkey, 0, c_acctbal, NULL FROM customer
)
SELECT num, "time", a, b,
       dense_rank() OVER (PARTITION BY num ORDER BY "time") AS entry
FROM wide""",
    "gradient": f"WITH {_GRADIENTS} SELECT runid, gradient FROM gradients",
    "gradient_slope": f"""
WITH {_TRACE}, {_POINTS.format(source="trace")}
SELECT runid, (value - prev_value) / (mins - prev_mins) AS gradient FROM points WHERE idx = 2""",
    "counts_per_gradient": f"""
WITH {_GRADIENTS} SELECT round(gradient, 1) AS gradient, count(*) AS count FROM gradients GROUP BY 1""",
    "signal_stats": f"WITH {_STATS} SELECT {_STAT_COLUMNS} FROM stats",
    "image_stats": f"""
WITH {_STATS.replace("avg(1 / (60 * step)), 4", "avg(1 / (60 * step)), 2")}
SELECT {_STAT_COLUMNS}, 256 AS nm_min, 300 AS nm_max, 4 AS nm_count, 2 AS n_wavelengths FROM stats""",
    "matrix_columns_stats": """
SELECT dim, round(min(value), 6) AS value_min, round(max(value), 6) AS value_max, round(sum(value), 6) AS value_sum,
       count(*) AS value_count
FROM (SELECT unnest(range(64))::int AS dim, unnest(embedding)::double AS value FROM embeddings) GROUP BY dim""",
    "column_sums": "SELECT label, "
    + ", ".join(f'round(sum(embedding[{i + 1}]::double), 6) AS "{200 + i}"' for i in range(64))
    + " FROM embeddings GROUP BY label",
    "wide_to_long": """
SELECT vec_id, label, unnest(range(200, 264))::int AS wavelength, unnest(embedding)::double AS absorbance
FROM embeddings""",
    "rezero_time": f"WITH {_REZEROED} SELECT runid, mins, value FROM rezeroed",
    "regrid_time": f"WITH {_EVEN} SELECT runid, mins, value, idx FROM even",
    "trim_runs": f"WITH {_NUMBERED} SELECT runid, mins, value, idx FROM numbered WHERE idx < {TRIM_ROWS}",
    "cube_long": f"""
WITH {_CELLS}
SELECT runid, idx, mins, wavelength, absorbance, c_name, c_mktsegment,
       c_nationkey
FROM cells JOIN dimension USING (runid)""",
    "cube_array": f"""
WITH {_EVEN}, dimension AS ({_DIMENSION})
SELECT runid, idx, mins, value AS nm_256, value * 2 AS nm_300, c_name,
       c_mktsegment, c_nationkey
FROM even JOIN dimension USING (runid) WHERE idx < {TRIM_ROWS}""",
    "cube_slice": f"""
WITH {_CELLS}
SELECT runid, idx, mins, wavelength, absorbance, c_name, c_mktsegment,
       c_nationkey
FROM cells JOIN dimension USING (runid)
WHERE wavelength = 256 AND c_mktsegment = 'BUILDING' AND mins BETWEEN 100 AND 20000""",
    "time_outliers": f"""
WITH {_STATS}, dimension AS ({_DIMENSION})
SELECT {_STAT_COLUMNS}, c_name, c_mktsegment, c_nationkey
FROM stats JOIN dimension USING (runid) WHERE mins_max < {END_CUTOFF}""",
    "excluded_runs": f"WITH {_EXCLUDED} SELECT runid, reason FROM excluded",
    "exclude_runs": f"""
WITH {_EXCLUDED}
SELECT event_id, user_id AS runid, value FROM events ANTI JOIN excluded ON user_id = excluded.runid""",
    "run_data_paths": """
SELECT o_orderkey AS runid, concat('/lib/', o_orderkey) AS path, concat('/lib/', o_orderkey, '/data.parquet') AS data_path,
       concat('/lib/', o_orderkey, '/metadata.parquet') AS meta_path
FROM orders WHERE o_orderstatus != 'P'""",
    "fetch_runs": """
SELECT user_id, event_id, value, 'events.parquet' AS file FROM events
WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "filter_builder": """
SELECT p_partkey AS id, p_name, p_brand, p_type, p_size, p_retailprice, l_orderkey, l_quantity
FROM part LEFT JOIN lineitem ON p_partkey = l_partkey
WHERE p_type = 'PROMO' AND p_brand IN ('Brand#1', 'Brand#7', 'Brand#12') AND l_quantity BETWEEN 10 AND 20""",
    "filter_inferred": "SELECT * FROM part WHERE p_type IN ('PROMO', 'LARGE') AND p_size = 10",
    "like_filter": "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'",
    "score_histogram": """
SELECT floor(l_quantity / 5) * 5 AS bin, count(*) AS count FROM lineitem GROUP BY 1""",
    "score_percent": """
SELECT l_quantity, count(l_quantity) * 100 / (SELECT count(*) FROM lineitem) AS count_perc
FROM lineitem WHERE l_quantity > 20 GROUP BY l_quantity""",
    "top_rows": "SELECT * FROM lineitem ORDER BY ALL DESC LIMIT 5",
    "bool_and_check": "SELECT bool_and(l_quantity > 0) AS all_positive FROM lineitem",
    "count_report": """
SELECT 'total' AS metric, count(*)::double AS value FROM lineitem
UNION ALL SELECT 'untaxed', count(*) FROM lineitem WHERE l_tax = 0
UNION ALL SELECT 'taxed', count(*) FROM lineitem WHERE l_tax != 0""",
    "distinct_values_stacked": """
SELECT DISTINCT 'l_returnflag' AS col, l_returnflag AS unique_vals FROM lineitem
UNION ALL SELECT DISTINCT 'l_linestatus', l_linestatus FROM lineitem
UNION ALL SELECT DISTINCT 'l_linenumber', l_linenumber::varchar FROM lineitem""",
    "distinct_counts": """
SELECT count(DISTINCT l_returnflag) AS l_returnflag, count(DISTINCT l_linestatus) AS l_linestatus,
       count(DISTINCT l_suppkey) AS l_suppkey, count(DISTINCT l_partkey) AS l_partkey
FROM lineitem""",
    "update_from": """
SELECT c_custkey, coalesce(s_name, c_name) AS c_name, c_mktsegment
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""",
    "conditional_update": """
SELECT p_partkey, p_size, CASE WHEN p_size IN (1, 2, 3) THEN 'TINY' ELSE p_type END AS p_type,
       CASE WHEN p_size > 25 THEN true END AS verified
FROM part""",
    "xml_solvent_composition": """
SELECT l_orderkey::varchar AS id, c.idx AS idx, c.channel AS channel, l_returnflag AS ch1_solv, NULL::varchar AS name_1,
       l_linestatus AS ch2_solv, NULL::varchar AS name_2, 'Ch. 1' AS selected, 'Yes' AS used,
       round(CASE c.idx WHEN 0 THEN l_discount ELSE l_tax END, 4) AS percent
FROM lineitem CROSS JOIN (VALUES (0, 'A'), (1, 'B')) c (idx, channel)""",
    "xml_timetable": """
SELECT l_orderkey::varchar AS id, 0 AS idx, l_linenumber::double AS mins, 0.0::double AS a, 100.0::double AS b,
       l_quantity AS flow, 700.0::double AS pressure
FROM lineitem""",
    "xml_run_id": """
SELECT concat('/lib/', o_orderkey, '.D') AS run_dir,
       concat(CASE WHEN o_orderstatus = 'F' THEN 'seq-' ELSE 'smp-' END, o_orderkey) AS id
FROM orders""",
}


def _matches(left: str, right: str, least: int, columns: str) -> str:
    """Best right text of each left one. ``left``: rows with ``left_string``; ``right``: (name, place).

    The score's aligned part is found as its definition says: the longest common block (the first one in
    the first text, then in the second), and the same again on both sides of it.
    """
    block = """list_max(list_transform(range(1, length({a}) + 1), lambda i: {{
        'k': list_max(list_filter(range(0, length({a}) - i + 2), lambda n: n = 0 OR contains({b}, substring({a}, i, n)))),
        'back': -i}}))"""
    canon = r"array_to_string(list_sort(list_distinct(list_filter(string_split(regexp_replace(lower({}), '\W+', ' ', 'g'), ' '), lambda t: t <> ''))), ' ')"
    share = "round_even(200.0 * {m} / ({a} + {b}), 0)::INTEGER"
    return f"""
WITH RECURSIVE
l AS ({left}),
lt AS (SELECT DISTINCT {canon.format("left_string")} AS lc FROM l),
rt AS (SELECT {canon.format("name")} AS rc, min({{'place': place, 'name': name}}) AS first_ FROM ({right}) GROUP BY 1),
split_ AS (
  SELECT lc, rc, first_, list_sort(list_intersect(string_split(lc, ' '), string_split(rc, ' '))) AS both_,
    list_sort(list_filter(string_split(lc, ' '), lambda t: NOT list_contains(string_split(rc, ' '), t))) AS lo,
    list_sort(list_filter(string_split(rc, ' '), lambda t: NOT list_contains(string_split(lc, ' '), t))) AS ro
  FROM lt, rt
),
pair AS (
  SELECT lc, first_, array_to_string(both_, ' ') AS s, array_to_string(both_ || lo, ' ') AS one,
    array_to_string(both_ || ro, ' ') AS two FROM split_
),
texts AS (SELECT DISTINCT one, two FROM pair),
part_ AS (
  SELECT one, two, one AS a, two AS b, {block.format(a="one", b="two")} AS m FROM texts
  UNION ALL
  SELECT one, two, x.a, x.b, {block.format(a="x.a", b="x.b")} FROM (
    SELECT one, two, unnest([
      {{'a': substring(a, 1, -m.back - 1), 'b': substring(b, 1, instr(b, substring(a, -m.back, m.k)) - 1)}},
      {{'a': substring(a, -m.back + m.k), 'b': substring(b, instr(b, substring(a, -m.back, m.k)) + m.k)}}]) AS x
    FROM part_ WHERE m.k > 0
  ) WHERE x.a <> '' AND x.b <> ''
),
aligned AS (SELECT one, two, sum(m.k) AS k FROM part_ GROUP BY ALL),
scored AS (
  SELECT lc, first_, greatest(
    CASE WHEN s = '' THEN 0 ELSE {share.format(m="length(s)", a="length(s)", b="length(one)")} END,
    CASE WHEN s = '' THEN 0 ELSE {share.format(m="length(s)", a="length(s)", b="length(two)")} END,
    {share.format(m="k", a="length(one)", b="length(two)")}) AS score
  FROM pair JOIN aligned USING (one, two)
),
best AS (SELECT lc, min({{'rank': -score, 'first': first_}}) AS m FROM scored WHERE score >= {least} GROUP BY lc)
SELECT {columns}, m.first.name AS match, -m.rank AS score
FROM l LEFT JOIN best ON lc = {canon.format("left_string")}"""


ORACLE["match_names"] = _matches(
    """SELECT p_partkey, lower(p_type) || ' ' || translate(split_part(p_name, ' ', 2), 'l', 'r') || ' '
      || translate(split_part(p_name, ' ', 1), 'o', '0') AS left_string FROM part""",
    "SELECT p_name AS name, p_name AS place FROM part",
    60,
    "p_partkey, left_string",
)

ORACLE["match_suppliers"] = _matches(
    "SELECT s_suppkey, 'suplier ' || substring(s_name, 10, 20) AS left_string FROM supplier",
    "SELECT s_name AS name, s_suppkey AS place FROM supplier",
    76,
    "s_suppkey, left_string",
)

ORACLE["table_read_back"] = """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier"""

ORACLE["runs_read_back"] = """
SELECT substring(o_orderpriority, 1, 1) AS runid, o_orderkey AS mins,
       CASE WHEN o_orderpriority LIKE '1%' THEN -o_totalprice ELSE o_totalprice END AS value
FROM orders"""

ORACLE["cube_read_back"] = f"""{ORACLE["cube_long"]}
WHERE runid IN (3, 7, 50, 1000000000)"""

ORACLE["reconciled_suppliers"] = """
SELECT lpad(s_suppkey::varchar, 9, '0') AS samplecode, 'supplier ' || substring(s_name, 10) AS wine,
       (1990 + s_nationkey)::integer AS vintage, (1990 + s_nationkey) || ' supplier ' || substring(s_name, 10) AS wine_key
FROM supplier"""

ORACLE["cube_table_slice"] = f"""SELECT * FROM ({ORACLE["cube_long"]})
WHERE runid IN (3, 7, 50, 1000000000) AND wavelength = 256"""

ORACLE["distinct_estimates"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS exact, true AS close FROM lineitem"
    for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity")
)

ORACLE["register_csv_export"] = """
SELECT CASE WHEN p_size > 10 THEN 'raw' ELSE 'cuprac' END AS detection, lower(p_type) AS sampler,
  'p' || lpad(p_partkey::varchar, 9, '0') AS samplecode, CASE WHEN p_size > 40 THEN 9999 ELSE p_size END AS vintage,
  lower(p_name) || ', ' || lower(p_brand) AS wine, '1/2/2023' AS open_date, '3/4/2023' AS sampled_date,
  p_retailprice > 1000 AS added_to_cellartracker, lower(p_brand) || chr(10) || 'second line' AS notes, p_size::double AS size
FROM part"""

ORACLE["landed_schemas"] = """
SELECT DISTINCT o_orderpriority[1] AS runid,
  CASE WHEN o_orderpriority LIKE '2%' THEN 'mins,value,unit' ELSE 'mins,value' END AS columns,
  CASE WHEN o_orderpriority LIKE '2%' THEN 'int64,double,string' ELSE 'int64,double' END AS types
FROM orders"""

_SERVED = """
sample_metadata AS (
    SELECT 'guid-' || c_custkey AS id, c_custkey::varchar AS runid, TIMESTAMP '2024-01-01' AS acq_date,
           c_mktsegment AS acq_method, 'month' AS seq_name, c_name AS description, 'raw' AS detection,
           1990 + n_nationkey AS vintage, n_name AS wine, n_name AS locale, n_name AS country, r_name AS region,
           n_name AS subregion, n_name AS appellation, n_name AS producer, n_name AS type, n_name AS color,
           n_name AS category, n_name AS varietal
    FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey)
      ON n_nationkey = c_nationkey AND n_name = 'NATION_' || c_nationkey
    WHERE c_mktsegment != 'MACHINERY'
)"""

ORACLE["get_data_cube"] = f"""
WITH {_EVEN}, {_SERVED}
SELECT m.* EXCLUDE (runid), m.runid, idx, mins, 256 AS wavelength, value AS absorbance
FROM even e JOIN sample_metadata m ON e.runid::varchar = m.runid WHERE idx < {SERVED_ROWS}"""

ORACLE["get_data_pairs"] = f"""
WITH {_EVEN}, {_SERVED}
SELECT m.*, mins, value AS "256", value * 2 AS "300"
FROM even e JOIN sample_metadata m ON e.runid::varchar = m.runid
WHERE m.runid IN ({", ".join(f"'{r}'" for r in SERVED_RUNS)})"""

ORACLE["filter_tables"] = f"""
WITH {_TRACE}, {_SERVED}
SELECT m.*, mins, 256 AS wavelength, value AS absorbance
FROM sample_metadata m JOIN trace t ON m.runid = t.runid::varchar
WHERE mins BETWEEN 100 AND 20000 AND region IN ('ASIA', 'EUROPE')"""
