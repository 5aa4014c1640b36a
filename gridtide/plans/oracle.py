"""Plain SQL (DuckDB dialect) with the same results as the registered queries.

Each statement is written directly against the given tables; none of it goes through
sheets, pages or documents, so it is an independent check of the operators.
"""

from __future__ import annotations

BASE = "https://stats.example.org"

# The observations behind supplier_month_cells: a month x supplier grid per return flag.
GRID = """
WITH facts AS (
  SELECT l_returnflag AS flag, l_suppkey AS supp,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS m, sum(l_quantity) AS v
  FROM lineitem GROUP BY 1, 2, 3),
grid AS (
  SELECT flag, ascii(flag) - 64 AS no, supp, m FROM
    (SELECT DISTINCT flag, m FROM facts) JOIN (SELECT DISTINCT flag, supp FROM facts) USING (flag)),
down AS (
  SELECT grid.*, facts.v FROM grid LEFT JOIN facts USING (flag, supp, m))
"""

ACROSS = """
WITH counts AS (
  SELECT o_orderstatus AS status, o_orderpriority AS priority,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS n
  FROM orders GROUP BY 1, 2, 3),
across AS (
  SELECT status, ascii(status) - 64 AS no, priority, m, CAST(n AS DOUBLE) AS v FROM
    (SELECT DISTINCT status, m FROM counts)
    JOIN (SELECT DISTINCT status, priority FROM counts) USING (status)
    LEFT JOIN counts USING (status, priority, m))
"""

MATRIX = """
WITH base AS (
  SELECT l_returnflag AS flag, l_linestatus AS status, s_nationkey AS nation,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS m, sum(l_quantity) AS v
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3, 4),
matrix AS (
  SELECT 'Flows ' || CAST(ascii(flag) - 64 AS VARCHAR) AS sheet, m AS date, status,
         'N' || CAST(nation AS VARCHAR) AS nation, v
  FROM (SELECT DISTINCT flag, m FROM base)
  JOIN (SELECT DISTINCT flag, status, nation FROM base) USING (flag)
  LEFT JOIN base USING (flag, status, nation, m))
"""

OBS = """
WITH obs AS (
  SELECT CASE l_returnflag WHEN 'A' THEN '6401.0' WHEN 'N' THEN '6302.0' ELSE '6202.0' END AS cat_no,
         'Table ' || l_linestatus AS sheet,
         'S' || lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS series_id, l_suppkey,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS date, sum(l_quantity) AS value,
         l_returnflag, l_linestatus
  FROM lineitem GROUP BY ALL)
"""

INDEX = f"""
WITH numbered AS (
  SELECT *, '62' || lpad(regexp_extract(p_brand, '([0-9]+)$', 1), 2, '0') || '.0' AS cat_no,
         lower(strftime(DATE '2020-01-01' + to_months(p_size), '%b-%Y')) AS release_date,
         CAST(p_partkey % 9 + 1 AS VARCHAR) AS table_no
  FROM part),
idx AS (
  SELECT p_partkey, p_size, cat_no, p_brand || ' statistics' AS title,
         p_type || ' parts' AS description, '{BASE}/' || cat_no AS page_url, release_date,
         'Table ' || table_no || '. ' || p_name AS file_title,
         cat_no || '_' || p_partkey || '.xlsx' AS filename, table_no,
         '{BASE}/' || cat_no || '/' || release_date || '/' || cat_no || '_' || p_partkey
           || '.xlsx' AS url,
         p_type = 'PROMO' AS is_cube
  FROM numbered)
"""

REQUEST_CAT = "'62' || lpad(CAST(o_custkey % 30 + 1 AS VARCHAR), 2, '0') || '.0'"
REQUEST_MONTH = "CAST(DATE '2020-01-01' + to_months(CAST(o_orderkey % 60 AS INTEGER)) AS DATE)"

LABELS = """
WITH labels AS (
  SELECT p_partkey, CASE WHEN p_size <> 13 THEN list_filter(
    [p_type, CASE WHEN p_size % 2 = 0 THEN 'All  Groups' ELSE 'Total' END, p_name,
     CASE WHEN p_size > 25 THEN p_brand END], lambda x: x IS NOT NULL) END AS parts,
    CASE WHEN p_size <> 13 THEN p_type || sep
      || CASE WHEN p_size % 2 = 0 THEN 'All  Groups' ELSE 'Total' END || sep || p_name || sep
      || CASE WHEN p_size > 25 THEN p_brand || sep ELSE '' END END AS series
  FROM (SELECT *, [' ; ', '|', ', '][p_size % 3 + 1] AS sep FROM part)),
kept AS (
  SELECT p_partkey, series, parts,
         list_filter(parts, lambda x: x NOT IN ('All  Groups', 'Total')) AS rest FROM labels)
"""

LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _html_text(expression: str) -> str:
    """The same cleaning as for links: tags, common entities, blanks."""
    text = f"regexp_replace({expression}, '<[^>]*>', '', 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return f"trim(regexp_replace(replace({text}, chr(160), ' '), '\\s+', ' ', 'g'))"


LINKS = f"""
WITH found AS (
  SELECT page_id, regexp_extract_all(html, {_quoted(LINK)}, 1) AS hrefs,
         regexp_extract_all(html, {_quoted(LINK)}, 2) AS labels FROM pages),
raw AS (
  SELECT page_id, unnest(range(1, len(hrefs) + 1)) AS ord, unnest(hrefs) AS href,
         unnest(labels) AS html_label FROM found),
links AS (
  SELECT page_id, CAST(ord AS INTEGER) AS ord, href, {_html_text("html_label")} AS label FROM raw)
"""

GENERIC = (
    "(label = '' OR trim(regexp_replace(regexp_replace(lower(label), '\\[[^\\]]+\\]', '', 'g'), "
    "'\\s+', ' ', 'g')) IN ('download', 'download xlsx', 'download xls', 'download csv', "
    "'xlsx', 'xls', 'csv'))"
)

TABLE_NO = r"(?i)\btables?\s*([0-9]+[a-z]?)\b"

# Workbooks of plans/books.py: orders by book and sheet, and which sheets can be read.
BOOKS = """
WITH lines AS (
  SELECT o.*, o_orderkey // 500 AS book, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS sheet_no,
         row_number() OVER (PARTITION BY o_orderkey // 500, o_orderstatus ORDER BY o_orderkey) AS line
  FROM orders o),
all_sheets AS (
  SELECT book, CAST(s.sheet_no AS INTEGER) AS sheet_no, 'Status ' || s.status AS sheet,
         '/lake/orders-' || book || '.xlsx' AS source_file, book % 11 = 5 AS no_file,
         (s.status = 'O' AND book % 5 = 4) OR (s.status = 'F' AND book % 7 = 2) AS broken,
         (SELECT count(*) FROM lines l WHERE l.book = b.book AND l.sheet_no = s.sheet_no) AS n
  FROM (SELECT DISTINCT book FROM lines) b, (VALUES (1, 'F'), (2, 'O'), (3, 'P')) s(sheet_no, status)),
sheets AS (SELECT *, CASE WHEN n > 0 THEN 4 * (n + 1) ELSE 0 END AS n_cells FROM all_sheets WHERE NOT no_file)"""

ORACLE: dict[str, str] = {
    "tidy_time_down": GRID + """
SELECT 'lineitem' AS source_file, 'Table ' || no AS sheet, no AS sheet_no, m AS date,
       'S' || lpad(CAST(supp AS VARCHAR), 7, '0') AS series_id, v AS value, 'Items' AS unit,
       'monthly' AS frequency, 'Quantity ; Supplier ' || supp AS series,
       CAST(no AS VARCHAR) AS table_no
FROM down""",
    "tidy_time_across": ACROSS + """
SELECT 'orders' AS source_file, 'Orders ' || no AS sheet, no AS sheet_no, m AS date,
       'PRIO000' || left(priority, 1) AS series_id, v AS value, 'Orders' AS unit,
       'monthly' AS frequency, priority AS series, 'mar-2024' AS release_date,
       CAST(no AS VARCHAR) AS table_no, 'Table ' || no || '. Orders' AS table_title
FROM across""",
    "tidy_fallback_mixed": GRID + ", " + ACROSS.strip().removeprefix("WITH") + """
SELECT 'lineitem' AS source_file, no AS sheet_no, m AS date,
       'S' || lpad(CAST(supp AS VARCHAR), 7, '0') AS series_id, v AS value FROM down
UNION ALL
SELECT 'orders', no, m, 'PRIO000' || left(priority, 1), v FROM across""",
    "tidy_no_metadata": GRID + """
SELECT 'lineitem' AS source_file, 'Table ' || no AS sheet, no AS sheet_no, m AS date,
       'S' || lpad(CAST(supp AS VARCHAR), 7, '0') AS series_id, v AS value,
       CAST(NULL AS VARCHAR) AS unit, 'monthly' AS frequency, 'Column ' || (supp + 2) AS series
FROM down""",
    "series_metadata": GRID + ", " + ACROSS.strip().removeprefix("WITH") + """
SELECT DISTINCT 'lineitem' AS source_file, 'Table ' || no AS sheet,
       'S' || lpad(CAST(supp AS VARCHAR), 7, '0') AS series_id, 'Items' AS unit,
       'monthly' AS frequency, 'Quantity ; Supplier ' || supp AS series,
       'lineitem' AS source_workbook FROM down
UNION ALL
SELECT DISTINCT 'orders', 'Orders ' || no, 'PRIO000' || left(priority, 1), 'Orders', 'monthly',
       priority, 'orders' FROM across
UNION ALL
SELECT 'suppliers', 'Nation ' || s_nationkey, 'B' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0'),
       'Dollars', 'semiannual', s_name, 'suppliers' FROM supplier WHERE s_acctbal >= 0""",
    "metadata_only": """
SELECT 'Nation ' || s_nationkey AS sheet, 'B' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS series_id,
       'Dollars' AS unit, 'semiannual' AS frequency, s_name AS series
FROM supplier WHERE s_acctbal >= 0""",
    "sheet_context": """
SELECT 'customers/' || c_custkey AS source_file, (c_nationkey + 5000) || '.0' AS cat_no,
       lower(strftime(DATE '2020-01-01' + to_months(c_nationkey), '%b-%Y')) AS release_date,
       'Table ' || (c_custkey + 1) AS table,
       CASE WHEN c_acctbal >= 0 THEN c_nationkey || 'b' ELSE CAST(c_custkey + 1 AS VARCHAR) END
         AS table_no,
       CASE WHEN c_acctbal >= 0 THEN 'Table ' || c_nationkey || 'b. ' || c_mktsegment
            ELSE 'Table ' || (c_custkey + 1) END AS table_title
FROM customer""",
    "table_match": """
WITH sheets AS (
  SELECT DISTINCT 'Table ' || p_size || ' ' || p_type || ' ' || p_name AS sheet FROM part),
requests AS (
  SELECT DISTINCT request FROM (
    SELECT CAST(p_size AS VARCHAR) AS request FROM part UNION ALL SELECT lower(p_type) FROM part
    UNION ALL SELECT p_name FROM part UNION ALL SELECT 'TABLE ' || p_size FROM part
    UNION ALL SELECT n_name FROM nation)),
keyed AS (
  SELECT *, regexp_replace(lower(sheet), '\\s+', '', 'g') AS sheet_key,
         regexp_replace(lower(request), '\\s+', '', 'g') AS request_key,
         regexp_extract(lower(request), '[0-9]+[a-z]?', 0) AS number
  FROM sheets, requests)
SELECT sheet, request FROM keyed
WHERE sheet_key = request_key
   OR CASE WHEN number <> ''
           THEN list_contains(regexp_extract_all(lower(sheet), '[0-9]+[a-z]?', 0), number)
           ELSE contains(sheet_key, request_key) END""",
    "raw_sheet": """
SELECT c_custkey + 2 AS row_no, CAST(c_custkey AS VARCHAR) AS c_custkey,
       c_name AS "Customer_name", c_mktsegment AS "Customer_name_2",
       CAST(c_nationkey AS VARCHAR) AS "Nation_no"
FROM customer""",
    "period_parse": """
WITH styled AS (
  SELECT *, o_orderkey % 9 AS style, CAST(o_orderdate AS DATE) AS d FROM orders),
parsed AS (
  SELECT o_orderkey,
    CASE style
      WHEN 0 THEN strftime(d, '%Y') WHEN 1 THEN strftime(d, '%Y-%m')
      WHEN 2 THEN year(d) || '-Q' || quarter(d) WHEN 3 THEN 'Q' || quarter(d) || ' ' || year(d)
      WHEN 4 THEN strftime(d, '%b-%y') WHEN 5 THEN strftime(d, '%Y-%m-%d')
      WHEN 6 THEN strftime(d, '%d/%m/%Y') WHEN 7 THEN strftime(d, '%B %Y')
      ELSE o_orderpriority END AS label,
    CASE style
      WHEN 0 THEN make_date(year(d), 1, 1) WHEN 1 THEN make_date(year(d), month(d), 1)
      WHEN 2 THEN make_date(year(d), quarter(d) * 3 - 2, 1)
      WHEN 3 THEN make_date(year(d), quarter(d) * 3 - 2, 1)
      WHEN 4 THEN make_date(2000 + year(d) % 100, month(d), 1)
      WHEN 5 THEN d WHEN 6 THEN d WHEN 7 THEN make_date(year(d), month(d), 1) END AS date,
    CASE style WHEN 0 THEN 'annual' WHEN 1 THEN 'monthly' WHEN 2 THEN 'quarterly'
      WHEN 3 THEN 'quarterly' WHEN 8 THEN NULL ELSE 'unknown' END AS frequency
  FROM styled)
SELECT o_orderkey, label, date, frequency,
       make_date(year(date), quarter(date) * 3 - 2, 1) AS quarter_start,
       make_date(year(date), 1, 1) AS year_start
FROM parsed""",
    "number_parse": """
SELECT l_orderkey, l_linenumber,
       CASE l_orderkey % 8 WHEN 0 THEN price WHEN 1 THEN price WHEN 2 THEN -price
            WHEN 6 THEN CAST('+' || CAST(l_extendedprice AS DECIMAL(18, 2)) || 'e1' AS DOUBLE) END
         AS value
FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE) AS price FROM lineitem)""",
    "frequency_infer": """
WITH dates AS (
  SELECT o_custkey, year(o_orderdate) * 12 + month(o_orderdate) AS m, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS rn FROM orders),
deltas AS (
  SELECT o_custkey, lead(m) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, rn) - m AS delta
  FROM dates),
ranked AS (
  SELECT o_custkey, delta, row_number() OVER (PARTITION BY o_custkey ORDER BY delta) AS rn,
         count(*) OVER (PARTITION BY o_custkey) AS n
  FROM deltas WHERE delta IS NOT NULL),
medians AS (SELECT o_custkey, delta FROM ranked WHERE rn = (n + 1) // 2)
SELECT o_custkey, CASE delta WHEN 1 THEN 'monthly' WHEN 3 THEN 'quarterly' WHEN 12 THEN 'annual'
       ELSE 'unknown' END AS frequency
FROM (SELECT DISTINCT o_custkey FROM orders) LEFT JOIN medians USING (o_custkey)""",
    "frequency_normalise": """
SELECT o_orderkey, CASE WHEN o_totalprice < 5000 THEN 'unknown' ELSE
  ['monthly', 'quarterly', 'annual', 'annual', 'weekly', 'fortnightly', 'semiannual',
   'semiannual', 'semiannual', 'daily', 'daily', 'unknown'][o_orderkey % 12 + 1] END AS frequency
FROM orders""",
    "key_and_name_normalise": """
WITH texts AS (
  SELECT p_partkey, p_name || '  (' || p_brand || ')' AS label FROM part
  UNION ALL SELECT CAST(-n_nationkey - 1 AS BIGINT), ' ' || n_name || '%' FROM nation)
SELECT p_partkey, regexp_replace(lower(label), '[^a-z0-9]', '', 'g') AS label_key,
       regexp_replace(regexp_replace(trim(label), '\\s+', '_', 'g'), '[^A-Za-z0-9_]', '', 'g') AS name
FROM texts""",
    "layout_predicates": f"""
WITH texts AS (
  SELECT p_partkey AS id, 'name' AS source, p_name AS text FROM part
  UNION ALL SELECT p_partkey, 'type', p_type || p_size FROM part
  UNION ALL SELECT p_partkey, 'title', 'Tables ' || p_size || 'b to ' || p_name FROM part
  UNION ALL SELECT p_partkey, 'short', 'in Table ' || p_size FROM part
  UNION ALL SELECT s_suppkey, 'blank', CASE WHEN s_acctbal < 0 THEN '  ' ELSE 'Series Type' END
  FROM supplier)
SELECT id, source, nullif(trim(text), '') AS cleaned,
       regexp_matches(trim(text), '^[A-Z][A-Z0-9]{{5,}}$') AS is_series_id,
       source = 'title' OR (source = 'short' AND length(text) > 12) AS is_title,
       nullif(regexp_extract(text, '{TABLE_NO}', 1), '') AS table_no
FROM texts""",
    "release_text": f"""
SELECT o_orderkey,
       CASE WHEN o_orderkey % 4 < 3 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS month,
       CASE WHEN o_orderkey % 4 < 3 THEN lower(strftime(o_orderdate, '%b-%Y')) END AS release,
       lower(strftime(o_orderdate, '%b-%Y')) AS url_release,
       '{BASE}/orders/' || strftime(o_orderdate, '%b-%Y') AS page
FROM orders""",
    "filename_and_type": INDEX + f"""
SELECT p_partkey AS id,
       page_url || '/' || replace(cat_no, '.', '') || lpad(table_no, 3, '0') || '_' || filename AS url,
       replace(cat_no, '.', '') || lpad(table_no, 3, '0') || '_' || filename AS filename,
       '.xlsx' AS extension, 'xlsx' AS file_type, table_no
FROM idx
UNION ALL
SELECT -page_id - 1, clean, name, regexp_extract(name, '(\\.[^.]*)$', 1),
       CASE WHEN regexp_extract(name, '(\\.[^.]*)$', 1) <> ''
            THEN lower(ltrim(regexp_extract(name, '(\\.[^.]*)$', 1), '.')) ELSE 'cube' END,
       CASE WHEN starts_with(lower(name), '1') AND found <> ''
            THEN CAST(CAST(regexp_extract(found, '^([0-9]+)', 1) AS INTEGER) AS VARCHAR)
                 || regexp_extract(found, '([a-z]?)$', 1) END
FROM (
  SELECT page_id, clean, name,
         regexp_extract(substr(lower(regexp_replace(name, '\\.[^.]*$', '')), 2),
                        '^0*([0-9]{{1,3}}[a-z]?)', 1) AS found
  FROM (
    SELECT page_id, clean, CASE WHEN last = '' THEN 'download' ELSE
             trim(regexp_replace(regexp_replace(last, '[^\\p{{L}}\\p{{N}}_.\\-]+', '_', 'g'),
                                 '_+', '_', 'g'), '_') END AS name
    FROM (SELECT page_id, clean, regexp_extract(clean, '([^/]*)$', 1) AS last
          FROM (SELECT page_id, split_part(split_part(
                  CASE WHEN regexp_matches(url, '^(?i)https?://') THEN url
                       WHEN starts_with(url, '/') THEN '{BASE}' || url
                       ELSE '{BASE}/' || url END, '#', 1), '?', 1) AS clean FROM pages))))""",
    "cube_matrix": MATRIX + """
SELECT 'matrix' AS source_file, '6202.0' AS cat_no, sheet, date, 'unknown' AS frequency,
       v AS value, status AS "Status", nation AS "Nation_key"
FROM matrix""",
    "cube_generic": """
SELECT 'Cube ' || regexp_extract(p_brand, '([0-9]+)$', 1) AS sheet,
       CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) AS sheet_no,
       p_partkey + 2 AS row_no, CAST(p_partkey AS VARCHAR) AS "Part",
       p_type AS "Type", CAST(p_size AS VARCHAR) AS "Size"
FROM part""",
    "cube_auto_fallback": MATRIX + """
SELECT sheet, date, 'unknown' AS frequency, v AS value, status AS "Status", nation AS "Nation_key",
       CAST(NULL AS VARCHAR) AS "Part", CAST(NULL AS VARCHAR) AS "Type", CAST(NULL AS VARCHAR) AS "Size"
FROM matrix
UNION ALL
SELECT 'Cube ' || regexp_extract(p_brand, '([0-9]+)$', 1), NULL, NULL, NULL, NULL, NULL,
       CAST(p_partkey AS VARCHAR), p_type, CAST(p_size AS VARCHAR)
FROM part""",
    "footer_and_notes": """
WITH rows AS (
  SELECT l_suppkey, l_orderkey, sum(l_quantity) AS quantity, max(l_tax) AS tax
  FROM lineitem GROUP BY 1, 2),
cut AS (
  SELECT l_suppkey, min(l_orderkey) AS footer FROM rows
  WHERE (tax >= 0.08 AND quantity <= 2) OR (quantity = 50 AND tax = 0) GROUP BY 1),
kept AS (
  SELECT 'Supplier ' || l_suppkey AS sheet, l_orderkey + 2 AS row_no, l_orderkey, quantity
  FROM rows JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN cut USING (l_suppkey)
  WHERE s_acctbal >= 0 AND (footer IS NULL OR l_orderkey < footer))
SELECT sheet, row_no, 'Quantity' AS name, quantity AS num, CAST(NULL AS VARCHAR) AS text FROM kept
UNION ALL
SELECT sheet, row_no, 'Order', NULL, CAST(l_orderkey AS VARCHAR) FROM kept
UNION ALL
SELECT sheet, row_no, 'Remark', NULL, 'All cells in' FROM kept WHERE quantity = 50""",
    "series_lookup": OBS + """
SELECT series_id, sheet, date, l_returnflag, value FROM obs
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)""",
    "family_view": OBS + """
SELECT cat_no, series_id, sheet, date, value FROM obs WHERE cat_no = '6302.0'""",
    "separate_series": LABELS + """
SELECT p_partkey, series, parts[1] AS series_part_1, parts[2] AS series_part_2,
       parts[3] AS series_part_3, parts[4] AS series_part_4
FROM kept""",
    "separate_series_totals": LABELS + """
SELECT p_partkey, series, rest[1] AS series_part_1, rest[2] AS series_part_2,
       rest[3] AS series_part_3
FROM kept""",
    "separate_series_drop": LABELS + """
SELECT p_partkey, series, rest[1] AS kind, rest[2] AS item, rest[3] AS brand
FROM kept WHERE len(rest) = 3""",
    "latest_date": """
SELECT o_orderpriority, CAST(max(o_orderdate) AS DATE) AS latest_date FROM orders GROUP BY 1
UNION ALL SELECT 'any', CAST(max(o_orderdate) AS DATE) FROM orders""",
    "obs_with_meta": OBS + """
SELECT cat_no, sheet, series_id, date, value, s_name AS series
FROM obs JOIN supplier ON l_suppkey = s_suppkey""",
    "catalogues": INDEX + """
SELECT cat_no, arg_min(title, p_partkey) AS title, arg_min(description, p_partkey) AS description,
       arg_min(page_url, p_partkey) AS page_url, true AS supported
FROM idx GROUP BY cat_no""",
    "search_index": INDEX + """
SELECT filename FROM idx WHERE contains(lower(
  cat_no || ' ' || title || ' ' || description || ' ' || file_title || ' ' || file_title || ' '
  || filename), 'widget 62')""",
    "search_documents": """
SELECT doc_id FROM documents WHERE contains(lower(
  lang || ' ' || source || ' ' || text || ' document  ' || doc_id), 'licen')""",
    "search_cubes": INDEX + """
SELECT cat_no, filename FROM idx WHERE is_cube AND contains(lower(
  cat_no || ' ' || title || ' ' || description || ' ' || file_title || ' ' || file_title || ' '
  || filename || ' ' || url), 'mar-202')""",
    "files_by_catalogue": INDEX + """
SELECT cat_no, filename, file_title FROM idx WHERE cat_no = '6213.0'""",
    "cube_files": INDEX + """
SELECT cat_no, filename FROM idx WHERE is_cube AND release_date = 'mar-2021'""",
    "select_file": INDEX + f""",
requests AS (
  SELECT o_orderkey AS request_id, {REQUEST_CAT} AS cat_no,
         [NULL, 'widget', '3'][o_orderkey % 3 + 1] AS file,
         CASE WHEN o_totalprice < 100000 THEN lower(strftime({REQUEST_MONTH}, '%b-%Y')) END AS release,
         o_orderstatus = 'P' AS cube FROM orders),
candidates AS (
  SELECT request_id, filename,
         row_number() OVER (PARTITION BY request_id ORDER BY
           CASE WHEN NOT cube AND file IS NULL AND table_no = '1' THEN 0 ELSE 1 END,
           p_size DESC, filename) AS rn
  FROM requests JOIN idx ON requests.cat_no = idx.cat_no AND requests.cube = idx.is_cube
   AND (release IS NULL OR release = release_date)
   AND (file IS NULL OR contains(lower(file_title), file) OR contains(lower(filename), file)
        OR table_no = file))
SELECT request_id, filename,
       CASE WHEN filename IS NOT NULL THEN NULL
            WHEN cat_no NOT IN (SELECT cat_no FROM idx) THEN 'no files for catalogue'
            WHEN (cat_no, cube) NOT IN (SELECT (cat_no, is_cube) FROM idx) THEN 'no files of this kind'
            WHEN release IS NOT NULL AND (cat_no, cube, release) NOT IN
                 (SELECT (cat_no, is_cube, release_date) FROM idx) THEN 'no files for release'
            ELSE 'no file matched' END AS error
FROM requests LEFT JOIN (SELECT * FROM candidates WHERE rn = 1) USING (request_id)""",
    "releases": f"""
SELECT '60' || ascii(o_orderstatus) || '.0' AS cat_no, arg_max(o_orderpriority, o_orderkey) AS title,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS release_date,
       '{BASE}/60' || ascii(o_orderstatus) || '.0/' || lower(strftime(min(o_orderdate), '%b-%Y'))
         AS release_url
FROM orders GROUP BY o_orderstatus, date_trunc('month', o_orderdate)""",
    "nearest_release": """
WITH requests AS (
  SELECT DISTINCT l_linestatus AS cat_no, CAST(l_shipdate AS DATE) AS requested FROM lineitem),
known AS (
  SELECT DISTINCT o_orderstatus AS cat_no, CAST(o_orderdate AS DATE) AS release_date
  FROM orders),
ranked AS (
  SELECT cat_no, requested, release_date, abs(date_diff('day', requested, release_date)) AS days,
         row_number() OVER (PARTITION BY cat_no, requested
           ORDER BY abs(date_diff('day', requested, release_date)), release_date) AS rank
  FROM requests JOIN known USING (cat_no))
SELECT cat_no, requested, CAST(rank AS INTEGER) AS rank, release_date, CAST(days AS INTEGER) AS days
FROM ranked WHERE rank <= 3""",
    "release_files": INDEX + f""",
requests AS (
  SELECT DISTINCT {REQUEST_CAT} AS cat_no, {REQUEST_MONTH} AS release_month
  FROM orders)
SELECT cat_no, release_month, filename FROM idx JOIN requests USING (cat_no)
WHERE release_date = lower(strftime(release_month, '%b-%Y'))""",
    "page_links": LINKS + f"""
SELECT page_id, ord, label,
       CASE WHEN regexp_matches(href, '^(?i)https?://') THEN href
            WHEN starts_with(href, '//') THEN 'https:' || href
            WHEN starts_with(href, '/') THEN '{BASE}' || href
            ELSE '{BASE}/' || href END AS url
FROM links""",
    "page_best_link": LINKS + f""",
scored AS (
  SELECT *, CASE WHEN label = '' THEN 0 ELSE least(length(label), 200)
           + CASE WHEN regexp_matches(label, '{TABLE_NO}') THEN 500 ELSE 0 END
           - CASE WHEN {GENERIC} THEN 1000 ELSE 0 END END AS score FROM links)
SELECT page_id, href, label, CAST(score AS INTEGER) AS score FROM scored
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY score DESC, ord DESC) = 1""",
    "page_attributes": f"""
SELECT page_id,
  nullif({_html_text("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}, '') AS h1,
  nullif({_html_text("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}, '') AS title,
  nullif({_html_text('''regexp_extract(html, '(?is)<meta\\s+name=["'']description["'']\\s+content=["'']([^"'']*)["'']', 1)''')}, '')
    AS description
FROM pages""",
    "page_outline": LINKS + f"""
SELECT page_id, href, label, {GENERIC} AS is_generic FROM links""",
    "discover_files": f"""
WITH p AS (
  SELECT *, '{BASE}/parts/' || p_partkey AS page FROM part)
SELECT 'P' || p_partkey AS cat_no, p_brand || ' statistics' AS title,
       'Parts of ' || p_brand AS description, 'apr-2024' AS release_date,
       'Table ' || p_size || '. ' || p_name AS file_title,
       page || '/apr-2024/t' || p_partkey || '.xlsx' AS url,
       'P' || p_partkey || '_Table_' || p_size || '._' || replace(p_name, ' ', '_') || '.xlsx' AS filename,
       'xlsx' AS file_type, CAST(p_size AS VARCHAR) AS table_no,
       'Table ' || p_size || '. ' || p_name AS table_title, true AS is_timeseries, false AS is_cube
FROM p
UNION ALL
SELECT 'P' || p_partkey, p_brand || ' statistics', 'Parts of ' || p_brand, 'apr-2024',
       p_type || ' data cube & more', page || '/apr-2024/c' || p_partkey || '.xls',
       'P' || p_partkey || '_' || replace(p_type, ' ', '_') || '_data_cube_more.xls', 'xls', '',
       p_type || ' data cube & more', false, true
FROM p""",
    "link_context": f"""
SELECT p_partkey AS page_id, '{BASE}/parts/' || p_partkey || '/apr-2024/t' || p_partkey || '.xlsx' AS url,
       'Table ' || p_size || '. ' || p_name || 'Download xlsx [1 KB]' AS context FROM part
UNION ALL
SELECT p_partkey, '{BASE}/parts/' || p_partkey || '/apr-2024/c' || p_partkey || '.xls',
       p_type || ' data cube & more Download xls' FROM part""",
    "discover_releases": f"""
WITH c AS (
  SELECT *, '{BASE}/customers/' || c_custkey AS page,
         CAST(DATE '2015-01-01' + to_months(c_nationkey) AS DATE) AS m,
         CAST(DATE '2015-01-01' + to_months(c_nationkey - 3) AS DATE) AS e FROM customer)
SELECT 'C' || c_custkey AS cat_no, 'Customers ' || strftime(m, '%B %Y') AS title, m AS release_date,
       page || '/' || lower(strftime(m, '%b-%Y')) AS release_url FROM c WHERE c_acctbal >= 0
UNION ALL
SELECT 'C' || c_custkey, 'Earlier', e, page || '/' || lower(strftime(e, '%b-%Y')) || '/all'
FROM c WHERE c_acctbal >= 0
UNION ALL
SELECT 'C' || c_custkey, c_name, DATE '2020-01-01', page || '/jan-2020' FROM c WHERE c_acctbal < 0""",
    "sdmx_observations": """
WITH o AS (
  SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS price,
         CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, strftime(d, '%Y-%m') AS period, make_date(year(d), month(d), 1) AS date,
       price AS value, o_orderpriority AS "PRIORITY", o_orderstatus AS "STATUS" FROM o
UNION ALL
SELECT o_orderkey, year(d) || '-Q' || quarter(d), make_date(year(d), quarter(d) * 3 - 2, 1), price,
       o_orderpriority, o_orderstatus FROM o
UNION ALL
SELECT o_orderkey, '9', NULL, NULL, o_orderpriority, o_orderstatus FROM o""",
    "sdmx_json_map": """
SELECT event_id, CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS BIGINT) AS k FROM events""",
    "dataflows": """
SELECT DISTINCT c_mktsegment || '_' || c_nationkey AS id, lower(c_mktsegment) AS name,
       'Flow' AS description
FROM customer""",
    "datastructure": """
SELECT CAST(r_regionkey AS BIGINT) AS doc_id, 'NATION' AS dimension_id,
       'Nation of ' || r_name AS dimension_name, 1 AS position, 'N' || n_nationkey AS code,
       n_name AS label,
       CAST(row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey) AS INTEGER) AS code_position
FROM region JOIN nation ON r_regionkey = n_regionkey
UNION ALL
SELECT CAST(r_regionkey AS BIGINT), 'SEG', 'Market segment', 2, CAST(i AS VARCHAR),
       ['AUTOMOBILE', 'BUILDING', 'FURNITURE', NULL][i], i
FROM region, (SELECT CAST(unnest(range(1, 5)) AS INTEGER) AS i)
UNION ALL
SELECT CAST(r_regionkey AS BIGINT), 'FREE', 'Free', 3, NULL, NULL, NULL FROM region""",
    "api_key": """
SELECT c_custkey AS request_id, CAST(n_regionkey AS BIGINT) AS doc_id,
       CASE WHEN c_acctbal < 0 THEN 'all'
            WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')
            THEN 'N' || n_nationkey || '+N' || n_nationkey || '.'
                 || CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 ELSE 3 END || '.'
       END AS key,
       CASE WHEN c_acctbal >= 0 AND c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')
            THEN 'invalid code ' || c_mktsegment || ' for dimension SEG' END AS error
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "dimension_filter": OBS + """
SELECT series_id, date, l_returnflag, value FROM obs
WHERE l_returnflag IN ('R', 'A') AND l_linestatus = 'F'
  AND date >= DATE '1996-04-01' AND date < DATE '1999-01-01'""",
    "union_by_name": """
SELECT c_name AS name, c_nationkey AS nation, CAST(NULL AS BIGINT) AS supplier FROM customer
UNION ALL SELECT s_name, NULL, s_suppkey FROM supplier""",
    "source_inventory": """
SELECT source AS kind, doc_id || '.xlsx' AS file, '/lake/' || source || '/' || doc_id || '.xlsx' AS path,
       n_chars AS size, doc_id + 1700000000 AS modified
FROM documents""",
    "incremental_ingest": """
SELECT doc_id, '/lake/' || source || '/' || doc_id || '.xlsx' AS path,
       sha1('/lake/' || source || '/' || doc_id || '.xlsx' || chr(10) || n_chars || chr(10)
            || (doc_id + 1700000000) * 1000000 || chr(10) || '1' || chr(10) || '0.1.0' || chr(10)
            || 'cells' || chr(10) || '{"tables": null}') AS fingerprint
FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)""",
    "workbook_cells": BOOKS + """,
good AS (SELECT * FROM sheets WHERE NOT broken AND n > 0),
body AS (
  SELECT source_file, g.sheet_no, g.sheet, line + 1 AS row_no, c.col_no, l.*
  FROM good g JOIN lines l ON l.book = g.book AND l.sheet_no = g.sheet_no, (VALUES (1), (2), (3), (4)) c(col_no))
SELECT source_file, sheet_no, sheet, CAST(1 AS BIGINT) AS row_no, CAST(h.col_no AS INTEGER) AS col_no, 's' AS kind,
       h.text, CAST(NULL AS DOUBLE) AS num, CAST(NULL AS DATE) AS date
FROM good, (VALUES (1, 'Order'), (2, 'Priority'), (3, 'Day'), (4, 'Price')) h(col_no, text)
UNION ALL
SELECT source_file, sheet_no, sheet, row_no, CAST(col_no AS INTEGER),
       CASE col_no WHEN 2 THEN 's' WHEN 3 THEN 'd' ELSE 'n' END,
       CASE WHEN col_no = 2 THEN o_orderpriority END,
       CASE col_no WHEN 1 THEN CAST(o_orderkey AS DOUBLE) WHEN 4 THEN o_totalprice
            WHEN 3 THEN CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS DOUBLE) END,
       CASE WHEN col_no = 3 THEN CAST(o_orderdate AS DATE) END
FROM body""",
    "workbook_sheets": BOOKS + """
SELECT source_file, sheet_no, sheet, CASE WHEN NOT broken THEN n_cells END AS n_cells, broken AS is_broken
FROM sheets
UNION ALL
SELECT DISTINCT source_file, CAST(NULL AS INTEGER), NULL, NULL, true FROM all_sheets WHERE no_file""",
    "workbook_tables": BOOKS + """
SELECT source_file, sheet_no, sheet, n_cells FROM sheets WHERE sheet = 'Status P' AND n > 0""",
    "sheet_names": BOOKS + """
SELECT source_file, sheet_no, sheet FROM sheets""",
    "ingest_changed": BOOKS + """,
totals AS (
  SELECT source_file, round(sum(o_totalprice) * CASE WHEN any_value(l.book) % 3 = 0 THEN 2 ELSE 1 END, 2) AS total
  FROM lines l JOIN sheets s ON s.book = l.book AND s.sheet_no = l.sheet_no WHERE NOT broken GROUP BY source_file)
SELECT a.source_file AS path, CASE WHEN any_value(a.book) % 3 = 0 THEN 'second' ELSE 'first' END AS run,
       count(*) FILTER (NOT a.no_file AND NOT a.broken) AS n_sheets,
       CAST(coalesce(sum(s.n_cells) FILTER (NOT a.broken), 0) AS BIGINT) AS n_cells,
       CASE WHEN bool_or(a.no_file) THEN 1 ELSE count(*) FILTER (a.broken) END AS n_errors, any_value(total) AS total
FROM all_sheets a LEFT JOIN sheets s USING (source_file, sheet_no) LEFT JOIN totals t USING (source_file)
GROUP BY a.source_file""",
    "release_by_date": INDEX + f""",
requests AS (
  SELECT o_orderkey AS request_id, {REQUEST_CAT} AS cat_no, CAST({REQUEST_MONTH} AS DATE) AS month FROM orders),
months AS (SELECT DISTINCT cat_no, CAST(DATE '2020-01-01' + INTERVAL (p_size) MONTH AS DATE) AS known FROM idx),
candidates AS (
  SELECT request_id, filename, row_number() OVER (PARTITION BY request_id ORDER BY
           CASE WHEN table_no = '1' THEN 0 ELSE 1 END, filename) AS rn
  FROM requests JOIN idx ON requests.cat_no = idx.cat_no AND NOT idx.is_cube
   AND lower(strftime(month, '%b-%Y')) = release_date),
near AS (
  SELECT request_id, known, row_number() OVER (PARTITION BY request_id
           ORDER BY abs(date_diff('day', month + 14, known)), known) AS rn
  FROM requests JOIN months USING (cat_no)),
told AS (
  SELECT request_id, string_agg(CAST(known AS VARCHAR), ', ' ORDER BY rn) AS listed FROM near WHERE rn <= 3
  GROUP BY request_id)
SELECT request_id, filename,
       CASE WHEN filename IS NOT NULL THEN NULL
            WHEN cat_no NOT IN (SELECT cat_no FROM idx) THEN 'no files for catalogue'
            WHEN cat_no NOT IN (SELECT cat_no FROM idx WHERE NOT is_cube) THEN 'no files of this kind'
            ELSE 'release ' || (month + 14) || ' is not available; nearest known releases: ' || listed END AS error
FROM requests LEFT JOIN (SELECT * FROM candidates WHERE rn = 1) USING (request_id)
     LEFT JOIN told USING (request_id)""",
    "request_to_obs": GRID + """,
requests AS (
  SELECT ascii(l_returnflag) AS request_id, ascii(l_returnflag) - 64 AS no, ascii(l_returnflag) AS letter
  FROM (SELECT DISTINCT l_returnflag FROM lineitem)
  UNION ALL
  SELECT 1, max(ascii(l_returnflag)) - 64, max(ascii(l_returnflag)) FROM lineitem)
SELECT request_id, 'lineitem-' || no || '.xlsx' AS source_file, '6202.0' AS cat_no,
       lower(strftime(DATE '2020-01-01' + INTERVAL (letter) MONTH, '%b-%Y')) AS release_date, 'Table ' || no AS sheet,
       m AS date, 'S' || lpad(CAST(supp AS VARCHAR), 7, '0') AS series_id, v AS value
FROM requests JOIN down USING (no)""",
    "cube_provenance": MATRIX + """,
requests AS (
  SELECT ascii(l_returnflag) AS request_id, ascii(l_returnflag) - 64 AS no, l_returnflag AS flag
  FROM (SELECT DISTINCT l_returnflag FROM lineitem)
  UNION ALL
  SELECT 1, max(ascii(l_returnflag)) - 64, max(l_returnflag) FROM lineitem)
SELECT request_id, 'matrix-' || r.no || '.xlsx' AS source_file, '6202.0' AS cat_no,
       lower(strftime(DATE '2020-01-01' + INTERVAL (ascii(flag)) MONTH, '%b-%Y')) AS release_date,
       'matrix-' || r.no || '.xlsx' AS "cube", 'Flag ' || flag AS cube_title, date, v AS value,
       status AS "Status", nation AS "Nation_key"
FROM requests r JOIN matrix ON sheet = 'Flows ' || r.no""",
    "refresh_index": f"""
WITH p AS (
  SELECT *, '{BASE}/parts/' || p_partkey AS page, p_size + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS now
  FROM part)
SELECT 'P' || p_partkey AS cat_no, 'Table ' || now || '. ' || p_name AS file_title,
       page || '/apr-2024/t' || p_partkey || '.xlsx' AS url, CAST(now AS VARCHAR) AS table_no, false AS is_cube
FROM p
UNION ALL
SELECT 'P' || p_partkey, p_type || ' data cube & more', page || '/apr-2024/c' || p_partkey || '.xls', '', true FROM p""",
    "index_rows": INDEX + """
SELECT cat_no, CASE WHEN starts_with(release_date, 'mar-') THEN upper(title) ELSE title END AS title,
       release_date, filename, file_title AS table_title
FROM idx""",
    "unknown_catalogues": INDEX + """
SELECT o_orderkey FROM orders
WHERE '62' || lpad(CAST(o_custkey % 60 AS VARCHAR), 2, '0') || '.0' NOT IN (SELECT cat_no FROM idx)""",
    "json_documents": "SELECT event_id, event_type, props FROM events",
    "sheet_selection": """
WITH labels AS (
  SELECT s_nationkey, CAST(s_suppkey + 2 AS INTEGER) AS col_no, s_acctbal, s_suppkey, s_name FROM supplier
  WHERE s_nationkey % 3 = 0),
rows AS (
  SELECT s_nationkey, 1 AS col_no, unnest([1, 2, 3, 4]) AS row_no,
         unnest(['Series Number', 'Description', 'Units', 'Frequency']) AS text
  FROM (SELECT DISTINCT s_nationkey FROM labels)
  UNION ALL
  SELECT s_nationkey, col_no, unnest([1, 2, 3, 4]),
         unnest([CASE WHEN s_acctbal < 0 THEN 'draft-' ELSE 'B' END || lpad(CAST(s_suppkey AS VARCHAR), 7, '0'),
                 s_name, 'Dollars', 'Biannual'])
  FROM labels)
SELECT 'suppliers' AS source_file, 'Nation ' || s_nationkey AS sheet, CAST(row_no AS BIGINT) AS row_no,
       CAST(col_no AS INTEGER) AS col_no, text
FROM rows""",
}
ORACLE["ordered_structure"] = f"""
SELECT doc_id, dimension_id, code, CAST(row_number() OVER (PARTITION BY doc_id
         ORDER BY position, code_position NULLS LAST) AS INTEGER) AS place
FROM ({ORACLE["datastructure"]})"""
ORACLE["refresh_releases"] = ORACLE["discover_releases"]
