"""DuckDB SQL equivalents of the registered queries (same column names).

The extract derivation of ``sources/extracts.py`` is restated once as SQL
(``BASE``), then every query reads from it or from the driver tables.
"""

from __future__ import annotations

from .. import schemas as S


def _vs(name: str, left_expr: str, left_table: str, right_expr: str, right_table: str) -> str:
    return f"""
SELECT '{name}' AS column_name,
       CAST(sum(il) AS BIGINT) AS n_left_distinct,
       CAST(sum(ir) AS BIGINT) AS n_right_distinct,
       CAST(count(*) FILTER (WHERE il = 1 AND ir = 0) AS BIGINT) AS n_left_only,
       CAST(count(*) FILTER (WHERE ir = 1 AND il = 0) AS BIGINT) AS n_right_only,
       CASE WHEN count(*) FILTER (WHERE il = 1 AND ir = 0) > 0
             AND count(*) FILTER (WHERE ir = 1 AND il = 0) > 0 THEN 'BOTH'
            WHEN count(*) FILTER (WHERE il = 1 AND ir = 0) > 0 THEN 'LEFT_NOT_RIGHT'
            WHEN count(*) FILTER (WHERE ir = 1 AND il = 0) > 0 THEN 'RIGHT_NOT_LEFT'
            ELSE 'EQUAL' END AS relation
FROM (SELECT v, max(il) AS il, max(ir) AS ir
      FROM (SELECT {left_expr} AS v, 1 AS il, 0 AS ir FROM {left_table}
            UNION ALL
            SELECT {right_expr} AS v, 0 AS il, 1 AS ir FROM {right_table}) u
      GROUP BY v) g
"""


def _scores() -> str:
    out = []
    for i, name in enumerate(S.SCORING_FLOAT_COLUMNS):
        if i == 0:
            e = "CAST(o_orderkey % 4000 AS DOUBLE) / 1000.0"
        else:
            e = f"CAST((o_orderkey * {i + 3} + o_custkey) % 1000 AS DOUBLE) / 10.0"
        if name == "PAIN":
            e = f"CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE {e} END"
        out.append(f'CAST({e} AS FLOAT) AS "{name}"')
    return ",\n         ".join(out)


def _uid(prefix: str = "") -> str:
    p = prefix
    return (f"{p}inst || '|' || {p}prov || '|' || coalesce({p}fac, 'nan') || '|' || coalesce({p}res, 'nan')"
            f" || '|' || coalesce({p}asmt, 'nan') || '|' || strftime({p}fdate, '%Y-%m-%d')")


BASE = f"""
WITH facts AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority,
         CASE WHEN o.o_custkey % 2 = 0 THEN 'EXT' ELSE 'REV' END AS inst,
         CASE WHEN o.o_custkey % 3 = 0 THEN 'Ontario' ELSE 'Alberta' END AS prov,
         CAST(date_trunc('month', o.o_orderdate) AS DATE) AS fdate,
         CAST(c.c_nationkey AS VARCHAR) AS fac,
         CAST(o.o_custkey AS VARCHAR) AS res,
         CAST(o.o_orderkey AS VARCHAR) AS asmt,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_orderpriority END AS unit
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
qraw AS (
  SELECT f.inst || '_MDSAssessmentExtract_' || f.prov || '_' || strftime(f.fdate, '%Y-%m-%d') || '.csv' AS FILE_NAME,
         f.fac AS "Facility ID", f.res AS "Resident ID", f.unit AS "Unit", f.asmt AS "Assessment ID",
         f.o_orderstatus AS "Assessment Type", 'Q' || CAST(l.l_linenumber AS VARCHAR) AS "question_key",
         l.l_returnflag AS "item_value", CAST(l.l_quantity AS VARCHAR) AS "Answer",
         CAST(f.o_orderdate AS TIMESTAMP) AS "ARD", CAST(l.l_shipdate AS TIMESTAMP) AS "Answer_Date",
         f.fdate AS FILE_DATE, f.inst AS INSTANCE, f.prov AS PROVINCE, 'Questions' AS EXTRACT_TYPE,
         {_uid('f.')} AS UNIQUE_ASSESSMENT_ID
  FROM lineitem l JOIN facts f ON l.l_orderkey = f.o_orderkey
),
sraw AS (
  SELECT inst || '_MDSAssessmentExtractScoring_' || prov || '_' || strftime(fdate, '%Y-%m-%d') || '.csv' AS FILE_NAME,
         fac AS "Facility ID", res AS "Resident ID", unit AS "Unit", asmt AS "Assessment ID",
         o_orderstatus AS "RAI-MDS Status",
         CASE WHEN o_orderkey % 13 = 0 THEN o_orderpriority || chr(10) || o_orderstatus
              ELSE o_orderpriority END AS "Rug Group",
         {_scores()},
         CAST(o_orderdate AS TIMESTAMP) AS "ARD",
         CAST(o_orderdate + INTERVAL 7 DAY AS TIMESTAMP) AS "Assessment Locked Date",
         CAST(o_orderdate AS TIMESTAMP) AS "Date Assessment Created",
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 30 DAY AS TIMESTAMP) END
           AS "Date Assessment Revised",
         fdate AS FILE_DATE, inst AS INSTANCE, prov AS PROVINCE, 'Scoring' AS EXTRACT_TYPE,
         {_uid()} AS UNIQUE_ASSESSMENT_ID
  FROM facts
),
qt AS (
  SELECT * REPLACE ({", ".join(f'coalesce("{c}", {chr(39)}{chr(39)}) AS "{c}"' for c in S.QUESTIONS_STRING_COLUMNS)})
  FROM qraw
),
st AS (
  SELECT * REPLACE ({", ".join(f'coalesce("{c}", {chr(39)}{chr(39)}) AS "{c}"' for c in S.SCORING_STRING_COLUMNS)})
  FROM sraw
),
man AS (
  SELECT DISTINCT FILE_NAME, FILE_DATE, INSTANCE, PROVINCE, EXTRACT_TYPE FROM qt
  UNION
  SELECT DISTINCT FILE_NAME, FILE_DATE, INSTANCE, PROVINCE, EXTRACT_TYPE FROM st
),
pairs AS (
  SELECT coalesce(q.pk, s.pk) AS PAIR_KEY, q.FILE_NAME AS Q_FILE, s.FILE_NAME AS S_FILE,
         CASE WHEN q.FILE_NAME IS NOT NULL AND s.FILE_NAME IS NOT NULL THEN 'PAIRED' ELSE 'UNPAIRED' END
           AS PAIR_STATUS
  FROM (SELECT FILE_NAME, replace(FILE_NAME, 'Scoring', '') AS pk FROM man WHERE EXTRACT_TYPE = 'Questions') q
  FULL OUTER JOIN
       (SELECT FILE_NAME, replace(FILE_NAME, 'Scoring', '') AS pk FROM man WHERE EXTRACT_TYPE = 'Scoring') s
  ON q.pk = s.pk
),
idflags AS (
  SELECT PAIR_KEY, v, max(il) AS il, max(ir) AS ir
  FROM (SELECT replace(FILE_NAME, 'Scoring', '') AS PAIR_KEY, UNIQUE_ASSESSMENT_ID AS v, 1 AS il, 0 AS ir FROM qt
        UNION ALL
        SELECT replace(FILE_NAME, 'Scoring', '') AS PAIR_KEY, UNIQUE_ASSESSMENT_ID AS v, 0 AS il, 1 AS ir FROM st) u
  GROUP BY PAIR_KEY, v
),
idcheck AS (
  SELECT PAIR_KEY,
         CAST(sum(il) AS BIGINT) AS n_left_distinct,
         CAST(sum(ir) AS BIGINT) AS n_right_distinct,
         CAST(count(*) FILTER (WHERE il = 1 AND ir = 0) AS BIGINT) AS n_left_only,
         CAST(count(*) FILTER (WHERE ir = 1 AND il = 0) AS BIGINT) AS n_right_only,
         CASE WHEN count(*) FILTER (WHERE il = 1 AND ir = 0) > 0
               AND count(*) FILTER (WHERE ir = 1 AND il = 0) > 0 THEN 'BOTH'
              WHEN count(*) FILTER (WHERE il = 1 AND ir = 0) > 0 THEN 'LEFT_NOT_RIGHT'
              WHEN count(*) FILTER (WHERE ir = 1 AND il = 0) > 0 THEN 'RIGHT_NOT_LEFT'
              ELSE 'EQUAL' END AS relation
  FROM idflags GROUP BY PAIR_KEY
),
rollup AS (
  SELECT FILE_NAME, count(*) AS N_ROWS, count(DISTINCT "Resident ID") AS N_RESIDENTS,
         count(DISTINCT "Facility ID") AS N_FACILITIES, count(DISTINCT UNIQUE_ASSESSMENT_ID) AS N_UNIQUE_ASSESSMENTS
  FROM qt GROUP BY FILE_NAME
  UNION ALL
  SELECT FILE_NAME, count(*), count(DISTINCT "Resident ID"), count(DISTINCT "Facility ID"),
         count(DISTINCT UNIQUE_ASSESSMENT_ID)
  FROM st GROUP BY FILE_NAME
),
-- rendered raw files: every Scoring file and its Questions file (header-only when it has no rows)
rendered AS (
  SELECT DISTINCT FILE_NAME AS s_file, replace(FILE_NAME, 'Scoring', '') AS q_file, FILE_DATE, INSTANCE, PROVINCE
  FROM st
),
landlog AS (
  SELECT r.*, coalesce(q.N_ROWS, 0) AS q_rows, ic.relation,
         CASE WHEN coalesce(q.N_ROWS, 0) = 0 THEN
                'Column value check is invalid. Left dataframe is empty [right dataframe (scoring file '
                || r.s_file || ') has values and left dataframe (questions file ' || r.q_file || ') doesn''t]'
              WHEN ic.relation <> 'EQUAL' THEN
                'Unique Assessment ID sets not equal between left dataframe (questions file ' || r.q_file
                || ') and right dataframe (scoring file ' || r.s_file
                || '). Relationship: ColumnDomainRelationship.' || ic.relation || '.'
              ELSE '' END AS errs
  FROM rendered r
  LEFT JOIN rollup q ON q.FILE_NAME = r.q_file
  LEFT JOIN idcheck ic ON ic.PAIR_KEY = r.q_file
),
long_files AS (
  SELECT DISTINCT FILE_NAME FROM qt
  WHERE CAST("Assessment ID" AS BIGINT) % 50 = 0 AND question_key = 'Q1'
)
"""


def _null_report_sql() -> str:
    parts = []
    for tbl, cols in (("qraw", S.QUESTIONS_STRING_COLUMNS), ("sraw", S.SCORING_STRING_COLUMNS)):
        for c in cols:
            parts.append(f"""SELECT FILE_NAME, '{c}' AS column_name,
       count(*) FILTER (WHERE "{c}" IS NULL) AS nulls, count(*) AS n FROM {tbl} GROUP BY FILE_NAME""")
    union = "\nUNION ALL\n".join(parts)
    return BASE + f"""
SELECT FILE_NAME, column_name, nulls, n,
       CASE WHEN nulls = n THEN 'WARNING' ELSE 'INFO' END AS severity
FROM ({union}) x WHERE nulls > 0
"""


_LOG_SQL = """
SELECT l.q_file AS FILE_NAME, l.FILE_DATE, l.INSTANCE, l.PROVINCE, 'Questions' AS EXTRACT_TYPE,
       coalesce(r.N_ROWS, 0) AS N_ROWS, coalesce(r.N_RESIDENTS, 0) AS N_RESIDENTS,
       coalesce(r.N_FACILITIES, 0) AS N_FACILITIES, coalesce(r.N_UNIQUE_ASSESSMENTS, 0) AS N_UNIQUE_ASSESSMENTS,
       true AS READ_SUCCESS, l.q_rows > 0 AS INGEST_SUCCESS,
       CASE WHEN l.q_file IN (SELECT FILE_NAME FROM long_files) THEN {read_errors} ELSE '' END AS READ_ERRORS,
       l.errs AS INGEST_ERRORS
FROM landlog l LEFT JOIN rollup r ON r.FILE_NAME = l.q_file
UNION ALL
SELECT l.s_file, l.FILE_DATE, l.INSTANCE, l.PROVINCE, 'Scoring',
       r.N_ROWS, r.N_RESIDENTS, r.N_FACILITIES, r.N_UNIQUE_ASSESSMENTS,
       true, l.q_rows > 0, '', l.errs
FROM landlog l JOIN rollup r ON r.FILE_NAME = l.s_file"""

# Questions files holding a row that the malformed rendering lengthens by one field.
_MALFORMED_ERRORS = "'Error tokenizing data. C error: Expected 10 fields, saw 11'"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["value_set_orders_lineitem"] = _vs("orderkey", "o_orderkey", "orders", "l_orderkey", "lineitem")
    q["value_set_customer_orders"] = _vs("custkey", "c_custkey", "customer", "o_custkey", "orders")
    q["value_set_documents_labels"] = _vs("doc_id", "doc_id", "documents", "doc_id", "labels")
    q["value_set_labels_documents"] = _vs("doc_id", "doc_id", "labels", "doc_id", "documents")
    q["value_set_order_ship_days"] = _vs("day", "o_orderdate", "orders", "l_shipdate", "lineitem")
    q["value_set_multi_customer_supplier"] = (
        _vs("key", "c_custkey", "customer", "s_suppkey", "supplier") + " UNION ALL "
        + _vs("nationkey", "c_nationkey", "customer", "s_nationkey", "supplier"))
    q["value_set_multi_mixed_types"] = (
        _vs("status", "o_orderstatus", "orders", "l_linestatus", "lineitem") + " UNION ALL "
        + _vs("num", "CAST(o_orderkey AS DOUBLE)", "orders", "l_quantity", "lineitem"))
    q["value_diff_orders_without_lines"] = """
SELECT * FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey IS NOT DISTINCT FROM o.o_orderkey)"""
    q["value_diff_lines_without_orders"] = """
SELECT * FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey IS NOT DISTINCT FROM l.l_orderkey)"""
    q["value_diff_documents_unlabelled"] = """
SELECT doc_id, lang, source, n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels b WHERE b.doc_id IS NOT DISTINCT FROM d.doc_id)"""
    q["extract_manifest"] = BASE + """
SELECT *, row_number() OVER (PARTITION BY EXTRACT_TYPE ORDER BY FILE_DATE, INSTANCE, PROVINCE, FILE_NAME)
  AS ORDER_NO FROM man"""
    q["extract_pairs"] = BASE + "SELECT * FROM pairs"
    q["manifest_filtered"] = BASE + "SELECT * FROM man WHERE PROVINCE = 'Ontario' AND INSTANCE = 'EXT'"
    q["manifest_domains"] = BASE + """
SELECT 'INSTANCE' AS column_name, count(*) FILTER (WHERE INSTANCE NOT IN ('EXT', 'REV')) AS violations FROM man
UNION ALL
SELECT 'PROVINCE', count(*) FILTER (WHERE PROVINCE NOT IN ('Ontario', 'Alberta')) FROM man
UNION ALL
SELECT 'EXTRACT_TYPE', count(*) FILTER (WHERE EXTRACT_TYPE NOT IN ('Scoring', 'Questions')) FROM man"""
    q["composite_ids"] = BASE + """
SELECT FILE_NAME, FILE_DATE, INSTANCE, PROVINCE, EXTRACT_TYPE, "Assessment ID" AS ASSESSMENT_ID,
       UNIQUE_ASSESSMENT_ID FROM st"""
    q["typed_scoring"] = BASE + "SELECT * FROM st"
    q["typed_questions"] = BASE + "SELECT * FROM qt"
    q["read_metadata"] = BASE + "SELECT * FROM rollup"
    q["null_report"] = _null_report_sql()
    q["pair_id_check"] = BASE + "SELECT * FROM idcheck"
    q["uncovered_ids"] = BASE + """
SELECT f.PAIR_KEY,
       CASE WHEN f.il = 1 THEN p.Q_FILE ELSE p.S_FILE END AS FILE_WITH,
       CASE WHEN f.il = 1 THEN p.S_FILE ELSE p.Q_FILE END AS FILE_WITHOUT,
       f.v AS MISSING_ID
FROM idflags f JOIN pairs p ON p.PAIR_KEY = f.PAIR_KEY
WHERE f.il <> f.ir"""
    q["discovered_files"] = BASE + """
SELECT s_file AS FILE_NAME, FILE_DATE, INSTANCE, PROVINCE, 'Scoring' AS EXTRACT_TYPE FROM rendered
UNION ALL
SELECT q_file AS FILE_NAME, FILE_DATE, INSTANCE, PROVINCE, 'Questions' AS EXTRACT_TYPE FROM rendered"""
    q["landed_questions"] = BASE + "SELECT * FROM qt"
    q["landed_scoring"] = BASE + """
SELECT * FROM st WHERE replace(FILE_NAME, 'Scoring', '') IN (SELECT FILE_NAME FROM qt)"""
    q["landed_log"] = BASE + _LOG_SQL.format(read_errors="''")
    q["landed_null_report"] = _null_report_sql()
    q["landed_malformed_questions"] = BASE + "SELECT * FROM qt"
    q["landed_malformed_log"] = BASE + _LOG_SQL.format(read_errors=_MALFORMED_ERRORS)
    q["streamed_questions"] = BASE + "SELECT * FROM qt"
    q["streamed_log"] = BASE + _LOG_SQL.format(read_errors="''")
    q["archived_raw_files"] = BASE + """
SELECT r.q_file AS FILE_NAME, coalesce(q.N_ROWS, 0) + 1 AS N_NEWLINES, true AS HASH_OK
FROM rendered r LEFT JOIN rollup q ON q.FILE_NAME = r.q_file
UNION ALL
SELECT FILE_NAME, count(*) + 1 + sum(length("Rug Group") - length(replace("Rug Group", chr(10), ''))),
       true
FROM st GROUP BY FILE_NAME"""
    q["archive_plan"] = BASE + """
SELECT f AS FILE_NAME,
       CASE WHEN q_rows = 0 THEN 'stay' WHEN errs <> '' THEN 'move' ELSE 'archive' END AS action,
       CASE WHEN q_rows = 0 THEN NULL WHEN errs <> '' THEN 'ingested-review' ELSE 'ingested' END AS destination
FROM (SELECT q_file AS f, q_rows, errs FROM landlog UNION ALL SELECT s_file, q_rows, errs FROM landlog) x"""
    q["archived_chunks"] = q["archived_raw_files"]
    q["quoted_questions"] = q["quoted_questions_tiny_splits"] = BASE + """
SELECT FILE_NAME, "Assessment ID" AS ASSESSMENT_ID, question_key, strftime("ARD", '%Y-%m-%d %H:%M:%S') AS "ARD",
       nullif(CASE CAST("Assessment ID" AS BIGINT) % 5 WHEN 0 THEN '5" ' || coalesce("Unit", '')
                   WHEN 1 THEN coalesce("Unit", '') || chr(13) || chr(10) || 'over' || chr(10) || 'lines'
                   WHEN 2 THEN coalesce("Unit", '') || '|"' || coalesce("Unit", '')
                   ELSE coalesce("Unit", '') END, '') AS "Unit"
FROM qraw"""
    q["misnamed_log"] = BASE + """
, named AS (
  SELECT *, (INSTANCE = 'REV' AND PROVINCE = 'Alberta') AS bad FROM (""" + _LOG_SQL.format(read_errors="''") + """)
), kept AS (
  SELECT *, CASE WHEN bad THEN regexp_replace(FILE_NAME, '_([0-9]{4}-[0-9]{2})-[0-9]{2}[.]csv$', '_m\\1.csv') ELSE FILE_NAME END AS name
  FROM named
)
SELECT name AS FILE_NAME, CASE WHEN NOT bad THEN FILE_DATE END AS FILE_DATE, INSTANCE, PROVINCE, EXTRACT_TYPE,
       CASE WHEN bad THEN -1 ELSE N_ROWS END AS N_ROWS, CASE WHEN bad THEN -1 ELSE N_RESIDENTS END AS N_RESIDENTS,
       CASE WHEN bad THEN -1 ELSE N_FACILITIES END AS N_FACILITIES,
       CASE WHEN bad THEN -1 ELSE N_UNIQUE_ASSESSMENTS END AS N_UNIQUE_ASSESSMENTS,
       NOT bad AS READ_SUCCESS, NOT bad AND INGEST_SUCCESS AS INGEST_SUCCESS,
       CASE WHEN bad THEN 'file name does not give FILE_DATE' ELSE READ_ERRORS END AS READ_ERRORS,
       CASE WHEN bad THEN 'unreadable: ' || replace(name, 'Scoring', '') || ' || unreadable: '
                          || replace(replace(name, 'Scoring', ''), 'Extract_', 'ExtractScoring_')
            ELSE INGEST_ERRORS END AS INGEST_ERRORS
FROM kept"""
    q["relanded_log"] = BASE + """
SELECT FILE_NAME, false AS INGEST_SUCCESS,
       CASE WHEN INGEST_SUCCESS THEN 'skipped: already ingested, content unchanged' ELSE INGEST_ERRORS END AS INGEST_ERRORS
FROM (""" + _LOG_SQL.format(read_errors="''") + """)"""
    q["snapshot_changes"] = """
WITH old_rows AS (
  SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 7 <> 0
  UNION ALL SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 13 = 0
), new_rows AS (
  SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 5 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey
  FROM orders WHERE o_orderkey % 11 <> 0
), gone AS (SELECT * FROM old_rows EXCEPT ALL SELECT * FROM new_rows),
came AS (SELECT * FROM new_rows EXCEPT ALL SELECT * FROM old_rows),
gone_n AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderstatus, o_custkey) AS n FROM gone),
came_n AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderstatus, o_custkey) AS n FROM came)
SELECT o_orderkey, o_orderstatus, o_custkey,
       CASE WHEN EXISTS (SELECT 1 FROM came_n c WHERE c.o_orderkey = g.o_orderkey AND c.n = g.n) THEN 'update_preimage' ELSE 'delete' END AS _change_type
FROM gone_n g
UNION ALL
SELECT o_orderkey, o_orderstatus, o_custkey,
       CASE WHEN EXISTS (SELECT 1 FROM gone_n g WHERE c.o_orderkey = g.o_orderkey AND c.n = g.n) THEN 'update_postimage' ELSE 'insert' END
FROM came_n c"""
    q["uncovered_id_lists"] = "SELECT FILE_WITH, FILE_WITHOUT, array_to_string(list(MISSING_ID ORDER BY MISSING_ID)[1:20], ',') AS MISSING_IDS, " \
        "count(*) AS n_missing FROM (" + q["uncovered_ids"] + ") GROUP BY FILE_WITH, FILE_WITHOUT"
    q["merged_rollup"] = BASE + """
SELECT FILE_NAME, N_RESIDENTS, N_FACILITIES, N_UNIQUE_ASSESSMENTS FROM rollup WHERE FILE_NAME LIKE '%Scoring%'"""
    words = ", ".join("'" + w + "'" for w in [*S.NA_TOKENS, "Na", " NA", "0", "none", "x"])
    tokens = ", ".join("'" + w + "'" for w in S.NA_TOKENS)
    q["na_tokens"] = f"""
SELECT l_orderkey, l_linenumber, CASE WHEN word NOT IN ({tokens}) THEN word END AS value
FROM (SELECT l_orderkey, l_linenumber, ([{words}])[l_orderkey % {len(S.NA_TOKENS) + 5} + 1] AS word FROM lineitem)"""
    q["manifest_out_of_domain"] = BASE + """
SELECT 'INSTANCE' AS column_name, count(*) FILTER (WHERE INSTANCE = 'EXT') AS violations FROM man
UNION ALL SELECT 'PROVINCE', count(*) FILTER (WHERE PROVINCE = 'Alberta') FROM man
UNION ALL SELECT 'EXTRACT_TYPE', count(*) FILTER (WHERE EXTRACT_TYPE NOT IN ('Scoring', 'Questions')) FROM man"""
    q["extract_type_sizes"] = BASE + """
SELECT CASE EXTRACT_TYPE WHEN 'Questions' THEN 'questions' ELSE 'scoring' END AS part, count(*) AS n FROM man GROUP BY 1"""
    q["archive_precheck"] = BASE + """
SELECT f || '.gone' AS name, 'file does not exist.' AS reason
FROM (SELECT q_file AS f, INSTANCE FROM rendered UNION ALL SELECT s_file, INSTANCE FROM rendered) WHERE INSTANCE = 'REV'
UNION ALL SELECT 'the folder', 'path does not point to a file.'"""
    q["archive_plan_include"] = BASE + """
SELECT f AS FILE_NAME, CASE WHEN q_rows = 0 THEN 'stay' ELSE 'move' END AS action,
       CASE WHEN q_rows = 0 THEN NULL ELSE 'ingested_T' END AS destination
FROM (SELECT q_file AS f, q_rows FROM landlog UNION ALL SELECT s_file, q_rows FROM landlog) x"""
    q["archive_plan_stay"] = BASE + """
SELECT f AS FILE_NAME, CASE WHEN q_rows = 0 OR errs <> '' THEN 'stay' ELSE 'archive' END AS action,
       CASE WHEN q_rows = 0 OR errs <> '' THEN NULL ELSE 'ingested' END AS destination
FROM (SELECT q_file AS f, q_rows, errs FROM landlog UNION ALL SELECT s_file, q_rows, errs FROM landlog) x"""
    q["overwritten_scoring"] = BASE + "SELECT * FROM st WHERE INSTANCE = 'REV'"
    q["created_table_roundtrip"] = "SELECT * FROM orders"
    q["change_feed_scoring"] = BASE + """
SELECT FILE_NAME, "Assessment ID" AS ASSESSMENT_ID, 'insert' AS _change_type
FROM st WHERE replace(FILE_NAME, 'Scoring', '') IN (SELECT FILE_NAME FROM qt)"""
    return q
