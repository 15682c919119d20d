"""Independent SQL (DuckDB dialect) for every registered workload.

Column names equal the Spark workloads'. Integer sums are cast to BIGINT
(DuckDB widens them to HUGEINT) and ratios are computed on DOUBLE.
"""

from __future__ import annotations

# one aggregate with a filter per period
_PART_PERIODS = """
           count(*) FILTER (l_shipdate IS NULL OR l_shipdate < DATE '1998-01-01' OR l_shipdate >= DATE '2002-01-01') AS BeforeCOVIDVotes,
           count(*) FILTER (l_shipdate >= DATE '1998-01-01' AND l_shipdate < DATE '2001-01-01') AS DuringCOVIDVotes,
           count(*) FILTER (l_shipdate >= DATE '2001-01-01' AND l_shipdate < DATE '2002-01-01') AS AfterCOVIDVotes,
           count(*) AS Votes"""

_PRIORITY_COUNTS = """SELECT strftime(o_orderdate, '%Y') AS Year, o_orderpriority AS Name,
                 count(*) AS cnt
          FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2"""

ORACLE_SQL: dict[str, str] = {
    "year_count": """
        SELECT strftime(o_orderdate, '%Y') AS Year, count(*) AS TotalNumber
        FROM orders GROUP BY 1
    """,
    "sql_year_count": """
        SELECT strftime(o_orderdate, '%Y') AS Year, count(*) AS TotalNumber
        FROM orders GROUP BY 1
    """,
    "dirty_dates": """
        WITH t AS (
          SELECT CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'not a date'
                      WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN NULL
                      WHEN o_orderpriority = '5-LOW' THEN ''
                      ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') END AS CreationDate
          FROM orders)
        SELECT strftime(try_strptime(CreationDate, '%Y-%m-%dT%H:%M:%S.%g'), '%Y') AS Year,
               count(*) AS TotalNumber
        FROM t GROUP BY 1
    """,
    "top_owner": """
        SELECT c.c_custkey AS Id, c.c_name AS DisplayName, q.TotalViews
        FROM customer c
        JOIN (SELECT o_custkey,
                     CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS TotalViews
              FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) q
          ON c.c_custkey = q.o_custkey
        ORDER BY q.TotalViews DESC NULLS LAST, Id
        LIMIT 10
    """,
    "topn_ties": """
        SELECT l_orderkey, n_lines
        FROM (SELECT l_orderkey, n_lines, rank() OVER (ORDER BY n_lines DESC) AS rk
              FROM (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey) c) r
        WHERE rk <= 10
    """,
    "argmax_ties": f"""
        WITH c AS ({_PRIORITY_COUNTS})
        SELECT Year, Name, MaxPercentage
        FROM (SELECT Year, Name,
                     CAST(cnt AS DOUBLE) / CAST(sum(cnt) OVER (PARTITION BY Year) AS DOUBLE) AS MaxPercentage,
                     rank() OVER (PARTITION BY Year ORDER BY cnt DESC) AS rk
              FROM c) r
        WHERE rk = 1
    """,
    "argmax_one": f"""
        WITH c AS ({_PRIORITY_COUNTS})
        SELECT Year, Name, MaxPercentage
        FROM (SELECT Year, Name,
                     CAST(cnt AS DOUBLE) / CAST(sum(cnt) OVER (PARTITION BY Year) AS DOUBLE) AS MaxPercentage,
                     row_number() OVER (PARTITION BY Year ORDER BY cnt DESC, Name ASC NULLS FIRST) AS rn
              FROM c) r
        WHERE rn = 1
    """,
    "argmax_join": f"""
        WITH c AS ({_PRIORITY_COUNTS}),
             t AS (SELECT Year, max(cnt) AS mx, sum(cnt) AS total FROM c GROUP BY Year)
        SELECT c.Year, c.Name, CAST(c.cnt AS DOUBLE) / CAST(t.total AS DOUBLE) AS MaxPercentage
        FROM c JOIN t ON c.Year = t.Year AND c.cnt = t.mx
    """,
    "window_share": """
        WITH c AS (SELECT strftime(ts, '%Y-%m-%d') AS Day, event_type, count(*) AS Count
                   FROM events WHERE ts IS NOT NULL GROUP BY 1, 2)
        SELECT Day, event_type, Count,
               CAST(Count AS DOUBLE) / CAST(sum(Count) OVER (PARTITION BY Day) AS DOUBLE) AS Share
        FROM c
    """,
    "child_score": """
        SELECT o.o_orderkey, o.o_orderpriority, o.o_totalprice, s.CommentsTotalScore,
               c.c_name, c.c_acctbal, c.c_mktsegment
        FROM (SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS CommentsTotalScore
              FROM lineitem GROUP BY l_orderkey) s
        JOIN orders o ON o.o_orderkey = s.l_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        WHERE o.o_orderstatus = 'F'
        ORDER BY s.CommentsTotalScore DESC NULLS LAST, o.o_orderkey
        LIMIT 10
    """,
    "period_pivot": f"""
        SELECT p_name AS Title, v.*
        FROM part JOIN (SELECT l_partkey AS PostId, {_PART_PERIODS}
                        FROM lineitem WHERE l_returnflag = 'A' OR l_returnflag = 'R' GROUP BY l_partkey) v
          ON p_partkey = PostId
        WHERE p_name <> '' AND DuringCOVIDVotes > 0
        ORDER BY DuringCOVIDVotes DESC, Votes DESC, PostId LIMIT 20
    """,
    "period_labels": f"SELECT l_partkey AS PostId, {_PART_PERIODS} FROM lineitem GROUP BY l_partkey",
    "having_min": """
        SELECT l_partkey, count(*) AS n_lines
        FROM lineitem WHERE l_returnflag IN ('A', 'R')
        GROUP BY l_partkey HAVING count(*) > 25
    """,
    "full_outer": """
        SELECT nullif(l_suppkey, 0) AS l_suppkey,
               count(*) FILTER (l_shipdate < TIMESTAMP '1995-03-01') AS EarlyLines,
               count(*) FILTER (l_shipdate >= TIMESTAMP '1995-03-01' AND l_shipdate < TIMESTAMP '2001-06-01') AS MiddleLines,
               count(*) FILTER (l_shipdate >= TIMESTAMP '2001-06-01') AS LateLines, count(*) AS TotalLines
        FROM lineitem GROUP BY 1
    """,
    "left_join": """
        SELECT d.source, count(*) AS n_docs, count(l.doc_id) AS n_labelled,
               CAST(sum(l.quality) AS BIGINT) AS quality_sum
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        GROUP BY d.source
    """,
    "null_group": """
        SELECT nullif(o_orderpriority, '5-LOW') AS priority, count(*) AS n_rows,
               count(nullif(o_orderpriority, '5-LOW')) AS n_nonnull
        FROM orders GROUP BY 1
    """,
    "allnull_sum": """
        SELECT o_orderpriority,
               CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END) AS BIGINT) AS total
        FROM orders GROUP BY 1
    """,
    "null_key_join": """
        SELECT count(*) AS n
        FROM orders o JOIN customer c ON nullif(o.o_custkey, 0) = nullif(c.c_custkey, 0)
    """,
    "nullsafe_join": """
        SELECT count(*) AS n
        FROM orders o JOIN customer c
          ON nullif(o.o_custkey, 0) IS NOT DISTINCT FROM nullif(c.c_custkey, 0)
    """,
    "nullsafe_rows": """
        SELECT c_custkey, nullif(c_nationkey, 0) AS c_nation, s_suppkey
        FROM customer JOIN supplier
          ON c_custkey = s_suppkey AND nullif(c_nationkey, 0) IS NOT DISTINCT FROM nullif(s_nationkey, 0)
    """,
    "top_owner_ties": """
        WITH n AS (SELECT nullif(o_custkey, 7) AS k, count(*) AS Questions FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
             j AS (SELECT nullif(c_custkey, 7) AS Id, c_name AS DisplayName, Questions
                   FROM customer JOIN n ON nullif(c_custkey, 7) IS NOT DISTINCT FROM k)
        SELECT Id, DisplayName, Questions FROM j QUALIFY rank() OVER (ORDER BY Questions DESC) <= 10
    """,
    "child_score_ties": """
        WITH n AS (SELECT l_orderkey, count(*) AS Lines FROM lineitem GROUP BY l_orderkey)
        SELECT o_orderkey, o_orderpriority, Lines, c_name
        FROM n JOIN orders ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
        WHERE o_orderstatus = 'F' QUALIFY rank() OVER (ORDER BY Lines DESC) <= 10
    """,
    "allnull_filled": """
        SELECT o_orderpriority, CAST(coalesce(sum(o_orderkey) FILTER (o_orderpriority <> '5-LOW'), 0) AS BIGINT) AS total
        FROM orders GROUP BY o_orderpriority
    """,
    "not_in_empty": """
        SELECT count(*) AS n
        FROM (SELECT CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '1-URGENT' THEN ''
                          ELSE o_orderpriority END AS p
              FROM orders) t
        WHERE p NOT IN ('')
    """,
    "union": """
        SELECT tag, value, count(*) AS n
        FROM (SELECT 'orders' AS tag, o_orderstatus AS value FROM orders
              UNION ALL
              SELECT 'lineitem' AS tag, l_returnflag AS value FROM lineitem) u
        GROUP BY 1, 2
    """,
    "table_diff": """
        SELECT key, CAST(sum(l) AS BIGINT) AS n_left, CAST(sum(r) AS BIGINT) AS n_right
        FROM (SELECT o_custkey AS key, 1 AS l, 0 AS r FROM orders
              UNION ALL
              SELECT c_custkey AS key, 0 AS l, 1 AS r FROM customer) u
        GROUP BY key
        HAVING sum(l) <> sum(r)
    """,
    "table_diff_by_key": """
        WITH c AS (SELECT c_custkey AS key, c_custkey % 97 = 0 AS moved, c_nationkey IS NOT DISTINCT FROM 3 AS gone,
                          c_nationkey IS NOT DISTINCT FROM 4 AND c_mktsegment <> 'RENAMED' AS renamed FROM customer)
        SELECT key, CAST(1 AS BIGINT) AS n_left, CAST(CASE WHEN gone THEN 0 ELSE 1 END AS BIGINT) AS n_right,
               CASE WHEN gone THEN '' ELSE concat_ws(',', CASE WHEN renamed THEN 'c_mktsegment' END, CASE WHEN moved THEN 'balance' END) END AS differing
        FROM c WHERE gone OR moved OR renamed
    """,
    "csv_roundtrip": "SELECT * FROM documents",
    "csv_roundtrip_events": "SELECT * FROM events",
    "parquet_roundtrip": "SELECT * FROM events",
}
ORACLE_SQL["stream_year_count"] = ORACLE_SQL["year_count"]
ORACLE_SQL["stream_argmax_one"] = ORACLE_SQL["argmax_one"]
