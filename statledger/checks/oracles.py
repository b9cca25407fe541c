"""The registered queries in plain SQL over the same tables."""

from __future__ import annotations

from .roles import EVENTS_AT, SALES_AT

EV, SA = f"TIMESTAMP '{EVENTS_AT}'", f"TIMESTAMP '{SALES_AT}'"
WEEK = "INTERVAL 596160 SECOND"  # 6.9 days


def _yw(c: str) -> str:
    week = f"((dayofyear({c}) + dayofweek(date_trunc('year', {c})) - 1) // 7) + 1"
    return f"CAST(year({c}) AS VARCHAR) || '.' || lpad(CAST({week} AS VARCHAR), 2, '0')"


def _key(c: str) -> str:
    return f"CAST(strftime({c}, '%Y%m%d') AS INTEGER)"


def _window(c: str, at: str, span: str = WEEK) -> str:
    return f"{c} > {at} - {span} AND {c} <= {at}"


def _pct(part: str, total: str) -> str:
    cut = f"CAST({part} AS HUGEINT) * 1000000 // CAST({total} AS HUGEINT)"
    return f"CAST(({cut} + 50) // 100 AS DOUBLE) / 100"


def _bucket(mean: str) -> tuple[str, str]:
    label = f"CASE WHEN {mean} < 1000000 THEN '1 Sec' WHEN {mean} < 5000000 THEN '5 Sec' WHEN {mean} < 30000000 THEN '30 Sec' ELSE '> 30 Sec' END"
    order = f"CASE WHEN {mean} < 1000000 THEN 1 WHEN {mean} < 5000000 THEN 2 WHEN {mean} < 30000000 THEN 3 ELSE 4 END"
    return label, order


def _bounds(source: str, keys: str, value: str) -> str:
    return (
        f"SELECT {keys}, CAST(sum({value}) // count({value}) AS BIGINT) AS m, stddev_pop({value}) AS sd, count(*) AS n "
        f"FROM {source} GROUP BY {keys} HAVING count(*) > 1"
    )


def _bound_columns(digits: int, alias: str = "b") -> str:
    a = f"{alias}." if alias else ""
    return (
        f'{a}m AS "Mean", round({a}sd, {digits}) AS "StandardDev", round({a}m - 3 * {a}sd, {digits}) AS "LowerBound", '
        f'round({a}m + 3 * {a}sd, {digits}) AS "UpperBound", {a}n AS "SampleSize"'
    )


_PART_DB = "CASE WHEN {k} % 5 = 0 THEN 'tempdb' ELSE 'db_' || ({k} % 5) END"
_STAMP = f"{SA} - to_days(CAST(l_orderkey % 10 AS INTEGER))"
_LINE_TABLE = f"{_PART_DB.format(k='l_partkey')} AS \"DB_Name\", 'part_' || l_partkey AS \"Table_Name\""
_OBJECT = "'obj_' || (p_partkey // 2)"


def _flag(flag: str, factor: int = 10) -> str:
    return f"CAST(CASE WHEN l_returnflag = '{flag}' THEN l_quantity * {factor} ELSE 0 END AS BIGINT)"


# Fixed values in the statements below: bucket labels and the command texts that the maintenance procedure expects.

# The sample tables in their roles.
CTE = {
    "jobs": """SELECT event_type AS "JobName", CASE WHEN user_id % 10 = 9 THEN 1 ELSE 0 END AS "JobFailStep",
        ts AS "RunDateTime", CAST(floor(value * 100) AS INTEGER) AS "JobDurationSeconds",
        CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END AS "RunStatus", 'owner_' || (user_id % 3) AS owner,
        CASE WHEN user_id % 2 = 0 THEN 'SQLAgent' ELSE 'SSIS' END AS source, ts AS "Date" FROM events""",
    "runs": """SELECT *, e // c AS a FROM (SELECT 'db_' || l_returnflag AS "DB_Name", 'sp_' || l_suppkey AS "SP Name",
        CAST(l_quantity AS BIGINT) AS c,
        CAST(floor(l_extendedprice * 100) AS BIGINT) * l_linenumber * l_linenumber * l_linenumber AS e,
        date_trunc('month', l_shipdate) AS cached_time, CAST(floor(l_extendedprice) AS BIGINT) AS lr,
        CAST(l_quantity AS BIGINT) * l_linenumber AS lw, l_shipdate AS "Date" FROM lineitem)""",
    "usage": f"""SELECT {_LINE_TABLE}, CASE WHEN l_linenumber < 7 THEN 'ix_' || l_suppkey END AS "Index_Name",
        {_flag('R')} AS user_seeks, {_flag('A')} AS user_scans,
        CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_quantity ELSE 0 END AS BIGINT) AS user_lookups,
        {_flag('N')} AS user_updates, CASE WHEN l_linenumber = 1 THEN 'CLUSTERED' ELSE 'NONCLUSTERED' END AS type_desc,
        l_linenumber * 10 AS fill_factor, l_linenumber = 1 AS is_primary_key, l_shipdate AS "Date" FROM lineitem""",
    "sizes": f"""SELECT {_PART_DB.format(k='p_partkey')} AS db, '[dbo].[part_' || p_partkey || ']' AS full_name,
        'part_' || p_partkey AS tbl,
        CAST(floor(p_retailprice * 100) AS BIGINT) + w * (p_partkey % 4) * 50 AS "RowCount",
        {SA} - to_days(CAST(2 + 4 * w + p_partkey % 3 AS INTEGER)) AS "Date"
        FROM part, generate_series(0, 2) AS g(w)""",
    "used": f"""SELECT "DB_Name" AS db, "Table_Name" AS tbl, CAST(sum(user_seeks + user_scans + user_updates) AS BIGINT) AS acc,
        CAST(sum(user_updates) AS BIGINT) AS wr, CAST(sum(user_seeks + user_scans) AS BIGINT) AS rd,
        CAST(sum(user_seeks) AS BIGINT) AS sk, CAST(sum(user_scans) AS BIGINT) AS sc, {SA} - INTERVAL 1 DAY AS "Date"
        FROM usage WHERE "Date" <= {SA} GROUP BY 1, 2 HAVING sum(user_seeks + user_scans) > 0""",
    "sized": f"""SELECT u.db, u.tbl, s."RowCount", u.acc, u.rd, u.sc, u."Date" FROM used u JOIN sizes s USING (db, tbl)
        WHERE {_window('s."Date"', SA)} AND {_window('u."Date"', SA)}""",
    "stats": f"""SELECT {_LINE_TABLE}, CASE WHEN l_linenumber = 7 THEN '_WA_' ELSE 'ix_' END || l_suppkey AS "Index_Name",
        l_shipdate AS "LastUpdateDate", CAST(floor(l_extendedprice * 10) AS BIGINT) AS rowmodctr, {_STAMP} AS "Date"
        FROM lineitem""",
    "frag": f"""SELECT {_LINE_TABLE}, 'ix_' || l_suppkey AS "Index_Name", round(l_discount * 1000) AS f,
        {_STAMP} AS "Date", CAST(l_quantity AS BIGINT) AS page_count FROM lineitem""",
    "space": f"""SELECT {_LINE_TABLE}, l_linenumber AS "IndexID", 'ix_' || l_suppkey AS "IndexName", l_linestatus AS "Type",
        CAST(floor(l_extendedprice / 100) AS INTEGER) AS "Total_MBs", CAST(l_quantity * 2 AS INTEGER) AS "Free_Space_MBs",
        round(l_tax * 1000) AS "Free_Space_Percent", {_STAMP} AS "Date" FROM lineitem""",
    "stale": f"""SELECT z.db AS "DBName", z.tbl AS "TableName", z."RowCount", s."Index_Name" AS "IndexName", s."LastUpdateDate",
        CAST(s.rowmodctr AS DOUBLE) AS rowmodctr, CAST(z.acc AS DOUBLE) AS "TotalAccesses", CAST(z.rd AS DOUBLE) AS "TotalReads",
        CAST(z.sc AS DOUBLE) AS "ReadScans", z."Date",
        'UPDATE STATISTICS ' || z.tbl || '(' || s."Index_Name" || ') WITH FULLscan' AS "RebuildState"
        FROM sized z JOIN stats s ON s."DB_Name" = z.db AND s."Table_Name" = z.tbl
        WHERE {_window('s."Date"', SA)} AND s."Index_Name" IS NOT NULL AND z."RowCount" > 5000 AND z.acc > 5000
        AND s.rowmodctr > 5000 AND s."LastUpdateDate" < {SA} - INTERVAL 7 DAY
        ORDER BY z."RowCount", 1, 2, 4, 5, 6, 7, 8, 9, 10 LIMIT 1000""",
    "fragtop": f"""SELECT f."DB_Name" AS "DBName", f."Table_Name" AS "TableName", f."Index_Name" AS "IndexName",
        f.f AS "Avg_Fragmentation", f."Date", f.page_count, CAST(t.acc AS DOUBLE) AS "TotalAccesses",
        CAST(t.rd AS DOUBLE) AS "TotalReads", CAST(t.sc AS DOUBLE) AS "ReadScans",
        'ALTER INDEX [' || f."Index_Name" || '] ON [dbo].[' || f."Table_Name" || '] REBUILD with (ONLINE = ON)' AS "Rebuild"
        FROM frag f JOIN (SELECT * FROM used WHERE {_window('"Date"', SA)} ORDER BY acc DESC, db, tbl LIMIT 100) t
        ON t.db = f."DB_Name" AND t.tbl = f."Table_Name"
        WHERE {_window('f."Date"', SA)} AND f.f > 30 AND f.page_count > 8""",
    "spacious": f"""SELECT s."DB_Name" AS "DBName", s."Table_Name" AS "TableName", s."IndexID", s."IndexName", s."Type",
        s."Total_MBs", s."Free_Space_MBs", s."Free_Space_Percent", z."RowCount" AS "TableRowCount",
        CAST(z.acc AS DOUBLE) AS "TotalAccesses", s."Date",
        'ALTER INDEX [' || s."IndexName" || '] ON [dbo].[' || s."Table_Name" || '] REBUILD with (ONLINE = ON)' AS "Rebuild"
        FROM space s LEFT JOIN sized z ON z.db = s."DB_Name" AND z.tbl = s."Table_Name"
        WHERE {_window('s."Date"', SA)} AND (s."Free_Space_MBs" > 50 OR s."Free_Space_Percent" > 50)""",
    "io": """SELECT CAST(l_suppkey % 25 AS INTEGER) AS ser, l_suppkey AS db, l_returnflag AS drive, 'file_' || l_linenumber AS file,
        CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END AS BIGINT) AS nr,
        CAST(CASE WHEN l_returnflag <> 'R' THEN l_quantity * 3 ELSE 0 END AS BIGINT) AS nw,
        CAST(floor(l_extendedprice) AS BIGINT) AS mr, CAST(floor(l_tax * 100) AS BIGINT) AS mw,
        CAST(floor(l_extendedprice * 100) AS BIGINT) AS sr, CAST(floor(o_totalprice * 100) AS BIGINT) AS sw,
        o_orderdate AS t0, l_shipdate AS t1, s_name AS dbname, 'server_' || (s_suppkey % 25) AS srv
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey""",
    "batch": """SELECT user_id, ts, c, CASE WHEN p IS NULL OR c < p THEN 0 ELSE date_diff('second', pt, ts) END AS s,
        CASE WHEN p IS NULL THEN 0 WHEN c < p THEN p ELSE c - p END AS r FROM (
        SELECT user_id, ts, event_id * 13 % 5000 AS c, lag(event_id * 13 % 5000) OVER w AS p, lag(ts) OVER w AS pt
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""",
    "io_delta": """SELECT *, CASE WHEN same AND n >= p THEN 10 * (n - p) ELSE 10 * n END AS nr,
        CASE WHEN same AND n >= p THEN 3 * (n - p) ELSE 3 * n END AS nw,
        CASE WHEN same AND n >= p THEN 2 * (n - p) ELSE 2 * n END AS mr,
        CASE WHEN same AND n >= p THEN n - p ELSE n END AS mw,
        CASE WHEN same AND n * n % 1000003 >= p * p % 1000003 THEN n * n % 1000003 - p * p % 1000003
        ELSE n * n % 1000003 END AS sr, CASE WHEN same AND n >= p THEN 5 * (n - p) ELSE 5 * n END AS sw,
        CASE WHEN same THEN pt ELSE wk END AS t0 FROM (
        SELECT user_id, event_id AS n, ts, date_trunc('week', ts) AS wk, lag(event_id) OVER w AS p, lag(ts) OVER w AS pt,
        coalesce(date_trunc('week', lag(ts) OVER w) = date_trunc('week', ts), false) AS same
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""",
    "agent": f"""SELECT substr(c_name, 1, 60) AS "JobName", CAST(n % 3 AS INTEGER) AS "JobFailStep",
        substr('Priority ' || o_orderpriority || ' asked by customer number ' || c_custkey, 1, 45) AS "JobFailMessage",
        date_trunc('day', o_orderdate) + to_seconds(n % 24 * 3600 + n % 60 * 60 + n * 7 % 60) AS "RunDateTime",
        CAST(n % 130 * 3600 + n % 60 * 60 + n * 3 % 60 AS INTEGER) AS "JobDurationSeconds",
        CAST(n % 2 AS INTEGER) AS "RunStatus", CAST(NULL AS VARCHAR) AS owner, 'SQLAgent' AS source, {SA} AS "Date"
        FROM (SELECT *, o_orderkey AS n FROM orders) JOIN customer ON c_custkey = o_custkey
        WHERE date_trunc('day', o_orderdate) + to_seconds(n % 24 * 3600 + n % 60 * 60 + n * 7 % 60)
        + to_seconds(n % 130 * 3600 + n % 60 * 60 + n * 3 % 60) >= {SA} - INTERVAL 365 DAY""",
    "report": f"""SELECT '/' || event_type AS "JobName", 1 AS "JobFailStep", props AS "JobFailMessage", ts AS "RunDateTime",
        CAST((CAST(floor(value * 100) AS BIGINT) + event_id % 1000 + user_id) // 1000 AS INTEGER) AS "JobDurationSeconds",
        CASE WHEN user_id % 5 = 0 THEN 0 ELSE 1 END AS "RunStatus", 'user_' || user_id AS owner, 'SSRS' AS source,
        {EV} AS "Date" FROM events WHERE {_window('ts', EV, 'INTERVAL 7 DAY')}""",
    "etl": f"""SELECT 'Package.' || l_linenumber AS "JobName", 1 AS "JobFailStep", '' AS "JobFailMessage",
        l_shipdate AS "RunDateTime", CAST(CAST(floor(l_extendedprice * 10) AS BIGINT) // 1000 AS INTEGER) AS "JobDurationSeconds",
        CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE 0 END AS "RunStatus", CAST(NULL AS VARCHAR) AS owner, 'SSIS' AS source,
        {SA} AS "Date" FROM lineitem WHERE {_window('l_shipdate', SA, 'INTERVAL 30 DAY')}""",
    "objs": f"""SELECT p_partkey AS k, 'db_' || (p_partkey % 5) AS db, p_type AS schema_name, {_OBJECT} AS name,
        p_size, TIMESTAMP '2000-01-01' + to_days(CAST(p_partkey % 300 AS INTEGER)) AS cd,
        TIMESTAMP '2001-01-01' + to_days(CAST(p_partkey % 100 AS INTEGER)) AS md FROM part""",
    "plans": """SELECT CASE WHEN l_linenumber < 7 THEN o.db END AS db, o.schema_name, o.name, CAST(l_quantity AS BIGINT) AS uses
        FROM lineitem JOIN objs o ON o.k = l_partkey WHERE l_linestatus = 'F' AND l_linenumber < 7""",
    "buf": """SELECT 'db_' || (l_suppkey % 5) AS db, l_suppkey AS supp, l_linenumber % 2 AS half,
        coalesce(CASE WHEN l_linenumber <> 3 THEN l_returnflag = 'R' END, false) AS dirty,
        CAST(floor(l_extendedprice) AS BIGINT) % 8096 AS free FROM lineitem""",
    "limits": """SELECT 'db_' || (user_id % 5) AS db, c_name AS sp, CAST(sum(v) // count(v) AS BIGINT) AS m, stddev_pop(v) AS sd,
        count(*) AS n FROM (SELECT user_id, CAST(floor(value * 100) AS BIGINT) AS v FROM events)
        JOIN customer ON c_custkey = user_id GROUP BY 1, 2 HAVING count(*) > 1""",
    "recent": f"""SELECT DISTINCT 'db_' || (user_id % 5) AS db, c_name AS sp, CAST(floor(value * 100) AS BIGINT) AS v, ts
        FROM events JOIN customer ON c_custkey = user_id
        WHERE user_id % 5 >= 1 AND ts >= {EV} - INTERVAL 30 DAY AND ts <= {EV} AND c_mktsegment <> 'MACHINERY'""",
    "slow": "SELECT r.*, m, sd, n FROM recent r JOIN limits USING (db, sp) WHERE v > 1000 AND v > m + 3 * sd",
    "flagged": "SELECT sp FROM slow GROUP BY sp HAVING count(*) > 1",
    "tcand": f"""SELECT "DBName", "TableName" FROM spacious WHERE {_window('"Date"', SA)}
        UNION SELECT "DBName", "TableName" FROM fragtop UNION SELECT "DBName", "TableName" FROM stale
        UNION SELECT db, tbl FROM (SELECT * FROM sized ORDER BY rd DESC, db, tbl, "RowCount", "Date" LIMIT 100)
        UNION SELECT db, tbl FROM (SELECT * FROM sized ORDER BY sc DESC, db, tbl, "RowCount", "Date" LIMIT 100)""",
    "icand": f"""SELECT "DB_Name" AS "DBName", "Table_Name" AS "TableName", "Index_Name" AS "IndexName" FROM (
        SELECT * FROM usage WHERE {_window('"Date"', SA)}
        ORDER BY user_seeks + user_scans + user_lookups + user_updates DESC, "DB_Name", "Table_Name", "Index_Name" NULLS FIRST,
        "Date" LIMIT 50) UNION SELECT "DBName", "TableName", "IndexName" FROM spacious
        WHERE {_window('"Date"', SA)}""",
    "newest": f"""SELECT db, tbl, arg_max("RowCount", "Date") AS rc FROM sizes WHERE {_window('"Date"', SA)} GROUP BY 1, 2""",
    "tcut": """SELECT c.*, rc FROM tcand c LEFT JOIN newest ON db = "DBName" AND tbl = "TableName"
        WHERE rc IS NULL OR rc <= 100000""",
    "commands": """SELECT "DBName", "TableName", 'table' AS level, 'EXECUTE [master].[dbo].[IndexOptimize] @Databases = ['
        || "DBName" || '], @Indexes = ''' || "DBName" || '.dbo.' || "TableName"
        || ''',@PageCountLevel=8,@TimeLimit = 900, @MaxDOP = ''2'',@FragmentationMedium = ''INDEX_REBUILD_ONLINE,INDEX_REORGANIZE'', '
        || '@FragmentationHigh = ''INDEX_REBUILD_ONLINE,INDEX_REORGANIZE'',@UpdateStatistics = ''ALL'', '
        || '@OnlyModifiedStatistics = ''Y'', @LogToTable = ''Y''' AS "Command" FROM tcut WHERE rc < 100000
        UNION SELECT i."DBName", i."TableName", 'index', 'EXECUTE [master].[dbo].[IndexOptimize] @Databases = ['
        || i."DBName" || '], @Indexes = ''' || i."DBName" || '.dbo.' || i."TableName" || '.[' || i."IndexName" || ']'
        || ''',@PageCountLevel=8,@TimeLimit = 900, @MaxDOP = ''2'',@FragmentationMedium = ''INDEX_REBUILD_ONLINE,INDEX_REORGANIZE'', '
        || '@FragmentationHigh = ''INDEX_REBUILD_ONLINE,INDEX_REORGANIZE'', @LogToTable = ''Y'''
        FROM icand i JOIN newest ON db = i."DBName" AND tbl = i."TableName" LEFT JOIN tcut t
        ON t."DBName" = i."DBName" AND t."TableName" = i."TableName"
        WHERE t."DBName" IS NULL AND rc_of(newest) < 3000000 AND i."IndexName" IS NOT NULL""".replace(
        "rc_of(newest)", "newest.rc"
    ),
    "modified": f"""SELECT DISTINCT s."DB_Name" AS "Database_Name", s."Table_Name", s."Index_Name", s."LastUpdateDate", s.rowmodctr,
        z."RowCount", u.acc, u.rd, s.rowmodctr * 100 // z."RowCount" AS pct FROM stats s
        JOIN sizes z ON z.db = s."DB_Name" AND z.tbl = s."Table_Name" JOIN used u ON u.db = z.db AND u.tbl = z.tbl
        WHERE s.rowmodctr > 0 AND left(s."Index_Name", 1) <> '_' AND z."RowCount" > 1 AND {_window('z."Date"', SA)}
        AND {_window('u."Date"', SA)}""",
    "refresh": """SELECT DISTINCT "Database_Name", "Table_Name",
        'UPDATE STATISTICS [' || "Table_Name" || '](' || "Index_Name" || ') WITH FULLSCAN' AS "Command" FROM modified
        WHERE (pct > 400 OR rowmodctr > 450000) AND "RowCount" < 45000000""",
    "lockrows": f"""SELECT CAST(user_id AS INTEGER) AS spid, CAST(event_id % 5 AS INTEGER) AS dbid,
        CAST(event_id % 97 AS INTEGER) AS "objId", CAST(event_id % 3 AS INTEGER) AS "indId", 'KEY' AS "Type",
        event_type AS resource, 'X' AS "Mode", 'GRANT' AS status, q.b AS blocking_session_id, q.text, s.host_name,
        s.program_name, s.login_name, s.login_time, {EV} AS "DateTime" FROM events
        LEFT JOIN (SELECT c_custkey, CAST(c_custkey % 7 AS INTEGER) AS b, 'exec ' || n_name AS text FROM customer
        JOIN nation ON n_nationkey = c_nationkey WHERE c_mktsegment IN ('BUILDING', 'FURNITURE') AND n_regionkey < 4) q
        ON q.c_custkey = user_id
        LEFT JOIN (SELECT c_custkey, c_mktsegment AS host_name, 'app' AS program_name, c_name AS login_name,
        TIMESTAMP '2024-01-01 08:00:00' AS login_time FROM customer WHERE c_acctbal > 0) s ON s.c_custkey = user_id""",
}

CTE["current_stats"] = f"""SELECT * FROM stats WHERE {_window('"Date"', SA)}"""
CTE["current_modified"] = CTE["modified"].replace("FROM stats s", "FROM current_stats s")
CTE["current_refresh"] = CTE["refresh"].replace("FROM modified", "FROM current_modified")
CTE["fleet"] = "SELECT jobs.*, r_name AS server_name FROM jobs JOIN region ON owner = 'owner_' || r_regionkey"

_NEEDS = {
    "fleet": ["jobs"],
    "used": ["usage"], "sized": ["sizes", "used"], "stale": ["sized", "stats"], "fragtop": ["frag", "used"],
    "spacious": ["space", "sized"], "plans": ["objs"], "slow": ["recent", "limits"], "flagged": ["slow"],
    "tcand": ["spacious", "fragtop", "stale", "sized"], "icand": ["usage", "spacious"], "newest": ["sizes"],
    "tcut": ["tcand", "newest"], "commands": ["tcut", "icand"], "modified": ["stats", "sizes", "used"],
    "refresh": ["modified"], "current_stats": ["stats"], "current_modified": ["current_stats", "sizes", "used"],
    "current_refresh": ["current_modified"],
}


def _with(body: str, *names: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in order) + "\n" + body if order else body


_JK = '"JobName", "JobFailStep", "RunStatus", source'
_ON_JOB = " AND ".join(f"f.{k} = b.{k}" for k in ['"JobName"', '"JobFailStep"', '"RunStatus"', "source"])
_JOB_OUT = f"""SELECT f.*, {_bound_columns(6)}, strftime(f."RunDateTime", '%Y-%m-%d') AS "DateOnly",
    CAST(hour(f."RunDateTime") AS INTEGER) AS "Hour" FROM (SELECT {_JK}, "JobDurationSeconds", "RunDateTime" FROM jobs
    WHERE "JobDurationSeconds" > 3 AND {_window('"RunDateTime"', EV, 'INTERVAL 35 DAY')}) f
    JOIN ({_bounds(f'(SELECT * FROM jobs WHERE "RunDateTime" <= {EV})', _JK, '"JobDurationSeconds"')}) b ON {_ON_JOB}
    WHERE f."JobDurationSeconds" NOT BETWEEN b.m - 3 * b.sd AND b.m + 3 * b.sd"""


def _routine_out(days: int) -> str:
    return f"""SELECT f.*, {_bound_columns(2)}, strftime(f."Date", '%Y-%m-%d') AS "DateOnly"
    FROM (SELECT "DB_Name", "SP Name", a AS avg_elapsed_time, "Date" FROM runs
    WHERE a > 3 AND {_window('"Date"', SA, f'INTERVAL {days} DAY')}) f
    JOIN ({_bounds(f'(SELECT * FROM runs WHERE "Date" <= {SA})', '"DB_Name", "SP Name"', 'a')}) b
    ON f."DB_Name" = b."DB_Name" AND f."SP Name" = b."SP Name"
    WHERE f.avg_elapsed_time NOT BETWEEN b.m - 3 * b.sd AND b.m + 3 * b.sd"""


_CARRIED = ", ".join(f'max("{c}") AS "{c}"' for c in ("Mean", "StandardDev", "LowerBound", "UpperBound", "SampleSize"))
_WLABEL, _WORDER = _bucket("(sum(e) // sum(c))")
_DLABEL, _DORDER = _bucket("a")

MEMORY_ZERO = [
    "Total_Physical_Memory_KB", "Total_Physical_Memory_KB_Available", "Total_Virtual_Memory_KB",
    "Total_Virtual_Memory_KB_Available", "Total_Page_File_Memory_KB", "Total_Page_File_Memory_KB_Available",
    "Total_System_Cache_Memory_KB_Available", "Mem_Used_KB_Maintaining_Connections", "Mem_Used_KB_Locks",
    "Mem_Used_KB_Dynamic_Cache", "Mem_Used_KB_Query_Optimization", "Mem_Used_KB_Hash_Sort_Index_Operations",
    "Mem_Used_KB_Cursors", "Mem_Used_KB_SQLServer", "Locked_Pages_Used_SQLServer_KB", "Total_VAS_KB",
    "Memory_Grants_Pending", "Free_List_Stalls_Per_Sec", "Checkpoint_Pages_Per_Sec",
]
MEMORY_FALSE = [
    "System_High_Memory_Signal_State", "System_Low_Memory_Signal_State", "Process_Physical_Memory_Low",
    "Process_Virtual_Memory_Low",
]
MEMORY_BYTES = {
    "Total_Physical_Memory_KB": ("signup", "CAST(floor(value * 100) AS BIGINT) * 1000 // 8192"),
    "Total_Virtual_Memory_KB": ("click", "CAST(floor(value * 100) AS BIGINT) * 1000 // 8192"),
    "Mem_Needed_KB_Per_Current_Workload": ("view", "CAST(floor(value * 100) AS BIGINT) * 1000"),
    "Lazy_Writes_Per_Sec": ("error", "CAST(floor(value * 100) AS BIGINT) * 1000"),
}
_SERVER_DAY = "'server_' || (user_id % 5) AS server_name, strftime(ts, '%Y-%m-%d') AS day"


def _rates(where: str) -> str:
    return f"""SELECT c_name AS name, user_id AS id, wk AS start_time, CAST(event_id % 6 AS INTEGER) AS runstatus, ts AS time,
    CAST(d AS INTEGER) AS delivered_commands, CAST(s AS INTEGER) AS seconds, CAST(k AS INTEGER) AS commands,
    CAST(CASE WHEN s > 0 THEN (k * 100) // ((s * 100) // 60) ELSE 0 END AS INTEGER) AS "commands_per_Minute",
    {_key('ts')} AS "DateKey", CAST(hour(ts) AS INTEGER) AS "Hour", CAST(minute(ts) AS INTEGER) AS "Minute" FROM (
    SELECT *, CASE WHEN pw = wk THEN date_diff('second', pt, ts) ELSE 0 END AS s,
    CASE WHEN pw = wk AND d > p THEN d - p ELSE 0 END AS k FROM (
    SELECT user_id, event_id, ts, event_id % 3000 AS d, date_trunc('week', ts) AS wk, lag(event_id % 3000) OVER w AS p,
    lag(ts) OVER w AS pt, date_trunc('week', lag(ts) OVER w) AS pw, lead(ts) OVER w AS nx
    FROM events WHERE event_id % 3000 > 0 {where} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id % 3000))
    WHERE nx IS NOT NULL) JOIN customer ON c_custkey = user_id"""


_SPACE_SUMS = """CAST(count(*) FILTER (dirty) AS BIGINT) AS "DPCount", CAST(count(*) FILTER (NOT dirty) AS BIGINT) AS "CPCount",
    CAST(coalesce(sum(free) FILTER (dirty), 0) AS BIGINT) AS "DPFreeSpace",
    CAST(coalesce(sum(free) FILTER (NOT dirty), 0) AS BIGINT) AS "CPFreeSpace", count(*) AS pages, CAST(sum(free) AS BIGINT) AS fb"""
_SPACE_OUT = """CAST(pages * 8 // 1024 AS INTEGER) AS "Total_MBs", CAST(fb // 1048576 AS INTEGER) AS "Free_Space_MBs",
    CAST((2000 * (fb // 1024) + pages * 8) // (2 * pages * 8) AS DOUBLE) / 10 AS "Free_Space_Percent" """
_INDEXED = "l_linenumber <= 1 + l_partkey % 5"
_LDB = "'db_' || (l_partkey % 5)"
_LOBJ = "'obj_' || (l_partkey // 2)"
_STAT_COLUMNS = ", ".join(
    f"date_diff('{u}', {{a}}, {{b}}) AS {u}s" for u in ("second", "minute", "hour", "day")
)


def _d(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


_BODY: dict[str, tuple[str, list[str]]] = {
    "job_bounds": (f"SELECT {_JK}, {_bound_columns(6)} FROM ({_bounds('jobs', _JK, '\"JobDurationSeconds\"')}) b", ["jobs"]),
    "job_outliers": (_JOB_OUT, ["jobs"]),
    "fleet_job_outliers": (
        f"""SELECT f.server_name, f."JobName", f."JobFailStep", f."RunStatus", f.source, f."JobDurationSeconds", f."RunDateTime",
        {_bound_columns(6)}, strftime(f."RunDateTime", '%Y-%m-%d') AS "DateOnly", CAST(hour(f."RunDateTime") AS INTEGER) AS "Hour"
        FROM (SELECT * FROM fleet WHERE "JobDurationSeconds" > 3 AND {_window('"RunDateTime"', EV, 'INTERVAL 35 DAY')}) f
        JOIN ({_bounds(f'(SELECT * FROM fleet WHERE "RunDateTime" <= {EV})', 'server_name, ' + _JK, '"JobDurationSeconds"')}) b
        ON {_ON_JOB} AND f.server_name = b.server_name
        WHERE f."JobDurationSeconds" NOT BETWEEN b.m - 3 * b.sd AND b.m + 3 * b.sd""", ["fleet"]),
    "job_outlier_summary": (
        f"""SELECT {_JK}, count(*) AS "Counts", CAST(sum("JobDurationSeconds") // count(*) AS BIGINT) AS "AvgJobDurationSeconds",
        {_CARRIED}, max("DateOnly") AS "MostRecentDateOnly", "Hour" FROM ({_JOB_OUT}) GROUP BY {_JK}, "Hour" """, ["jobs"]),
    "routine_bounds": (
        f"SELECT \"DB_Name\", \"SP Name\", {_bound_columns(2)} FROM ({_bounds('runs', '\"DB_Name\", \"SP Name\"', 'a')}) b", ["runs"]),
    "rejected_rows": (
        """SELECT o_orderkey, CASE WHEN bad THEN 'orders' ELSE o_orderstatus END AS status,
        CASE WHEN NOT bad THEN CAST(floor(o_totalprice) AS BIGINT) END AS price
        FROM (SELECT *, o_orderkey % 7 = 3 OR o_orderkey % 11 = 5 AS bad FROM orders)""", []),
    "orders_by_collated_name": (
        """SELECT CAST(length(a.c_name) + a.c_custkey % 3 AS INTEGER) AS n, a.c_nationkey, b.c_custkey FROM customer a
        LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 > 0) b ON lower(rtrim(b.c_name)) = lower(rtrim(a.c_name))""", []),
    "stream_reported_once": ("SELECT DISTINCT event_id, ts, user_id FROM events WHERE ts IS NOT NULL", []),
    "orders_if_any": (
        """SELECT o_orderstatus AS kind, count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_discount > 0.05
        AND l_returnflag = 'R') GROUP BY 1 UNION ALL SELECT o_orderpriority, count(*) FROM orders
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0) GROUP BY 1""", []),
    "bounds_of_loads": (
        f"""SELECT "DB_Name", "SP Name", {_bound_columns(2)} FROM ({_bounds('(SELECT * FROM runs WHERE "Date" >= '
        "TIMESTAMP '1999-01-01 12:00:00' - INTERVAL 1600 DAY - INTERVAL 12 HOUR)", '"DB_Name", "SP Name"', 'a')}) b""", ["runs"]),
    "routine_outliers": (_routine_out(35), ["runs"]),
    "routine_outlier_summary": (
        f"""SELECT "DB_Name", "SP Name", count(*) AS "Counts", CAST(sum(avg_elapsed_time) // count(*) AS BIGINT) AS "AvgElapsedTime",
        {_CARRIED}, max("DateOnly") AS "MostRecentDateOnly" FROM ({_routine_out(365)}) GROUP BY 1, 2""", ["runs"]),
    "jobs_weekly": (
        f"""SELECT "JobName", "RunStatus", {_yw('"RunDateTime"')} AS "YearWeek", owner, count("JobName") AS "TotalExecutionCount",
        CAST(sum("JobDurationSeconds") AS BIGINT) AS "TotalElapsedTimeSeconds",
        CAST(sum("JobDurationSeconds") // count("JobName") AS BIGINT) AS "AvgElapsedTimeSeconds",
        CAST(NULL AS VARCHAR) AS "ServerName" FROM jobs WHERE "JobFailStep" = 0 GROUP BY 1, 2, 3, 4""", ["jobs"]),
    "jobs_detail": (
        f"""SELECT "JobName", "RunDateTime", {_yw('"RunDateTime"')} AS "YearWeek", "JobDurationSeconds", "RunStatus", owner,
        source, "Date" FROM jobs WHERE "JobFailStep" = 0""", ["jobs"]),
    "routine_weekly": (
        f"""SELECT "DB_Name" AS "DBName", "SP Name" AS "SPName", cached_time, CAST(sum(c) AS BIGINT) AS "TotalExecutionCount",
        CAST(sum(e) AS BIGINT) AS "TotalElapsedTime", CAST(sum(e) // sum(c) // 1000 AS BIGINT) AS "AvgExecutionDurationMilliSeconds",
        {_WLABEL} AS "ExecTimeCat", CAST(sum(lr) // sum(c) AS BIGINT) AS "AvgLogicalReads",
        CAST(sum(lw) // sum(c) AS BIGINT) AS "AvgTotalLogicalWrites", {_yw('"Date"')} AS "YearWeek", {_WORDER} AS "SortOrder"
        FROM runs GROUP BY 1, 2, 3, {_yw('"Date"')}""", ["runs"]),
    "routine_detail": (
        f"""SELECT DISTINCT "DB_Name" AS "DBName", "SP Name" AS "SPName", "Date", c AS "TotalExecutionCount", e AS "TotalElapsedTime",
        {_DLABEL} AS "ExecTimeCat", lr AS "TotalLogicalReads", lw AS "TotalLogicalWrites", {_yw('"Date"')} AS "YearWeek",
        a AS "AvgExecutionDurationMilliSeconds", a // 1000 AS "AvgExecutionMilliSeconds", {_DORDER} AS "SortOrder" FROM runs""", ["runs"]),
    "batch_volumes": (
        f"""SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS "DayOfWeekday", dayname(ts) AS "Weekday", CAST(hour(ts) AS INTEGER) AS "Hour",
        CAST(month(ts) AS INTEGER) AS "Month", {_key('ts')} AS "DateKey", {_yw('ts')} AS "YearWeek",
        CAST(sum(r) // sum(s) AS BIGINT) AS "RequestsPerSecond", count(*) AS "MeasureCount" FROM batch WHERE s > 0
        GROUP BY 1, 2, 3, 4, 5, 6""", ["batch"]),
    "usage_share": (
        f"""SELECT db AS "DatabaseName", tbl AS "TableName", CAST(acc AS DOUBLE) AS "TotalAccesses", CAST(wr AS DOUBLE) AS "TotalWrites",
        {_pct('wr', 'acc')} AS "PercentAccessesAreWrites", CAST(rd AS DOUBLE) AS "TotalReads",
        {_pct('rd', 'acc')} AS "PercentAccessesAreReads", CAST(sk AS DOUBLE) AS "ReadSeeks",
        {_pct('sk', 'rd')} AS "PercentReadsAreIndexSeeks", CAST(sc AS DOUBLE) AS "ReadScans",
        {_pct('sc', 'rd')} AS "PercentReadsAreIndexScans", "Date" FROM used""", ["used"]),
    "io_calendar": (
        f"""SELECT srv AS "ServerName", dbname AS "DatabaseName", drive AS "DatabaseDrive", file AS "FileName", nr + nw AS "TotalIO",
        mr + mw AS "TotalMBs", sr + sw AS "IoStallMS", CASE WHEN nr + nw = 0 THEN 0 ELSE (sr + sw) // (nr + nw) END AS "AvgStallPerIO",
        t1 AS report_date_time_end, {_key('t1')} AS "DateKey", CAST(hour(t1) AS INTEGER) AS "Hour",
        date_diff('minute', t0, t1) AS "MinutesElapsed", {_yw('t1')} AS "YearWeek" FROM io""", ["io"]),
    "io_per_day": (
        """SELECT srv AS server_name, dbname AS database_name, drive AS database_drive, file AS database_file_name,
        nr AS "NumberReads", nw AS "NumberWrites", nr + nw AS "TotalIO",
        CASE WHEN dd = 0 THEN 0 ELSE (nr + nw) // dd END AS "TotalIOperDay", mr AS "MBsRead", mw AS "MBsWritten",
        mr + mw AS "TotalMBs", CASE WHEN dd = 0 THEN 0 ELSE (mr + mw) // dd END AS "TotalMBsperDay", sr AS "IoStallReadMS",
        sw AS "IoStallWriteMS", sr + sw AS "IoStallMS", CASE WHEN nr = 0 THEN 0 ELSE sr // nr END AS "AvgStallPerReadIO",
        CASE WHEN nw = 0 THEN 0 ELSE sw // nw END AS "AvgStallPerWriteIO",
        CASE WHEN nr + nw = 0 THEN 0 ELSE (sr + sw) // (nr + nw) END AS "AvgStallPerIO", t0 AS report_date_time_start,
        t1 AS report_date_time_end, date_trunc('day', t1) AS "End_Date", dd AS "Days"
        FROM (SELECT *, date_diff('day', t0, t1) AS dd FROM io)""", ["io"]),
    "table_row_counts": (
        f"""SELECT db AS "DatabaseName", full_name AS "TableNameFull", tbl AS "TableName", "RowCount", "Date" FROM sizes
        WHERE {_window('"Date"', SA)} AND db <> 'tempdb'""", ["sizes"]),
    "table_row_trend": (
        """SELECT db AS "DatabaseName", tbl AS "TableName", "RowCount", "Date" FROM sizes WHERE db <> 'tempdb'""", ["sizes"]),
    "unchanged_tables": (
        """SELECT db AS "DatabaseName", tbl AS "TableName" FROM (SELECT DISTINCT db, full_name, tbl, "RowCount" FROM sizes
        WHERE db <> 'tempdb') GROUP BY db, full_name, tbl HAVING count("RowCount") = 1""", ["sizes"]),
    "routine_scripts": (
        """SELECT 'usp_' || doc_id AS "ProcName", trim(text) AS "CreateScript",
        replace(replace(replace(trim(text), chr(10), ''), chr(13), ''), chr(9), '') AS "R_CreateScript",
        TIMESTAMP '2020-01-01' AS create_date, TIMESTAMP '2020-01-01' + to_days(CAST(n_chars % 1000 AS INTEGER)) AS modify_date
        FROM documents WHERE lang <> 'de' AND source <> 'src0'""", []),
    "indexes_with_scans": (
        f"""SELECT u."DB_Name" AS "DBName", u."Table_Name" AS "TableName", u."Index_Name" AS "IndexName", s."RowCount",
        {_d('user_seeks', 'user_scans', 'user_lookups', 'user_updates')}, type_desc, CAST(fill_factor AS DOUBLE) AS fill_factor,
        is_primary_key, u."Date" FROM usage u JOIN sizes s ON s.db = u."DB_Name" AND s.tbl = u."Table_Name"
        WHERE u.user_scans > 100 AND u."Index_Name" IS NOT NULL AND {_window('u."Date"', SA, 'INTERVAL 8 DAY')}
        AND {_window('s."Date"', SA, 'INTERVAL 8 DAY')}
        ORDER BY u.user_scans DESC, 1, 2, 3, u."Date", u.user_seeks, u.user_lookups, u.user_updates, type_desc,
        u.fill_factor, is_primary_key, s."RowCount" LIMIT 1000""", ["usage", "sizes"]),
    "tables_with_row_count": (
        """SELECT db AS "DBName", tbl AS "TableName", "RowCount", CAST(acc AS DOUBLE) AS "TotalAccesses",
        CAST(rd AS DOUBLE) AS "TotalReads", CAST(sc AS DOUBLE) AS "ReadScans", "Date" FROM sized""", ["sized"]),
    "tables_with_row_count_latest": (
        """SELECT db AS "DBName", tbl AS "TableName", rc AS "RowCount", CAST(acc AS DOUBLE) AS "TotalAccesses",
        CAST(rd AS DOUBLE) AS "TotalReads", CAST(sc AS DOUBLE) AS "ReadScans", "Date" FROM used JOIN newest USING (db, tbl)""",
        ["used", "newest"]),
    "tables_with_statistics": (
        f"""SELECT z.db AS "DBName", z.tbl AS "TableName", z."RowCount", s."Index_Name" AS "IndexName", s."LastUpdateDate",
        CAST(s.rowmodctr AS DOUBLE) AS rowmodctr, CAST(z.acc AS DOUBLE) AS "TotalAccesses", CAST(z.rd AS DOUBLE) AS "TotalReads",
        CAST(z.sc AS DOUBLE) AS "ReadScans", z."Date" FROM sized z JOIN stats s ON s."DB_Name" = z.db AND s."Table_Name" = z.tbl
        WHERE {_window('s."Date"', SA)}""", ["sized", "stats"]),
    "stale_statistics": ("SELECT * FROM stale", ["stale"]),
    "fragmented_top_tables": ("SELECT * FROM fragtop", ["fragtop"]),
    "indexes_with_free_space": ("SELECT * FROM spacious", ["spacious"]),
    "indexes_with_free_space_as_written": (
        f"""SELECT s."DB_Name" AS "DBName", s."Table_Name" AS "TableName", s."IndexID", s."IndexName", s."Type",
        s."Total_MBs", s."Free_Space_MBs", s."Free_Space_Percent", z."RowCount" AS "TableRowCount",
        CAST(z.acc AS DOUBLE) AS "TotalAccesses", s."Date",
        'ALTER INDEX [' || s."IndexName" || '] ON [dbo].[' || s."Table_Name" || '] REBUILD with (ONLINE = ON)' AS "Rebuild"
        FROM space s LEFT JOIN sized z ON z.db = s."DB_Name" AND z.tbl = s."Table_Name"
        WHERE {_window('s."Date"', SA)} AND s."Free_Space_MBs" > 50 OR s."Free_Space_Percent" > 50""", ["space", "sized"]),
    "unneeded_indexes": (
        f"""SELECT "DB_Name" AS "DBName", "Table_Name" AS "TableName", "Index_Name" AS "IndexName",
        CAST(sum(user_seeks) AS DOUBLE) AS "TotalSeeks", CAST(sum(user_scans) AS DOUBLE) AS "TotalScans",
        CAST(sum(user_lookups) AS DOUBLE) AS "TotalLookups", CAST(sum(user_updates) // count(user_updates) AS BIGINT) AS "AvgWeekUpdates",
        min(d0) AS "FirstDate", max(d1) AS "LastDate" FROM (SELECT "DB_Name", "Table_Name", "Index_Name", user_seeks, user_scans,
        user_lookups, user_updates, min("Date") AS d0, max("Date") AS d1 FROM usage WHERE "Index_Name" IS NOT NULL
        AND NOT is_primary_key AND type_desc = 'NONCLUSTERED' AND "DB_Name" <> 'tempdb' AND "Date" <= {SA}
        GROUP BY 1, 2, 3, 4, 5, 6, 7) GROUP BY 1, 2, 3 HAVING sum(user_seeks) = 0 AND sum(user_scans) = 0
        AND sum(user_lookups) = 0 AND max(d1) > {SA} - {WEEK}""", ["usage"]),
    "unused_tables": (
        f"""SELECT s.db AS "DatabaseName", s.tbl AS "TableName", CAST(u.a AS DOUBLE) AS "TotalAccesses", s.rows AS "RowCount"
        FROM (SELECT db, tbl, CAST(sum("RowCount") AS BIGINT) AS rows FROM sizes WHERE {_window('"Date"', SA)} AND db <> 'tempdb'
        GROUP BY 1, 2) s LEFT JOIN (SELECT "DB_Name" AS db, "Table_Name" AS tbl, sum(user_seeks) AS a FROM usage
        WHERE "Date" <= {SA} GROUP BY 1, 2) u USING (db, tbl)""", ["sizes", "usage"]),
    "unused_tables_as_written": (
        f"""SELECT s.db AS "DatabaseName", s.tbl AS "TableName", CAST(sum(u.user_seeks) AS DOUBLE) AS "TotalAccesses",
        CAST(sum(s."RowCount") AS BIGINT) AS "RowCount" FROM (SELECT * FROM sizes WHERE {_window('"Date"', SA)} AND db <> 'tempdb') s
        LEFT JOIN (SELECT * FROM usage WHERE "Date" <= {SA}) u ON u."DB_Name" = s.db AND u."Table_Name" = s.tbl
        GROUP BY 1, 2""", ["sizes", "usage"]),
    "counter_delta": (
        """SELECT user_id AS "dbID", n * 10 AS "NumberReads", nr AS "NumberReads_delta", sr AS "IoStallReadMS_delta",
        t0 AS interval_start, date_diff('second', t0, ts) AS seconds FROM io_delta""", ["io_delta"]),
    "file_io": (
        """SELECT CAST(user_id % 5 AS INTEGER) AS "serID", user_id AS "dbID", 'C' AS database_drive, 'file_' || user_id AS database_file_name,
        nr AS "NumberReads", nw AS "NumberWrites", mr AS "MBsRead", mw AS "MBsWritten", sr AS "IoStallReadMS", sw AS "IoStallWriteMS",
        t0 AS report_date_time_start, ts AS report_date_time_end, wk AS "TimeStamp", nr + nw AS "TotalIO", mr + mw AS "TotalMBs",
        sr + sw AS "IoStallMS", CASE WHEN nr = 0 THEN 0 ELSE sr // nr END AS "AvgStallPerReadIO",
        CASE WHEN nw = 0 THEN 0 ELSE sw // nw END AS "AvgStallPerWriteIO",
        CASE WHEN nr + nw = 0 THEN 0 ELSE (sr + sw) // (nr + nw) END AS "AvgStallPerIO" FROM io_delta
        WHERE nr + nw >= 0""", ["io_delta"]),
    "file_io_continue": (
        """SELECT CAST(user_id % 5 AS INTEGER) AS "serID", user_id AS "dbID", 'C' AS database_drive, 'file_' || user_id AS database_file_name,
        nr AS "NumberReads", nw AS "NumberWrites", mr AS "MBsRead", mw AS "MBsWritten", s1 AS "IoStallReadMS", sw AS "IoStallWriteMS",
        t0 AS report_date_time_start, ts AS report_date_time_end, wk AS "TimeStamp", nr + nw AS "TotalIO", mr + mw AS "TotalMBs",
        s1 + sw AS "IoStallMS", CASE WHEN nr = 0 THEN 0 ELSE s1 // nr END AS "AvgStallPerReadIO",
        CASE WHEN nw = 0 THEN 0 ELSE sw // nw END AS "AvgStallPerWriteIO",
        CASE WHEN nr + nw = 0 THEN 0 ELSE (s1 + sw) // (nr + nw) END AS "AvgStallPerIO" FROM (
        SELECT d.*, d.n * d.n % 1000003 - coalesce((SELECT CAST(sum(e.sr) AS BIGINT) FROM io_delta e WHERE e.user_id = d.user_id
        AND e.wk = d.wk AND e.ts < d.ts), 0) AS s1 FROM io_delta d
        QUALIFY row_number() OVER (PARTITION BY d.user_id ORDER BY d.ts DESC) = 1)""", ["io_delta"]),
    "batch_snapshot": (
        f"""SELECT 'SQLServer:SQL Statistics' AS object_name, 'Batch Requests/sec ' || user_id AS counter_name,
        event_id * 13 % 5000 AS cntr_value, {EV} AS "Date" FROM events""", []),
    "batch_delta": (
        """SELECT 'SQLServer:SQL Statistics' AS object_name, 'Batch Requests/sec ' || user_id AS counter_name, c AS cntr_value,
        ts AS "Date", CAST(s AS INTEGER) AS seconds, r AS requests FROM batch""", ["batch"]),
    "packet_delta": (
        """SELECT server_name, a AS "PacketsReceivedBase", b AS "PacketsSentBase", c AS "PacketErrorsBase", ts AS "Date",
        CAST(CASE WHEN pt IS NULL THEN 0 ELSE date_diff('second', pt, ts) END AS INTEGER) AS seconds,
        CAST(CASE WHEN pt IS NULL THEN 0 WHEN a < pa THEN a ELSE a - pa END AS INTEGER) AS "PacketsReceived",
        CAST(CASE WHEN pt IS NULL THEN 0 WHEN b < pb THEN b ELSE b - pb END AS INTEGER) AS "PacketsSent",
        CAST(CASE WHEN pt IS NULL THEN 0 WHEN c < pc THEN c ELSE c - pc END AS INTEGER) AS "PacketErrors" FROM (
        SELECT *, lag(ts) OVER w AS pt, lag(a) OVER w AS pa, lag(b) OVER w AS pb, lag(c) OVER w AS pc FROM (
        SELECT 'server_' || (user_id % 20) AS server_name, ts, event_id * 13 % 5000 AS a, event_id * 7 % 9000 AS b,
        event_id % 100 AS c FROM events) WINDOW w AS (PARTITION BY server_name ORDER BY ts, a, b, c))""", []),
    "delivery_rate": (_rates(""), []),
    "delivery_rate_first_pass": (_rates(f"AND {_window('ts', EV, 'INTERVAL 2 DAY')}"), []),
    "memory_snapshot": (
        f"""SELECT {_SERVER_DAY}, {', '.join(f'CAST(0 AS BIGINT) AS "{c}"' for c in MEMORY_ZERO)},
        {', '.join(f'false AS "{c}"' for c in MEMORY_FALSE)},
        coalesce(max(CAST(floor(value * 100) AS BIGINT)) FILTER (event_type = 'view'), 0) AS "Mem_Needed_KB_Per_Current_Workload",
        coalesce(max(CAST(floor(value * 100) AS BIGINT)) FILTER (event_type = 'error'), 0) AS "Lazy_Writes_Per_Sec",
        {EV} AS "Date" FROM events GROUP BY 1, 2""", []),
    "memory_snapshot_in_bytes": (
        f"""SELECT {_SERVER_DAY}, {', '.join(f'CAST(0 AS BIGINT) AS "{c}"' for c in MEMORY_ZERO if c not in MEMORY_BYTES)},
        {', '.join(f'false AS "{c}"' for c in MEMORY_FALSE)},
        {', '.join(f"coalesce(max({v}) FILTER (event_type = '{kind}'), 0)" + f' AS "{c}"' for c, (kind, v) in MEMORY_BYTES.items())},
        {EV} AS "Date" FROM events GROUP BY 1, 2""", []),
    "page_life": (
        f"""SELECT {_SERVER_DAY}, CAST(floor(value * 100) AS INTEGER) AS "Page_Life_Expectancy", {EV} AS "Date" FROM events
        WHERE event_type = 'signup'""", []),
    "hit_ratio": (
        f"""SELECT server_name, day, CAST((2000 * a + b) // (2 * b) AS DOUBLE) / 1000 AS "Buffer_Cache_Hit_Ratio", {EV} AS "Date"
        FROM (SELECT {_SERVER_DAY}, max(CAST(floor(value * 100) AS BIGINT)) FILTER (event_type = 'click') AS a,
        max(CAST(floor(value * 100) AS BIGINT) + 50000) FILTER (event_type = 'purchase') AS b FROM events GROUP BY 1, 2)
        WHERE a IS NOT NULL AND b IS NOT NULL""", []),
    "cpu_samples": (
        f"""SELECT {EV} - to_seconds(ago) AS "Date", CAST(event_id % 41 AS INTEGER) AS "SQLProcessUtilization",
        CAST(idle AS INTEGER) AS "SystemIdle", CAST(100 - idle - event_id % 41 AS INTEGER) AS "OtherProcessUtilization"
        FROM (SELECT event_id, event_id * 17 % 100000 AS ago, CASE WHEN user_id % 7 <> 0 THEN event_id % 60 END AS idle FROM events)
        WHERE ago < 86400""", []),
    "agent_jobs": ("SELECT * FROM agent", ["agent"]),
    "report_jobs": ("SELECT * FROM report", ["report"]),
    "etl_jobs": ("SELECT * FROM etl", ["etl"]),
    "unified_jobs": (
        "SELECT * FROM agent UNION ALL SELECT * FROM report UNION ALL SELECT * FROM etl", ["agent", "report", "etl"]),
    "server_dim": (
        """SELECT n_nationkey AS "serID", n_name AS server_name, CASE WHEN hit THEN '13.0.' || n ELSE '12.0' END AS sql_version_num,
        CASE WHEN hit THEN 'Enterprise' ELSE 'Standard' END AS sql_edition,
        CAST(CASE WHEN hit THEN n * 4 ELSE 2 END AS INTEGER) AS sql_physical_cpus,
        CAST(CASE WHEN hit THEN n * 2 ELSE 1 END AS INTEGER) AS sql_logical_cpus, CASE WHEN hit THEN ' 6.3' END AS windows_version_num,
        CAST(CASE WHEN hit THEN kb * 2 // 1024 END AS INTEGER) AS "AvailableRAM",
        CAST(CASE WHEN hit THEN kb // 1024 END AS INTEGER) AS "MaxSQLRAM"
        FROM (SELECT nation.*, n, kb, n IS NOT NULL AND n_regionkey < 3 AS hit FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS n,
        max(CAST(floor(s_acctbal * 100) AS BIGINT)) AS kb FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey)""", []),
    "fragmentation_snapshot": (
        f"""SELECT {_LDB} AS "DB_Name", {_LOBJ} AS "Table_Name", l_linenumber AS "Index_ID",
        'ix_' || l_partkey || '_' || l_linenumber AS "Index_Name", round(l_discount * 1000, 1) AS "Avg_Fragmentation", {SA} AS "Date",
        CAST(l_quantity AS BIGINT) AS page_count, CAST(l_orderkey % 3 AS INTEGER) AS partition_number FROM lineitem WHERE {_INDEXED}""", []),
    "statistics_snapshot": (
        f"""SELECT {_LDB} AS "DB_Name", {_LOBJ} AS "Table_Name", 'st_' || l_linenumber AS "Index_Name", l_shipdate AS "LastUpdateDate",
        l_quantity AS rowmodctr, {SA} AS "Date" FROM lineitem""", []),
    "table_usage": (
        f"""SELECT db AS "DatabaseName", obj AS "TableName", CAST(w + r AS DOUBLE) AS "TotalAccesses", CAST(w AS DOUBLE) AS "TotalWrites",
        {_pct('w', '(w + r)')} AS "PercentAccessesAreWrites", CAST(r AS DOUBLE) AS "TotalReads",
        {_pct('r', '(w + r)')} AS "PercentAccessesAreReads", CAST(s AS DOUBLE) AS "ReadSeeks",
        {_pct('s', 'r')} AS "PercentReadsAreIndexSeeks", CAST(c AS DOUBLE) AS "ReadScans",
        {_pct('c', 'r')} AS "PercentReadsAreIndexScans", {SA} AS "Date" FROM (
        SELECT {_LDB} AS db, {_LOBJ} AS obj, sum({_flag('N', 1)}) AS w, sum({_flag('R', 1)} + {_flag('A', 1)}) AS r,
        sum({_flag('R', 1)}) AS s, sum({_flag('A', 1)}) AS c FROM lineitem JOIN (SELECT p_partkey, unnest(range(1 + p_partkey % 5)) FROM part)
        ON p_partkey = l_partkey WHERE l_partkey % 5 >= 1 GROUP BY 1, 2) WHERE r > 0""", []),
    "routine_catalog": (
        f"""SELECT o.db AS "DB_Name", o.name AS "SP_Name", cd AS "Create_Date", md AS "Modify_Date", CAST(uses AS DOUBLE) AS "Execution_Count",
        {SA} AS "Date" FROM objs o LEFT JOIN (SELECT db, schema_name, name, sum(uses) AS uses FROM plans GROUP BY 1, 2, 3) p
        ON p.db = o.db AND p.schema_name = o.schema_name AND p.name = o.name WHERE p_size % 3 <> 0""", ["objs", "plans"]),
    "routine_catalog_by_name": (
        f"""SELECT o.db AS "DB_Name", o.name AS "SP_Name", cd AS "Create_Date", md AS "Modify_Date", CAST(uses AS DOUBLE) AS "Execution_Count",
        {SA} AS "Date" FROM objs o LEFT JOIN (SELECT schema_name, name, sum(uses) AS uses FROM plans GROUP BY 1, 2) p
        ON p.name = o.name WHERE p_size % 3 <> 0""", ["objs", "plans"]),
    "routine_exec": (
        f"""SELECT db AS "DB_Name", sp AS "SP Name", c AS execution_count,
        coalesce(CASE WHEN age <> 0 THEN c // age END, 0) AS "Calls/Second", w // c AS "AvgWorkerTime", w AS "TotalWorkerTime",
        e AS total_elapsed_time, e // c AS avg_elapsed_time, cached_time, lr AS "TotalLogicalReads", lr // c AS "AvgLogicalReads",
        lw AS "TotalLogicalWrites", lw // c AS "AvgLogicalWrites", {SA} AS "Date" FROM (
        SELECT *, date_diff('second', cached_time, {SA}) AS age,
        row_number() OVER (PARTITION BY db ORDER BY c DESC, sp, cached_time, e) AS rn FROM (
        SELECT 'db_' || (l_suppkey % 5) AS db, s_name AS sp, CAST(l_quantity AS BIGINT) AS c, l_shipdate AS cached_time,
        CAST(floor(l_extendedprice * 100) AS BIGINT) AS w, CAST(floor(l_extendedprice * 100) AS BIGINT) * l_linenumber AS e,
        CAST(l_linenumber * 3 AS BIGINT) AS lr, CAST(l_linenumber AS BIGINT) AS lw
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)) WHERE rn <= 200""", []),
    "top_queries": (
        f"""SELECT c_name AS name, c_mktsegment AS "DB_Name", x AS execution_count, n * 3 AS total_logical_reads, n AS last_logical_reads,
        n * 2 AS total_logical_writes, n AS last_logical_writes, e // 1000000 AS "total_elapsed_time_in_S",
        e // x // 1000000 AS "last_elapsed_time_in_S", e // 1000 // x AS "AvgExecutionDuration1000sOfSeconds",
        n * 11 // x AS "AvgPhysicalReads", n % 7 AS "MinPhysicalReads", n % 7 + 9 AS "MaxPhysicalReads",
        n * 11 // x * 8 AS "AvgPhysicalReads_kbsize", n % 7 * 8 AS "MinPhysicalReads_kbsize", (n % 7 + 9) * 8 AS "MaxPhysicalReads_kbsize",
        o_orderdate AS "CreationDateTime", o_orderdate AS last_execution_time,
        substr(q, CAST(greatest(n % 5, 1) AS BIGINT), CAST(CASE WHEN n % 3 = 0 THEN length(q) - n % 5 ELSE 10 END + least(n % 5 - 1, 0) AS BIGINT)) AS query_text,
        CASE WHEN o_orderstatus <> 'P' THEN '<plan/>' || n END AS query_plan, false AS missing_index_info, {SA} AS "Date"
        FROM (SELECT *, o_orderkey AS n, o_orderkey % 50 + 1 AS x, CAST(floor(o_totalprice * 100) AS BIGINT) * 10 AS e,
        'select * from ' || c_name AS q FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment <> 'MACHINERY')
        ORDER BY e // 1000 // x DESC, o_custkey, n LIMIT 25""", []),
    "index_usage_snapshot": (
        f"""SELECT {_LDB} AS "DB_Name", {_LOBJ} AS "Table_Name", 'ix_' || l_partkey || '_' || l_linenumber AS "Index_Name",
        CAST({_flag('R', 1)} AS DOUBLE) AS user_seeks, CAST({_flag('A', 1)} AS DOUBLE) AS user_scans, CAST(0 AS DOUBLE) AS user_lookups,
        CAST({_flag('N', 1)} AS DOUBLE) AS user_updates, CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS last_user_seek,
        CASE WHEN l_returnflag = 'A' THEN l_shipdate END AS last_user_scan, CAST(NULL AS TIMESTAMP) AS last_user_lookup,
        CASE WHEN l_returnflag = 'N' THEN l_shipdate END AS last_user_update,
        CASE WHEN l_linenumber = 1 THEN 'CLUSTERED' ELSE 'NONCLUSTERED' END AS type_desc, CAST(l_linenumber * 10 AS DOUBLE) AS fill_factor,
        l_linenumber = 1 AS is_primary_key, {SA} AS "Date" FROM lineitem WHERE {_INDEXED}""", []),
    "index_free_space": (
        f"""SELECT db AS "DB_Name", s_name AS "Table_Name", CAST(half + 1 AS INTEGER) AS "Index_ID", 'ix_' || supp || '_' || half AS "Index_Name",
        CASE WHEN half = 0 THEN 'CLUSTERED' ELSE 'NONCLUSTERED' END AS "Type", {_SPACE_OUT}, {SA} AS "Date" FROM (
        SELECT db, supp, half, {_SPACE_SUMS} FROM buf GROUP BY 1, 2, 3) JOIN supplier ON s_suppkey = supp
        WHERE pages > 128 AND supp >= 2""", ["buf"]),
    "buffer_space": (
        f"""SELECT db AS "DB_Name", "DPCount", "CPCount", "DPFreeSpace", "CPFreeSpace", {_SPACE_OUT} FROM (
        SELECT db, {_SPACE_SUMS} FROM buf GROUP BY 1)""", ["buf"]),
    "table_rows_snapshot": (
        f"""SELECT db AS "DatabaseName", '[' || schema_name || '].[' || name || ']' AS "TableNameFull", name AS "TableName",
        CAST(sum(l_quantity) AS BIGINT) AS "RowCount", {SA} AS "Date" FROM lineitem JOIN objs ON k = l_partkey
        WHERE l_linenumber <= 2 AND p_size % 3 = 0 AND p_size % 10 <> 0 GROUP BY 1, schema_name, name""", ["objs"]),
    "clean_statistics": (
        """SELECT "DB_Name", "Table_Name", "Index_Name", "LastUpdateDate", CAST(rowmodctr AS DOUBLE) AS rowmodctr, "Date" FROM stats
        WHERE "DB_Name" <> 'tempdb'""", ["stats"]),
    "clean_statistics_listed": (
        """SELECT * FROM (SELECT "DB_Name", "Table_Name", "Index_Name", "LastUpdateDate",
        CAST(CASE WHEN rowmodctr % 3 = 0 THEN 0 ELSE rowmodctr END AS DOUBLE) AS rowmodctr, "Date",
        replace("DB_Name", 'db_', 'server_') AS server_name FROM stats) WHERE "DB_Name" <> 'tempdb'
        AND (rowmodctr = 0 AND server_name IN ('server_1', 'server_3')) IS NOT TRUE""", ["stats"]),
    "file_io_snapshot": (
        f"""SELECT s_name AS databasename, CASE WHEN l_linenumber < 7 THEN ['C', 'D', 'E'][l_linenumber % 3 + 1] END AS database_drive,
        CASE WHEN l_linenumber < 7 THEN 'file_' || l_linenumber END AS database_file_name, CAST(l_quantity AS BIGINT) AS "NumberReads",
        CAST(l_quantity AS BIGINT) * 2 AS "NumberWrites", CAST(floor(l_extendedprice * 100) AS BIGINT) * 100 // 1048576 AS "MBsRead",
        CAST(floor(l_extendedprice * 100) AS BIGINT) * 10 // 1048576 AS "MBsWritten", CAST(l_quantity AS BIGINT) AS "IoStallReadMS",
        CAST(l_quantity AS BIGINT) * 4 AS "IoStallWriteMS", TIMESTAMP '2001-07-01' AS report_date_time_start,
        {SA} AS report_date_time_end, TIMESTAMP '2001-07-01' AS "TimeStamp" FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey""", []),
    "register_databases": (
        """SELECT CAST(s_suppkey % 25 AS INTEGER) AS "serID", 'server_' || (s_suppkey % 25) AS server_name, s_name AS database_name
        FROM supplier""", []),
    "recent_runs": ("""SELECT db AS "DB_Name", sp AS "SP_Name", v AS last_elapsed_time, ts AS "Date" FROM recent""", ["recent"]),
    "long_runs": (
        f"""SELECT db AS "DB_Name", sp AS "SP_Name", v AS last_elapsed_time, ts AS "Date", {_bound_columns(6, '')} FROM slow""", ["slow"]),
    "repeat_offenders": ("""SELECT sp AS "SP_Name" FROM flagged""", ["flagged"]),
    "alert_detail": (
        """SELECT DISTINCT trim(db) || '.' || trim(sp) AS "SPName", v AS last_elapsed_time, m AS "Mean",
        CAST(trunc(m + 3 * sd) AS BIGINT) AS "UpprBnd", ts AS "Date" FROM slow JOIN flagged USING (sp)
        ORDER BY 1, ts DESC, 2, 3, 4 LIMIT 1000""", ["slow", "flagged"]),
    "table_candidates": ("SELECT * FROM tcand", ["tcand"]),
    "index_candidates": ("SELECT * FROM icand", ["icand"]),
    "enrich_candidates": (
        """SELECT c."DBName", c."TableName", CAST(u.acc AS DOUBLE) AS "TotalAccesses", CAST(u.rd AS DOUBLE) AS "TotalReads",
        n.rc AS "RecordCount" FROM tcand c LEFT JOIN used u ON u.db = c."DBName" AND u.tbl = c."TableName"
        LEFT JOIN newest n ON n.db = c."DBName" AND n.tbl = c."TableName" """, ["tcand", "used", "newest"]),
    "rebuild_commands": ("SELECT * FROM commands", ["commands"]),
    "rebuild_worklist": (
        """SELECT "DBName", "TableName", string_agg("Command", ';' ORDER BY "Command") AS "Worklist" FROM (
        SELECT DISTINCT "DBName", "TableName", "Command" FROM commands) GROUP BY 1, 2""", ["commands"]),
    "rebuild_worklist_offline": (
        """SELECT "DBName", "TableName", string_agg("Command", ';' ORDER BY "Command") AS "Worklist" FROM (
        SELECT DISTINCT "DBName", "TableName", replace(replace("Command", 'REBUILD_ONLINE', 'REBUILD_OFFLINE'), '@MaxDOP = ''2',
        '@MaxDOP = ''4') AS "Command" FROM commands) GROUP BY 1, 2""", ["commands"]),
    "recommend_run": (
        """SELECT * FROM commands UNION ALL SELECT "Database_Name", "Table_Name", 'statistics', "Command" FROM current_refresh""",
        ["commands", "current_refresh"]),
    "modified_percent": (
        """SELECT "Database_Name", "Table_Name", "Index_Name", "LastUpdateDate", CAST(rowmodctr AS DOUBLE) AS rowmodctr, "RowCount",
        CAST(acc AS DOUBLE) AS "TotalAccesses", CAST(rd AS DOUBLE) AS "TotalReads", pct AS "PercentModified",
        'UPDATE STATISTICS [' || "Table_Name" || '](' || "Index_Name" || ') WITH FULLSCAN' AS "RebuildState",
        'ALTER INDEX [' || "Index_Name" || '] ON [' || "Table_Name" || '] REBUILD with (ONLINE = ON,maxdop=8)' AS "IndexRebuild"
        FROM modified""", ["modified"]),
    "stats_commands": ("SELECT * FROM refresh", ["refresh"]),
    "stats_worklist": (
        """SELECT "Database_Name", "Table_Name", string_agg("Command", ';' ORDER BY "Command") AS "Worklist" FROM refresh
        GROUP BY 1, 2""", ["refresh"]),
    "lock_enrich": ("SELECT * FROM lockrows", ["lockrows"]),
    "lock_hotspots": (
        """SELECT r_name AS "DB_Name", 'part_' || p_partkey AS "ObjectName", count(*) AS "Locks", count(blocking_session_id) AS "Blocked"
        FROM lockrows JOIN region ON r_regionkey = dbid JOIN part ON p_partkey = "objId" AND p_partkey % 5 = dbid
        WHERE r_regionkey <> 4 AND p_size <> 1 GROUP BY 1, 2""", ["lockrows"]),
    "calendar_keys": (
        f"""SELECT o_orderkey, {_yw('o_orderdate')} AS "YearWeek", {_key('o_orderdate')} AS "DateKey",
        CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS "DayOfWeekday", dayname(o_orderdate) AS "Weekday",
        CAST(hour(o_orderdate) AS INTEGER) AS "Hour", date_trunc('day', o_orderdate)::TIMESTAMP AS "End_Date" FROM orders""", []),
    "boundary_diffs": (
        f"""SELECT l_orderkey AS id, {_STAT_COLUMNS.format(a='o_orderdate', b='l_shipdate')} FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        UNION ALL SELECT event_id, {_STAT_COLUMNS.format(a="TIMESTAMP '2024-01-01 00:00:59'", b='ts')} FROM events""", []),
    "recent_events": (f"SELECT * FROM events WHERE {_window('ts', EV)}", []),
    "retained_events": (f"SELECT * FROM events WHERE ts >= {EV} - INTERVAL 14 DAY OR ts IS NULL", []),
    "kept_events": ("SELECT * FROM events WHERE (NOT (event_type = 'error' AND value < 10)) IS NOT FALSE", []),
    "seeded_settings": (
        """SELECT DISTINCT user_id AS key, 'set' AS item FROM events UNION ALL SELECT c_custkey, 'default' FROM customer
        WHERE c_custkey NOT IN (SELECT user_id FROM events)""", []),
    "upserted_customers": (
        f"""SELECT coalesce(c_custkey, k) AS c_custkey, CASE WHEN k IS NULL THEN c_mktsegment ELSE v END AS segment,
        CASE WHEN k IS NULL THEN TIMESTAMP '2000-01-01' ELSE {EV} END AS stamp FROM customer FULL JOIN (
        SELECT user_id AS k, arg_max(event_type, event_id) AS v FROM events GROUP BY 1
        UNION ALL SELECT -1 - s_suppkey, 'SUPPLIER' FROM supplier) ON k = c_custkey""", []),
    "updated_from_orders": (
        """SELECT c_custkey, c_mktsegment, round(coalesce(p, -1.0), 6) AS o_totalprice FROM customer LEFT JOIN (
        SELECT o_custkey, o_totalprice AS p FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate DESC, o_totalprice DESC) = 1) ON o_custkey = c_custkey""", []),
    "orders_with_customer": (
        """SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey""", []),
    "never_ordered": (
        f"""SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
        AND {_window('o_orderdate', SA, 'INTERVAL 365 DAY')})""", []),
    "top_orders_per_customer": (
        """SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_totalprice DESC, o_orderkey) <= 3""", []),
    "latest_order_per_customer": (
        """SELECT o_custkey, o_orderdate, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""", []),
    "previous_event": (
        """SELECT user_id, ts, event_id, event_type, lag(event_id) OVER w AS prev_id, lag(event_type) OVER w AS prev_type,
        lead(event_id) OVER w IS NULL AS newest FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""", []),
    "event_bounds_exact_keys": (
        f"""SELECT event_type, user_id, {_bound_columns(6)} FROM ({_bounds(
            '(SELECT *, CAST(floor(value * 100) AS BIGINT) AS v FROM events)', 'event_type, user_id', 'v')}) b""", []),
    "tagged_amounts": (
        """SELECT source, id, count(*) AS n, round(sum(amount), 2) AS amount FROM (
        SELECT 'order' AS source, o_orderkey AS id, o_totalprice AS amount FROM orders
        UNION ALL SELECT 'line', l_orderkey, l_extendedprice FROM lineitem) GROUP BY 1, 2""", []),
    "history_rerun": (f"""SELECT db AS "DatabaseName", full_name AS "TableNameFull", tbl AS "TableName", "RowCount", "Date", run AS snapshot_run
        FROM sizes, (VALUES ('120000'), ('120000')) AS runs(run)""", ["sizes"]),
    "history_rerun_empty": ("""SELECT db AS "DatabaseName", full_name AS "TableNameFull", tbl AS "TableName", "RowCount", "Date",
        '120000' AS snapshot_run FROM sizes""", ["sizes"]),
    "history_as_of": (
        """SELECT event_type AS "DB_Name", CAST(user_id AS VARCHAR) AS "SP_Name", 'streamed' AS snapshot_run, count(*) AS n,
        CAST(sum(event_id) AS BIGINT) AS total, max(ts) AS newest FROM events WHERE ts <= TIMESTAMP '2024-01-16 06:00:00' GROUP BY 1, 2
        UNION ALL SELECT 'orders', o_orderpriority, '120000', count(*), CAST(sum(o_orderkey) AS BIGINT),
        max(CASE WHEN o_orderkey % 7 > 0 THEN o_orderdate END) FROM orders GROUP BY 2""", []),
    "collect_errors": (
        f"""SELECT name AS "TableName", CAST({len('RuntimeError: source ' + 'is down ' * 60)} AS BIGINT) AS n
        FROM (VALUES ('fragmentation'), ('jobs'), ('page_life')) AS failed(name) UNION ALL SELECT 'table_rows', count(*) FROM sizes""", ["sizes"]),
    "parameter_lookup": (
        f"""SELECT event_id, ts, 365 AS usage_days, 180 AS job_days FROM events WHERE {_window('ts', EV, 'INTERVAL 2880 MINUTE')}""", []),
    "alert_run_again": (
        """SELECT 'alerts' AS stored, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'flagged_routines', 0
        UNION ALL SELECT 'recent_runs', count(*) FROM recent""", ["recent"]),
    "recent_runs_held": (
        f"""SELECT DISTINCT 'db_' || (user_id % 5) AS "DB_Name", c_name AS "SP_Name", CAST(floor(value * 100) AS BIGINT) AS last_elapsed_time, ts AS "Date"
        FROM events JOIN customer ON c_custkey = user_id WHERE user_id % 5 >= 1 AND c_mktsegment <> 'MACHINERY'
        AND (ts BETWEEN {EV} - INTERVAL 20 DAY AND {EV} - INTERVAL 10 DAY OR ts BETWEEN {EV} - INTERVAL 5 DAY AND {EV})""", []),
    "fan_in": ("""SELECT o_orderkey, o_custkey, o_orderpriority AS "DB_Name" FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')""", []),
    "stream_volumes": (
        """SELECT s AS window_start, s + INTERVAL 2 HOUR AS window_end, event_type, count(*) AS "MeasureCount",
        CAST(sum(CAST(floor(value * 100) AS BIGINT)) AS BIGINT) AS "Total"
        FROM (SELECT *, time_bucket(INTERVAL 2 HOUR, ts, TIMESTAMP '1970-01-01') AS s FROM events) GROUP BY 1, 2, 3
        HAVING s + INTERVAL 2 HOUR <= (SELECT date_trunc('second', max(ts)) - INTERVAL 10 MINUTE FROM events)""", []),
    "stream_deltas": (
        """SELECT user_id, event_id, CASE WHEN p IS NULL THEN 0 WHEN c < p THEN c ELSE c - p END AS counter_delta,
        CASE WHEN p IS NULL THEN 0 ELSE date_diff('second', pt, ts) END AS seconds, false AS late FROM (
        SELECT user_id, event_id, ts, event_id * 13 % 5000 AS c, lag(event_id * 13 % 5000) OVER w AS p, lag(ts) OVER w AS pt
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id * 13 % 5000, event_id))""", []),
    "stream_alerts": (
        f"""SELECT event_id, e.event_type, v AS cents, m AS "Mean", n AS "SampleSize" FROM (
        SELECT event_id, event_type, CAST(floor(value * 100) AS BIGINT) AS v FROM events) e JOIN ({_bounds(
            '(SELECT *, CAST(floor(value * 100) AS BIGINT) AS v FROM events)', 'event_type', 'v')}) b ON b.event_type = e.event_type
        WHERE v NOT BETWEEN m - 3 * sd AND m + 3 * sd""", []),
    "stream_history": (
        """SELECT strftime(ts, '%Y-%m-%d') AS snapshot_date, event_type, count(*) AS n,
        CAST(sum(CAST(floor(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1, 2""", []),
}


for _same, _as in {
    "stream_alerts_joined": "stream_alerts", "cpu_records_of_files": "cpu_samples", "previous_event_hot_keys": "previous_event", "delivery_rate_hot_keys": "delivery_rate",
    "alert_detail_of_flagged": "alert_detail", "alert_run": "alert_detail", "orders_with_customer_hot_keys": "orders_with_customer", "job_outliers_hot_keys": "job_outliers",
    "tables_with_statistics_co_located": "tables_with_statistics", "file_io_in_steps": "file_io",
}.items():
    _BODY[_same] = _BODY[_as]


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {name: _with(body, *ctes) for name, (body, ctes) in _BODY.items()}
