"""Schemas of the history tables. Surrogate row ids are left out.

Fixed values: table and column names readers of the history already use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_DDL = {
    "version": "Version STRING, Date TIMESTAMP_NTZ",
    "jobs": """JobName STRING, JobFailStep INT, JobFailMessage STRING, RunDateTime TIMESTAMP_NTZ,
        JobDurationSeconds INT, RunStatus INT, owner STRING, source STRING, Date TIMESTAMP_NTZ""",
    "errors": "Date TIMESTAMP_NTZ, TableName STRING, Message STRING",
    "fragmentation": """DB_Name STRING, Table_Name STRING, Index_ID INT, Index_Name STRING,
        Avg_Fragmentation DECIMAL(4,1), Date TIMESTAMP_NTZ, page_count BIGINT, partition_number INT""",
    "statistics": """DB_Name STRING, Table_Name STRING, Index_Name STRING, LastUpdateDate TIMESTAMP_NTZ,
        rowmodctr DECIMAL(16,0), Date TIMESTAMP_NTZ""",
    "table_usage": """DatabaseName STRING, TableName STRING, TotalAccesses DECIMAL(18,0), TotalWrites DECIMAL(18,0),
        PercentAccessesAreWrites DECIMAL(5,2), TotalReads DECIMAL(18,0), PercentAccessesAreReads DECIMAL(5,2),
        ReadSeeks DECIMAL(18,0), PercentReadsAreIndexSeeks DECIMAL(5,2), ReadScans DECIMAL(18,0),
        PercentReadsAreIndexScans DECIMAL(5,2), Date TIMESTAMP_NTZ""",
    "routine_catalog": """DB_Name STRING, SP_Name STRING, Create_Date TIMESTAMP_NTZ, Modify_Date TIMESTAMP_NTZ,
        Execution_Count DECIMAL(18,0), Date TIMESTAMP_NTZ""",
    "index_usage": """DB_Name STRING, Table_Name STRING, Index_Name STRING, user_seeks DECIMAL(18,0),
        user_scans DECIMAL(18,0), user_lookups DECIMAL(18,0), user_updates DECIMAL(18,0),
        last_user_seek TIMESTAMP_NTZ, last_user_scan TIMESTAMP_NTZ, last_user_lookup TIMESTAMP_NTZ,
        last_user_update TIMESTAMP_NTZ, type_desc STRING, fill_factor DECIMAL(18,0), is_primary_key BOOLEAN,
        Date TIMESTAMP_NTZ""",
    "routine_exec": """DB_Name STRING, `SP Name` STRING, execution_count BIGINT, `Calls/Second` BIGINT,
        AvgWorkerTime BIGINT, TotalWorkerTime BIGINT, total_elapsed_time BIGINT, avg_elapsed_time BIGINT,
        cached_time TIMESTAMP_NTZ, TotalLogicalReads BIGINT, AvgLogicalReads BIGINT, TotalLogicalWrites BIGINT,
        AvgLogicalWrites BIGINT, Date TIMESTAMP_NTZ""",
    "index_free_space": """DB_Name STRING, Table_Name STRING, Index_ID INT, Index_Name STRING, Type STRING,
        Total_MBs INT, Free_Space_MBs INT, Free_Space_Percent DECIMAL(4,1), Date TIMESTAMP_NTZ""",
    "table_rows": "DatabaseName STRING, TableNameFull STRING, TableName STRING, RowCount BIGINT, Date TIMESTAMP_NTZ",
    "hit_ratio": "Buffer_Cache_Hit_Ratio DECIMAL(5,3), Date TIMESTAMP_NTZ",
    "parameters": "Item STRING, SP_Name STRING, Class STRING, Date TIMESTAMP_NTZ",
    "top_queries": """name STRING, DB_Name STRING, execution_count BIGINT, total_logical_reads BIGINT,
        last_logical_reads BIGINT, total_logical_writes BIGINT, last_logical_writes BIGINT,
        total_elapsed_time_in_S BIGINT, last_elapsed_time_in_S BIGINT, AvgExecutionDuration1000sOfSeconds BIGINT,
        AvgPhysicalReads BIGINT, MinPhysicalReads BIGINT, MaxPhysicalReads BIGINT, AvgPhysicalReads_kbsize BIGINT,
        MinPhysicalReads_kbsize BIGINT, MaxPhysicalReads_kbsize BIGINT, CreationDateTime TIMESTAMP_NTZ,
        last_execution_time TIMESTAMP_NTZ, query_text STRING, query_plan STRING, missing_index_info BOOLEAN,
        Date TIMESTAMP_NTZ""",
    "delivery": """name STRING, id INT, start_time TIMESTAMP_NTZ, runstatus INT, time TIMESTAMP_NTZ,
        delivered_commands INT, seconds INT, commands INT, commands_per_Minute INT, DateKey INT, Hour INT, Minute INT""",
    "locks": """spid INT, dbid INT, objId INT, indId INT, Type STRING, resource STRING, Mode STRING, status STRING,
        blocking_session_id INT, text STRING, host_name STRING, program_name STRING, login_name STRING,
        login_time TIMESTAMP_NTZ, DateTime TIMESTAMP_NTZ""",
    "file_io": """serID INT, dbID BIGINT, database_drive STRING, database_file_name STRING, NumberReads BIGINT,
        NumberWrites BIGINT, TotalIO BIGINT, MBsRead BIGINT, MBsWritten BIGINT, TotalMBs BIGINT, IoStallReadMS BIGINT,
        IoStallWriteMS BIGINT, IoStallMS BIGINT, AvgStallPerReadIO BIGINT, AvgStallPerWriteIO BIGINT,
        AvgStallPerIO BIGINT, report_date_time_start TIMESTAMP_NTZ, report_date_time_end TIMESTAMP_NTZ,
        TimeStamp TIMESTAMP_NTZ""",
    "servers": """serID INT, server_name STRING, instance_name STRING, server_type STRING, use_category STRING,
        ip_address STRING, sql_version_num STRING, sql_version STRING, sql_edition STRING, sql_physical_cpus INT,
        sql_logical_cpus INT, license_type STRING, description STRING, location_physical STRING, it_owner STRING,
        business_owner STRING, virtual BOOLEAN, active BOOLEAN, build_date TIMESTAMP_NTZ,
        decommision_date TIMESTAMP_NTZ, line_of_business STRING, sensitive_data BOOLEAN, windows_version_num STRING,
        Avamar BOOLEAN, daily_check BOOLEAN, SQL_not_running BOOLEAN, Delta_Monitored BOOLEAN, Divestiture BOOLEAN,
        sql_service_name STRING, sql_agent_service_name STRING, special_monitor BOOLEAN, AvailableRAM INT,
        MaxSQLRAM INT""",
    "databases": """dbID BIGINT, serID INT, server_name STRING, database_name STRING, description STRING,
        it_owner STRING, business_owner STRING, active BOOLEAN, build_date TIMESTAMP_NTZ,
        decommision_date TIMESTAMP_NTZ, line_of_business STRING, autogrow BOOLEAN, autogrow_growth INT,
        autogrow_growth_tpye STRING, autogrow_max_size BIGINT, date_time_added TIMESTAMP_NTZ""",
    "recent_runs": "DB_Name STRING, SP_Name STRING, last_elapsed_time BIGINT, Date TIMESTAMP_NTZ",
    "flagged_routines": "SP_Name STRING",
    "alerts": "SPName STRING, last_elapsed_time BIGINT, Mean BIGINT, UpprBnd BIGINT, Date TIMESTAMP_NTZ",
    "packets": """PacketsReceivedBase BIGINT, PacketsSentBase BIGINT, PacketErrorsBase BIGINT, Date TIMESTAMP_NTZ,
        seconds INT, PacketsReceived INT, PacketsSent INT, PacketErrors INT""",
    "cpu": "Date TIMESTAMP_NTZ, SQLProcessUtilization INT, SystemIdle INT, OtherProcessUtilization INT",
    "batch_requests": """object_name STRING, counter_name STRING, cntr_value BIGINT, Date TIMESTAMP_NTZ, seconds INT,
        requests BIGINT""",
    "memory": """Total_Physical_Memory_KB BIGINT, Total_Physical_Memory_KB_Available BIGINT,
        Total_Virtual_Memory_KB BIGINT, Total_Virtual_Memory_KB_Available BIGINT, Total_Page_File_Memory_KB BIGINT,
        Total_Page_File_Memory_KB_Available BIGINT, Total_System_Cache_Memory_KB_Available BIGINT,
        Mem_Needed_KB_Per_Current_Workload BIGINT, Mem_Used_KB_Maintaining_Connections BIGINT,
        Mem_Used_KB_Locks BIGINT, Mem_Used_KB_Dynamic_Cache BIGINT, Mem_Used_KB_Query_Optimization BIGINT,
        Mem_Used_KB_Hash_Sort_Index_Operations BIGINT, Mem_Used_KB_Cursors BIGINT, Mem_Used_KB_SQLServer BIGINT,
        Locked_Pages_Used_SQLServer_KB BIGINT, Total_VAS_KB BIGINT, Memory_Grants_Pending BIGINT,
        System_High_Memory_Signal_State BOOLEAN, System_Low_Memory_Signal_State BOOLEAN,
        Process_Physical_Memory_Low BOOLEAN, Process_Virtual_Memory_Low BOOLEAN, Free_List_Stalls_Per_Sec BIGINT,
        Checkpoint_Pages_Per_Sec BIGINT, Lazy_Writes_Per_Sec BIGINT, Date TIMESTAMP_NTZ""",
    "page_life": "Page_Life_Expectancy INT, Date TIMESTAMP_NTZ",
}

# Days of history kept. Tables that are not listed keep everything.
RETENTION_DAYS = {
    "fragmentation": 180, "statistics": 180, "table_usage": 180, "routine_catalog": 180, "routine_exec": 180,
    "top_queries": 180, "index_free_space": 180, "table_rows": 180, "index_usage": 180 + 185, "cpu": 180,
    "batch_requests": 180, "memory": 180, "page_life": 180, "hit_ratio": 180, "jobs": 180, "packets": 180,
    "file_io": 180,
}

# The load stamp of each table where it is not "Date".
STAMP = {"file_io": "report_date_time_end", "delivery": "time", "locks": "DateTime"}

TABLES = list(_DDL)


def schema(table: str) -> StructType:
    """Schema of a history table."""
    return StructType.fromDDL(_DDL[table])


def conform(df: DataFrame, table: str, extra=()) -> DataFrame:
    """Cast and order the columns of ``df`` as the history table has them; absent ones become NULL.

    ``extra`` names further columns to keep in front, such as ``server_name``.
    """
    have = set(df.columns)
    return df.select(
        *extra,
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema(table)
            if f.name not in extra
        ],
    )
