"""Sample tables in the roles of history tables and landed extracts.

Every function maps whole tables by projection; the reports and collectors then
run on the result as they would on real history. ``EVENTS_AT`` and ``SALES_AT``
are the fixed "now" of the event and of the sales tables.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparts import date_key, ts_lit
from ..operators.rollup import usage_share

EVENTS_AT = "2024-01-31 00:00:00"
SALES_AT = "2001-08-01 00:00:00"


class Tables:
    """The sample tables of one scale, opened on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self.__dict__[name] = df
        return df


def once(fn):
    """Build a role once per set of tables."""
    key = f"role {fn.__name__}"

    @wraps(fn)
    def build(t: Tables) -> DataFrame:
        if key not in t.__dict__:
            t.__dict__[key] = fn(t)
        return t.__dict__[key]

    return build


def _id(prefix: str, key: str | Column) -> Column:
    return F.concat(F.lit(prefix), (F.col(key) if isinstance(key, str) else key).cast("string"))


def _whole(x: Column) -> Column:
    return F.floor(x).cast("bigint")


def _days_ago(at: str, days: Column) -> Column:
    return ts_lit(at) - F.make_dt_interval(days.cast("int"))


def _month(ts: str) -> Column:
    return F.trunc(ts, "month").cast("timestamp_ntz")


def _week(ts: str) -> Column:
    return F.trunc(ts, "week").cast("timestamp_ntz")


def cents(name: str) -> Column:
    return _whole(F.col(name) * 100)


# ---------------------------------------------------------------- history tables

@once
def jobs(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_type").alias("JobName"),
        F.when(F.col("user_id") % 10 == 9, 1).otherwise(0).alias("JobFailStep"),
        F.col("props").alias("JobFailMessage"), F.col("ts").alias("RunDateTime"),
        cents("value").cast("int").alias("JobDurationSeconds"),
        F.when(F.col("event_id") % 4 == 0, 0).otherwise(1).alias("RunStatus"),
        _id("owner_", F.col("user_id") % 3).alias("owner"),
        F.when(F.col("user_id") % 2 == 0, "SQLAgent").otherwise("SSIS").alias("source"), F.col("ts").alias("Date"),
    )


@once
def job_servers(t: Tables) -> DataFrame:
    """The server of each job owner, named after a region."""
    return t.region.select(
        _id("owner_", "r_regionkey").alias("owner"), F.col("r_name").alias("server_name")
    )


@once
def routine_exec(t: Tables) -> DataFrame:
    line = F.col("l_linenumber").cast("bigint")
    elapsed = cents("l_extendedprice") * line * line * line
    runs = F.col("l_quantity").cast("bigint")
    return t.lineitem.select(
        _id("db_", "l_returnflag").alias("DB_Name"), _id("sp_", "l_suppkey").alias("SP Name"),
        runs.alias("execution_count"), elapsed.alias("total_elapsed_time"),
        F.call_function("div", elapsed, runs).alias("avg_elapsed_time"), _month("l_shipdate").alias("cached_time"),
        _whole(F.col("l_extendedprice")).alias("TotalLogicalReads"), (runs * line).alias("TotalLogicalWrites"),
        F.col("l_shipdate").alias("Date"),
    )


def _partner(has: Column, key: str) -> Column:
    """The key where the row has a partner, else a number that no other table has."""
    return F.when(has, F.col(key)).otherwise(-1 - F.col(key))


def _part_database(key: str) -> Column:
    slot = F.col(key) % 5
    return F.when(slot == 0, "tempdb").otherwise(_id("db_", slot))


def _tens(flag: str) -> Column:
    used = F.when(F.col("l_returnflag") == flag, F.col("l_quantity") * 10).otherwise(0)
    return used.cast("decimal(18,0)")


@once
def index_usage(t: Tables) -> DataFrame:
    line = F.col("l_linenumber")
    lookups = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.col("l_quantity")).otherwise(0)
    return t.lineitem.select(
        _part_database("l_partkey").alias("DB_Name"), _id("part_", "l_partkey").alias("Table_Name"),
        F.when(line < 7, _id("ix_", "l_suppkey")).alias("Index_Name"), _tens("R").alias("user_seeks"),
        _tens("A").alias("user_scans"), lookups.cast("decimal(18,0)").alias("user_lookups"),
        _tens("N").alias("user_updates"), F.when(line == 1, "CLUSTERED").otherwise("NONCLUSTERED").alias("type_desc"),
        (line * 10).cast("decimal(18,0)").alias("fill_factor"), (line == 1).alias("is_primary_key"),
        F.col("l_shipdate").alias("Date"),
    )


@once
def table_rows(t: Tables) -> DataFrame:
    """Three weekly row counts per table; a quarter of the tables never change."""
    key, week = F.col("p_partkey"), F.col("week")
    return t.part.select("p_partkey", "p_retailprice", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("week")).select(
        _part_database("p_partkey").alias("DatabaseName"),
        F.concat(F.lit("[dbo].["), _id("part_", "p_partkey"), F.lit("]")).alias("TableNameFull"),
        _id("part_", "p_partkey").alias("TableName"),
        (cents("p_retailprice") + week * (key % 4) * 50).alias("RowCount"),
        _days_ago(SALES_AT, 2 + 4 * week + key % 3).alias("Date"),
    )


@once
def table_usage(t: Tables) -> DataFrame:
    usage = index_usage(t).filter(F.col("Date") <= ts_lit(SALES_AT)).withColumnsRenamed(
        {"DB_Name": "DatabaseName", "Table_Name": "TableName"}
    )
    shares = usage_share(usage, ["DatabaseName", "TableName"], "user_seeks", "user_scans", "user_updates")
    return shares.withColumn("Date", _days_ago(SALES_AT, F.lit(1)))


def _sales_stamp() -> Column:
    return _days_ago(SALES_AT, F.col("l_orderkey") % 10)


@once
def statistics(t: Tables) -> DataFrame:
    prefix = F.when(F.col("l_linenumber") == 7, "_WA_").otherwise("ix_")
    return t.lineitem.select(
        _part_database("l_partkey").alias("DB_Name"), _id("part_", "l_partkey").alias("Table_Name"),
        F.concat(prefix, F.col("l_suppkey").cast("string")).alias("Index_Name"),
        F.col("l_shipdate").alias("LastUpdateDate"),
        _whole(F.col("l_extendedprice") * 10).cast("decimal(16,0)").alias("rowmodctr"), _sales_stamp().alias("Date"),
    )


@once
def fragmentation(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _part_database("l_partkey").alias("DB_Name"), _id("part_", "l_partkey").alias("Table_Name"),
        F.col("l_linenumber").alias("Index_ID"), _id("ix_", "l_suppkey").alias("Index_Name"),
        F.round(F.col("l_discount") * 1000).cast("decimal(4,1)").alias("Avg_Fragmentation"),
        _sales_stamp().alias("Date"), F.col("l_quantity").cast("bigint").alias("page_count"),
        F.lit(1).alias("partition_number"),
    )


@once
def free_space(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _part_database("l_partkey").alias("DB_Name"), _id("part_", "l_partkey").alias("Table_Name"),
        F.col("l_linenumber").alias("Index_ID"), _id("ix_", "l_suppkey").alias("Index_Name"),
        F.col("l_linestatus").alias("Type"), _whole(F.col("l_extendedprice") / 100).cast("int").alias("Total_MBs"),
        (F.col("l_quantity") * 2).cast("int").alias("Free_Space_MBs"),
        F.round(F.col("l_tax") * 1000).cast("decimal(4,1)").alias("Free_Space_Percent"), _sales_stamp().alias("Date"),
    )


@once
def databases(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("dbID"), (F.col("s_suppkey") % 25).cast("int").alias("serID"),
        _id("server_", F.col("s_suppkey") % 25).alias("server_name"), F.col("s_name").alias("database_name"),
    )


@once
def io_intervals(t: Tables) -> DataFrame:
    """Order-to-shipment intervals as file I/O; some ship before the order, which gives negative intervals."""
    count = F.col("l_quantity").cast("bigint")
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_suppkey") % 25).cast("int").alias("serID"), F.col("l_suppkey").alias("dbID"),
        F.col("l_returnflag").alias("database_drive"), _id("file_", "l_linenumber").alias("database_file_name"),
        F.when(F.col("l_returnflag") == "R", count).otherwise(0).cast("bigint").alias("NumberReads"),
        F.when(F.col("l_returnflag") != "R", count * 3).otherwise(0).cast("bigint").alias("NumberWrites"),
        _whole(F.col("l_extendedprice")).alias("MBsRead"), cents("l_tax").alias("MBsWritten"),
        cents("l_extendedprice").alias("IoStallReadMS"), cents("o_totalprice").alias("IoStallWriteMS"),
        F.col("o_orderdate").alias("report_date_time_start"), F.col("l_shipdate").alias("report_date_time_end"),
    )


# ---------------------------------------------------------------- counters

@once
def batch_samples(t: Tables) -> DataFrame:
    """A counter per user that grows and falls back every few samples."""
    return t.events.select(
        F.lit("SQLServer:SQL Statistics").alias("object_name"),
        _id("Batch Requests/sec ", "user_id").alias("counter_name"),
        (F.col("event_id") * 13 % 5000).alias("cntr_value"), F.col("ts").alias("Date"),
    )


@once
def packet_samples(t: Tables) -> DataFrame:
    return t.events.select(
        _id("server_", F.col("user_id") % 20).alias("server_name"),
        (F.col("event_id") * 13 % 5000).alias("PacketsReceivedBase"),
        (F.col("event_id") * 7 % 9000).alias("PacketsSentBase"), (F.col("event_id") % 100).alias("PacketErrorsBase"),
        F.col("ts").alias("Date"),
    )


@once
def io_samples(t: Tables) -> DataFrame:
    """Cumulative file counters, restarted each week."""
    n = F.col("event_id")
    return t.events.select(
        (F.col("user_id") % 5).cast("int").alias("serID"), F.col("user_id").alias("dbID"),
        F.lit("C").alias("database_drive"), _id("file_", "user_id").alias("database_file_name"),
        (n * 10).alias("NumberReads"), (n * 3).alias("NumberWrites"), (n * 2).alias("MBsRead"), n.alias("MBsWritten"),
        (n * n % 1_000_003).alias("IoStallReadMS"), (n * 5).alias("IoStallWriteMS"),
        F.col("ts").alias("report_date_time_end"), _week("ts").alias("TimeStamp"),
    )


@once
def delivery_history(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").alias("agent_id"), _week("ts").alias("start_time"),
        (F.col("event_id") % 6).cast("int").alias("runstatus"), F.col("ts").alias("time"),
        (F.col("event_id") % 3000).cast("int").alias("delivered_commands"),
    )


@once
def agents(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


@once
def counter_rows(t: Tables) -> DataFrame:
    """Counter rows per server and day, with the blank padding of the source."""
    kind = F.col("event_type")

    def names(view, click, purchase, signup, error):
        out = F.lit(error)
        for event, text in (("view", view), ("click", click), ("purchase", purchase), ("signup", signup)):
            out = F.when(kind == event, text).otherwise(out)
        return out

    return t.events.select(
        _id("server_", F.col("user_id") % 5).alias("server_name"), F.to_date("ts").cast("string").alias("day"),
        F.rpad(
            names("SQLServer:Memory Manager", "SQLServer:Buffer Manager", "SQLServer:Buffer Manager",
                  "SQLServer:Buffer Manager", "SQLServer:Buffer Manager"), 40, " "
        ).alias("object_name"),
        F.rpad(
            names("Target Server Memory (KB)", "Buffer cache hit ratio", "Buffer cache hit ratio base",
                  "Page life expectancy", "Lazy writes/sec"), 40, " "
        ).alias("counter_name"),
        F.lit("").alias("instance_name"),
        F.when(kind == "purchase", cents("value") + 50_000).otherwise(cents("value")).alias("cntr_value"),
    )


@once
def ring_records(t: Tables) -> DataFrame:
    """Health records as XML; some lack the idle node."""
    n = F.col("event_id")
    idle = F.when(F.col("user_id") % 7 != 0, F.concat(F.lit("<SystemIdle>"), (n % 60).cast("string"),
                                                      F.lit("</SystemIdle>"))).otherwise(F.lit(""))
    return t.events.select(
        (F.lit(200_000_000).cast("bigint") - n * 17 % 100_000 * 1000).alias("timestamp"),
        F.concat(
            F.lit('<Record id="'), n.cast("string"), F.lit('"><SchedulerMonitorEvent><SystemHealth>'), idle,
            F.lit("<ProcessUtilization>"), (n % 41).cast("string"),
            F.lit("</ProcessUtilization></SystemHealth></SchedulerMonitorEvent></Record>"),
        ).alias("record"),
    )


# ---------------------------------------------------------------- job sources

@once
def agent_job_names(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("job_id"), F.col("c_name").alias("name"))


@once
def agent_runs(t: Tables) -> DataFrame:
    n = F.col("o_orderkey")
    return t.orders.select(
        F.col("o_custkey").alias("job_id"), date_key("o_orderdate").alias("run_date"),
        (n % 24 * 10_000 + n % 60 * 100 + n * 7 % 60).cast("int").alias("run_time"),
        (n % 130 * 10_000 + n % 60 * 100 + n * 3 % 60).cast("int").alias("run_duration"),
        F.concat(F.lit("The job ended. Priority "), "o_orderpriority", F.lit(" asked by customer number "),
                 F.col("o_custkey").cast("string")).alias("message"),
        (n % 3).cast("int").alias("step_id"), (n % 2).cast("int").alias("run_status"),
    )


@once
def report_log(t: Tables) -> DataFrame:
    return t.events.select(
        F.concat(F.lit("/"), "event_type").alias("ReportPath"), F.col("props").alias("Parameters"),
        F.col("ts").alias("TimeStart"), F.col("ts").alias("TimeEnd"), cents("value").alias("TimeDataRetrieval"),
        (F.col("event_id") % 1000).alias("TimeProcessing"), F.col("user_id").alias("TimeRendering"),
        F.when(F.col("user_id") % 5 == 0, "rsProcessingAborted").otherwise("rsSuccess").alias("Status"),
        _id("user_", "user_id").alias("UserName"),
    )


@once
def etl_stats(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _id("Package.", "l_linenumber").alias("execution_path"), F.col("l_shipdate").alias("start_time"),
        F.col("l_shipdate").alias("end_time"), _whole(F.col("l_extendedprice") * 10).alias("execution_duration"),
        (F.col("l_suppkey") % 3).cast("int").alias("execution_result"),
    )


# ---------------------------------------------------------------- catalogue extracts

def _catalog_database(key: str) -> Column:
    return _id("db_", F.col(key) % 5)


@once
def objects(t: Tables) -> DataFrame:
    """Neighbouring parts share a name, so names repeat across databases."""
    key = F.col("p_partkey")
    kind = F.when(F.col("p_size") % 3 == 0, "U").when(F.col("p_size") % 3 == 1, "P").otherwise("FN")
    return t.part.select(
        _catalog_database("p_partkey").alias("DB_Name"), (key + 101).alias("object_id"),
        F.col("p_type").alias("schema_name"), _id("obj_", F.floor(key / 2).cast("bigint")).alias("name"),
        kind.alias("type"), (F.col("p_size") % 10 == 0).alias("is_ms_shipped"),
        (F.lit("2000-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval((key % 300).cast("int"))).alias("create_date"),
        (F.lit("2001-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval((key % 100).cast("int"))).alias("modify_date"),
    )


@once
def indexes(t: Tables) -> DataFrame:
    """Up to five indexes per object."""
    key, n = F.col("p_partkey"), F.col("index_id")
    spread = t.part.select("p_partkey", F.explode(F.sequence(F.lit(1), (F.lit(1) + F.col("p_partkey") % 5).cast("int"))).alias("index_id"))
    return spread.select(
        _catalog_database("p_partkey").alias("DB_Name"), (key % 5 + 4).cast("int").alias("database_id"),
        (key + 101).alias("object_id"), "index_id", F.concat(_id("ix_", "p_partkey"), _id("_", "index_id")).alias("name"),
        F.when(n == 1, "CLUSTERED").otherwise("NONCLUSTERED").alias("type_desc"), (n * 10).alias("fill_factor"),
        (n == 1).alias("is_primary_key"),
    )


@once
def usage_extract(t: Tables) -> DataFrame:
    def used(flag):
        return F.when(F.col("l_returnflag") == flag, F.col("l_quantity")).otherwise(0).cast("bigint")

    never = F.lit(None).cast("timestamp_ntz")
    return t.lineitem.select(
        _catalog_database("l_partkey").alias("DB_Name"), (F.col("l_partkey") + 101).alias("object_id"),
        F.col("l_linenumber").alias("index_id"), used("R").alias("user_seeks"), used("A").alias("user_scans"),
        used("X").alias("user_lookups"), used("N").alias("user_updates"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("last_user_seek"),
        F.when(F.col("l_returnflag") == "A", F.col("l_shipdate")).alias("last_user_scan"),
        never.alias("last_user_lookup"),
        F.when(F.col("l_returnflag") == "N", F.col("l_shipdate")).alias("last_user_update"),
    )


@once
def physical_extract(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _catalog_database("l_partkey").alias("DB_Name"), (F.col("l_partkey") + 101).alias("object_id"),
        F.col("l_linenumber").alias("index_id"), (F.col("l_discount") * 1000).alias("avg_fragmentation_in_percent"),
        F.col("l_quantity").cast("bigint").alias("page_count"), (F.col("l_orderkey") % 3).cast("int").alias("partition_number"),
    )


@once
def statistics_extract(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _catalog_database("l_partkey").alias("DB_Name"), (F.col("l_partkey") + 101).alias("object_id"),
        _id("st_", "l_linenumber").alias("name"), F.col("l_shipdate").alias("LastUpdateDate"),
        F.col("l_quantity").cast("bigint").alias("rowmodctr"),
    )


@once
def partition_rows(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _catalog_database("l_partkey").alias("DB_Name"), (F.col("l_partkey") + 101).alias("object_id"),
        (F.col("l_linenumber") - 1).alias("index_id"), F.col("l_quantity").cast("bigint").alias("rows"),
    )


@once
def cached_plans(t: Tables) -> DataFrame:
    """One cached plan per sale of a part, named after the part's object."""
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.when(F.col("l_linenumber") < 7, _catalog_database("l_partkey")).alias("plan_DB_Name"),
        F.col("p_type").alias("plan_schema"), _id("obj_", F.floor(F.col("l_partkey") / 2).cast("bigint")).alias("plan_name"),
        F.when(F.col("l_linestatus") == "F", "Proc").otherwise("Adhoc").alias("objtype"),
        F.col("l_quantity").cast("bigint").alias("usecounts"),
    )


@once
def procedures(t: Tables) -> DataFrame:
    return t.supplier.select(
        _catalog_database("s_suppkey").alias("DB_Name"), F.col("s_suppkey").alias("object_id"),
        F.col("s_name").alias("name"),
    )


@once
def procedure_stats(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _catalog_database("l_suppkey").alias("DB_Name"), F.col("l_suppkey").alias("object_id"),
        F.col("l_quantity").cast("bigint").alias("execution_count"), F.col("l_shipdate").alias("cached_time"),
        cents("l_extendedprice").alias("total_worker_time"),
        (cents("l_extendedprice") * F.col("l_linenumber")).alias("total_elapsed_time"),
        (F.col("l_linenumber") * 3).cast("bigint").alias("total_logical_reads"),
        F.col("l_linenumber").cast("bigint").alias("total_logical_writes"),
    )


@once
def query_stats(t: Tables) -> DataFrame:
    n, spent = F.col("o_orderkey"), cents("o_totalprice") * 10
    return t.orders.select(
        F.col("o_custkey").alias("sql_handle"), n.alias("plan_handle"), (n % 50 + 1).alias("execution_count"),
        (n * 3).alias("total_logical_reads"), n.alias("last_logical_reads"), (n * 2).alias("total_logical_writes"),
        n.alias("last_logical_writes"), spent.alias("total_elapsed_time"),
        F.call_function("div", spent, n % 50 + 1).alias("last_elapsed_time"), (n * 11).alias("total_physical_reads"),
        (n % 7).alias("min_physical_reads"), (n % 7 + 9).alias("max_physical_reads"),
        F.col("o_orderdate").alias("creation_time"), F.col("o_orderdate").alias("last_execution_time"),
        (n % 5 * 2).cast("int").alias("statement_start_offset"),
        F.when(n % 3 == 0, -1).otherwise(n % 5 * 2 + 20).cast("int").alias("statement_end_offset"),
    )


@once
def query_texts(t: Tables) -> DataFrame:
    return t.customer.select(
        _partner(F.col("c_mktsegment") != "MACHINERY", "c_custkey").alias("sql_handle"), F.concat(F.lit("select * from "), "c_name").alias("text"),
        F.col("c_name").alias("object_name"), F.col("c_mktsegment").alias("DB_Name"),
    )


@once
def query_plans(t: Tables) -> DataFrame:
    return t.orders.select(
        _partner(F.col("o_orderstatus") != "P", "o_orderkey").alias("plan_handle"), _id("<plan/>", "o_orderkey").alias("query_plan")
    )


@once
def buffers(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _catalog_database("l_suppkey").alias("DB_Name"),
        (F.col("l_suppkey") * 2 + F.col("l_linenumber") % 2).alias("allocation_unit_id"),
        F.when(F.col("l_linenumber") != 3, F.col("l_returnflag") == "R").alias("is_modified"),
        (_whole(F.col("l_extendedprice")) % 8096).cast("int").alias("free_space_in_bytes"),
    )


@once
def _units(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", "s_name", F.explode(F.array(F.lit(0), F.lit(1))).alias("n"))


@once
def allocation_units(t: Tables) -> DataFrame:
    unit = F.col("s_suppkey") * 2 + F.col("n")
    return _units(t).select(
        _catalog_database("s_suppkey").alias("DB_Name"), unit.alias("allocation_unit_id"),
        (unit + 1_000_000).alias("container_id"),
    )


@once
def unit_partitions(t: Tables) -> DataFrame:
    return _units(t).select(
        _catalog_database("s_suppkey").alias("DB_Name"),
        (F.col("s_suppkey") * 2 + F.col("n") + 1_000_000).alias("partition_id"),
        (F.col("s_suppkey") + 99).alias("object_id"), (F.col("n") + 1).alias("index_id"),
    )


@once
def unit_indexes(t: Tables) -> DataFrame:
    return _units(t).select(
        _catalog_database("s_suppkey").alias("DB_Name"), (F.col("s_suppkey") + 99).alias("object_id"),
        (F.col("n") + 1).alias("index_id"), F.concat(_id("ix_", "s_suppkey"), _id("_", "n")).alias("name"),
        F.when(F.col("n") == 0, "CLUSTERED").otherwise("NONCLUSTERED").alias("type_desc"),
    )


@once
def unit_objects(t: Tables) -> DataFrame:
    return t.supplier.select(
        _catalog_database("s_suppkey").alias("DB_Name"), (F.col("s_suppkey") + 99).alias("object_id"),
        F.col("s_name").alias("name"),
    )


# ---------------------------------------------------------------- alerts, locks, servers, text

@once
def user_procedures(t: Tables) -> DataFrame:
    return t.customer.select(
        _catalog_database("c_custkey").alias("DB_Name"), F.col("c_custkey").alias("object_id"),
        F.col("c_name").alias("name"),
    )


@once
def user_runs(t: Tables) -> DataFrame:
    return t.events.select(
        _catalog_database("user_id").alias("DB_Name"), (F.col("user_id") % 5 + 4).alias("database_id"),
        F.col("user_id").alias("object_id"), cents("value").alias("last_elapsed_time"),
        F.col("ts").alias("last_execution_time"),
    )


@once
def user_history(t: Tables) -> DataFrame:
    """Execution history of the users' procedures."""
    return t.events.join(t.customer, F.col("user_id") == F.col("c_custkey")).select(
        _catalog_database("user_id").alias("DB_Name"), F.col("c_name").alias("SP Name"),
        cents("value").alias("avg_elapsed_time"), F.col("ts").alias("Date"),
    )


@once
def exclusions(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_mktsegment") == "MACHINERY").select(F.col("c_name").alias("Item"))


@once
def lock_rows(t: Tables) -> DataFrame:
    n = F.col("event_id")
    return t.events.select(
        F.col("user_id").cast("int").alias("spid"), (n % 5).cast("int").alias("dbid"),
        (n % 97).cast("int").alias("objId"), (n % 3).cast("int").alias("indId"), F.lit("KEY ").alias("Type"),
        F.rpad("event_type", 32, " ").alias("resource"), F.lit("X       ").alias("Mode"),
        F.lit("GRANT ").alias("status"),
    )


@once
def requests(t: Tables) -> DataFrame:
    return t.customer.select(
        _partner(F.col("c_mktsegment").isin("BUILDING", "FURNITURE"), "c_custkey").cast("int").alias("session_id"), F.col("c_nationkey").alias("sql_handle"),
        (F.col("c_custkey") % 7).cast("int").alias("blocking_session_id"),
    )


@once
def request_texts(t: Tables) -> DataFrame:
    return t.nation.select(
        _partner(F.col("n_regionkey") < 4, "n_nationkey").alias("sql_handle"), F.concat(F.lit("exec "), "n_name").alias("text")
    )


@once
def sessions(t: Tables) -> DataFrame:
    return t.customer.select(
        _partner(F.col("c_acctbal") > 0, "c_custkey").cast("int").alias("session_id"), F.col("c_mktsegment").alias("host_name"),
        F.lit("app").alias("program_name"), F.col("c_name").alias("login_name"),
        F.lit("2024-01-01 08:00:00").cast("timestamp_ntz").alias("login_time"),
    )


@once
def lock_databases(t: Tables) -> DataFrame:
    return t.region.select(
        F.col("r_regionkey").alias("database_id"),
        F.when(F.col("r_regionkey") == 4, "tempdb").otherwise(F.col("r_name")).alias("name"),
    )


@once
def lock_objects(t: Tables) -> DataFrame:
    kind = F.when(F.col("p_size") == 1, "change_tracking_").otherwise("part_")
    return t.part.join(lock_databases(t), (F.col("p_partkey") % 5) == F.col("database_id")).select(
        F.col("name").alias("DB_Name"), F.col("p_partkey").cast("int").alias("object_id"),
        F.concat(kind, F.col("p_partkey").cast("string")).alias("ObjectLabel"),
    ).withColumnRenamed("ObjectLabel", "name")


@once
def servers(t: Tables) -> DataFrame:
    none = F.lit(None)
    return t.nation.select(
        F.col("n_nationkey").alias("serID"), F.col("n_name").alias("server_name"),
        F.lit("12.0").alias("sql_version_num"), F.lit("Standard").alias("sql_edition"),
        F.lit(2).alias("sql_physical_cpus"), F.lit(1).alias("sql_logical_cpus"), none.cast("string").alias("windows_version_num"),
        none.cast("int").alias("AvailableRAM"), none.cast("int").alias("MaxSQLRAM"),
    )


@once
def probes(t: Tables) -> DataFrame:
    """What all servers reported, from the balances of their suppliers; those of the last regions by names that are not registered."""
    per_server = t.supplier.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"), F.max(cents("s_acctbal")).alias("kb"))
    name = F.when(F.col("n_regionkey") < 3, F.col("n_name")).otherwise(F.concat(F.lit("new "), "n_name"))
    return per_server.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        name.alias("server_name"), _id("13.0.", "n").alias("product_version"),
        F.lit("Enterprise").alias("edition"), (F.col("n") * 4).alias("cpu_count"), F.lit(2).alias("hyperthread_ratio"),
        (F.col("kb") * 2).alias("total_physical_memory_kb"), F.col("kb").alias("total_server_memory_kb"),
        F.lit("Server 2016 (X64) on Windows NT 6.3 <X64>").alias("version_banner"),
    )


@once
def io_stats(t: Tables) -> DataFrame:
    count = F.col("l_quantity").cast("bigint")
    return t.lineitem.select(
        F.col("l_suppkey").alias("DbId"), F.col("l_linenumber").alias("FileId"), count.alias("NumberReads"),
        (count * 2).alias("NumberWrites"), (cents("l_extendedprice") * 100).alias("BytesRead"),
        (cents("l_extendedprice") * 10).alias("BytesWritten"), count.alias("IoStallReadMS"),
        (count * 4).alias("IoStallWriteMS"),
    )


@once
def io_files(t: Tables) -> DataFrame:
    spread = t.supplier.select("s_suppkey", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("file_id"))
    return spread.select(
        F.col("s_suppkey").alias("database_id"), "file_id",
        F.concat(F.element_at(F.array(*map(F.lit, "CDE")), (F.col("file_id") % 3 + 1).cast("int")), F.lit(":\\data"),
                 F.col("file_id").cast("string")).alias("physical_name"),
        _id("file_", "file_id").alias("name"),
    )


@once
def io_databases(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("database_id"), F.col("s_name").alias("name"))


@once
def modules(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("object_id"), F.col("text").alias("definition"))


@once
def module_objects(t: Tables) -> DataFrame:
    prefix = F.when(F.col("lang") == "de", "sp_MSins_").otherwise("usp_")
    start = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    return t.documents.select(
        F.col("doc_id").alias("object_id"), F.concat(prefix, F.col("doc_id").cast("string")).alias("name"),
        F.when(F.col("source") == "src0", "FN").otherwise("P").alias("type"), start.alias("create_date"),
        (start + F.make_dt_interval((F.col("n_chars") % 1000).cast("int"))).alias("modify_date"),
    )

