"""JSON log extraction and write-then-read round trips."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwh.demo.registry import money, query
from labwh.demo.tables import Tables
from labwh.functions import in_unit
from labwh.functions.dates import compact_timestamp, day_of_compact, hour_of_compact
from labwh.functions import money as as_money
from labwh.operators import counts_by_field, extract_json
from labwh.operators.dims import not_in
from labwh.sources.sinks import (
    append_snapshot,
    fresh_path,
    insert_overwrite,
    merge_stored,
    month_partition_columns,
    overwrite,
    publish_both,
    publish_partitions,
    upsert,
    upsert_partitions,
)
from labwh.sources.readers import partition_months, read_path, read_table, read_text


@query(oracle="""
    WITH log AS (
      SELECT event_id, event_id % 7 = 0 AS broken, event_id % 3 = 0 AS old_form,
             json_extract_string(props, '$.k') AS k, user_id
      FROM events)
    SELECT event_id,
           CASE WHEN NOT broken THEN 'U' || user_id END AS id_card_no,
           CASE WHEN NOT broken THEN k END AS pid,
           CASE WHEN NOT broken AND NOT old_form THEN k END AS new_pid,
           CAST(NULL AS VARCHAR) AS missing
    FROM log
""")
def json_log_fields(t: Tables) -> DataFrame:
    """Fields of an array payload with a fallback path; broken payloads give NULL."""
    place = F.when(F.col("event_id") % 3 == 0, "source_project").otherwise("proj")
    rest = F.concat(F.lit('", "'), place, F.lit('": '), F.col("props"))
    whole = F.concat(F.lit('[{"who": "U'), F.col("user_id").cast("string"), rest, F.lit("}]"))
    data = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("[{"), F.col("props"))).otherwise(whole)
    fields = {
        "id_card_no": ["$.who"],
        "pid": ["$.proj.k", "$.source_project.k"],
        "new_pid": ["$.proj.k"],
        "missing": ["$.nothing", "$.proj.nothing"],
    }
    log = t.events.select("event_id", data.alias("data"))
    return extract_json(log, "data", fields).drop("data")


@query(oracle="""
    SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS count, 1 AS type FROM events GROUP BY 1
    UNION ALL
    SELECT CASE WHEN event_id % 5 <> 0 THEN json_extract_string(props, '$.k') END, count(*), 2
    FROM events GROUP BY 1
""")
def json_log_counts(t: Tables) -> DataFrame:
    """Calls by person and by project in one pass; calls without an id form a row."""
    project = F.when(F.col("event_id") % 5 != 0, F.get_json_object("props", "$.k"))
    log = t.events.select(F.col("user_id").cast("string").alias("person"), project.alias("project"))
    return counts_by_field(log, {"person": 1, "project": 2}, "type", "id", "count")


@query(oracle="""
    SELECT event_id, json_extract_string(props, '$.k') AS code, event_type AS method
    FROM events
    WHERE event_type IN ('error', 'signup') AND CAST(json_extract_string(props, '$.k') AS INTEGER) <> 0
      AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0
""")
def failed_calls(t: Tables) -> DataFrame:
    """Calls filtered on fields of an escaped payload."""
    escaped = F.regexp_replace("props", '"', '\\\\\\\\"')
    log = t.events.where(F.col("event_type").isin("error", "signup"))
    log = log.select("event_id", escaped.alias("data"), F.col("event_type").alias("method"))
    out = extract_json(log, "data", {"code": ["$.k"]}, unescape=True)
    code = F.col("code").try_cast("int")
    return out.where((code != 0) & (code % 2 == 0)).select("event_id", "code", "method")


@query(oracle="""
    SELECT c_custkey, c_name,
           round(CASE WHEN c_acctbal < 1000 OR c_mktsegment = 'BUILDING' THEN c_acctbal + 1
                      ELSE c_acctbal END, 2) AS c_acctbal
    FROM customer
""")
def upsert_roundtrip(t: Tables) -> DataFrame:
    """One segment is new; it and the small balances arrive with a changed balance."""
    cols = ["c_custkey", "c_name", F.round("c_acctbal", 2).alias("c_acctbal")]
    is_new = F.col("c_mktsegment") == "BUILDING"
    old = fresh_path(t.spark, "upsert-old")
    overwrite(t.customer.where(~is_new).select(*cols), old)
    fresh = t.customer.where((F.col("c_acctbal") < 1000) | is_new).select(*cols)
    fresh = fresh.withColumn("c_acctbal", F.round(F.col("c_acctbal") + 1, 2))
    return upsert(old, fresh, ["c_custkey"], fresh_path(t.spark, "upsert-new"))


MONTH = dt.date(1998, 3, 1)


def _by_month(df: DataFrame) -> DataFrame:
    return df.groupBy(
        F.col("date_year").cast("long").alias("date_year"),
        F.col("date_month").cast("long").alias("date_month"),
    ).agg(
        F.count("*").alias("order_count"),
        F.sum(as_money("o_totalprice")).cast("double").alias("amt"),
    )


@query(oracle=f"""
    SELECT year(o_orderdate) AS date_year, month(o_orderdate) AS date_month, count(*) AS order_count,
           CAST(sum({money('o_totalprice')}) AS DOUBLE) AS amt
    FROM orders
    WHERE NOT (year(o_orderdate) = 1998 AND month(o_orderdate) = 3 AND o_orderstatus = 'P')
    GROUP BY 1, 2
""")
def dynamic_partition_roundtrip(t: Tables) -> DataFrame:
    """A month partition is replaced by its open orders; the other months stay."""
    path = fresh_path(t.spark, "orders-by-month")
    rows = month_partition_columns(
        t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice"), "o_orderdate"
    )
    cols = ["date_year", "date_month"]
    publish_partitions(rows, path, cols)
    still_open = in_unit("o_orderdate", MONTH, "month") & (F.col("o_orderstatus") != "P")
    publish_partitions(rows.where(still_open), path, cols)
    return _by_month(t.spark.read.parquet(path))


@query(oracle=f"""
    SELECT o_orderkey, year(o_orderdate) AS date_year, month(o_orderdate) AS date_month,
           CAST({money('o_totalprice')} + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS DOUBLE) AS amt
    FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) IN (2, 3)
""")
def upsert_in_partition(t: Tables) -> DataFrame:
    """Upsert into a month-partitioned table: only the touched month is rewritten."""
    path = fresh_path(t.spark, "orders-upsert")
    cols = ["date_year", "date_month"]
    amt = as_money("o_totalprice").cast("decimal(18,2)").alias("amt")
    orders = month_partition_columns(t.orders, "o_orderdate")
    rows = orders.select("o_orderkey", amt, *cols)
    publish_partitions(rows, path, cols)
    finished = orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", amt, *cols)
    touched = partition_months(finished, [MONTH, dt.date(1998, 2, 1)])
    source = touched.withColumn("amt", (F.col("amt") + 1).cast("decimal(18,2)"))
    upsert_partitions(path, source, ["o_orderkey", *cols], cols)
    out = partition_months(t.spark.read.schema(rows.schema).parquet(path), [MONTH, dt.date(1998, 2, 1)])
    return out.select(
        "o_orderkey",
        F.col("date_year").cast("long").alias("date_year"),
        F.col("date_month").cast("long").alias("date_month"),
        F.col("amt").cast("double").alias("amt"),
    )


@query(oracle=f"""
    SELECT o_orderstatus AS state,
           CAST(sum({money('o_totalprice')}) + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS DOUBLE)
             AS amt, count(*) AS n
    FROM orders GROUP BY o_orderstatus
""")
def stored_report_merge(t: Tables) -> DataFrame:
    """A stored report merged with fresh rows and read back from its new place."""
    amt = F.sum(as_money("o_totalprice")).cast("decimal(28,2)").alias("amt")
    stored = t.orders.groupBy(F.col("o_orderstatus").alias("state")).agg(amt, F.count("*").alias("n"))
    path = fresh_path(t.spark, "report-old")
    overwrite(stored, path)
    kept = t.spark.read.parquet(path)
    fresh = kept.where(F.col("state") == "F").select(
        "state",
        (F.col("amt") + 1).cast("decimal(28,2)").alias("amt"),
        F.lit(None).cast("long").alias("n"),
    )
    merged = merge_stored(path, fresh, ["state"], fresh_path(t.spark, "report-new"))
    return merged.withColumn("amt", F.col("amt").cast("double"))


@query(oracle=f"""
    WITH one AS (
      SELECT o_orderstatus AS state, year(o_orderdate) AS date_year, count(*) AS n,
             CAST(sum({money('o_totalprice')}) AS DOUBLE) AS amt
      FROM orders GROUP BY 1, 2)
    SELECT 'history' AS place, * FROM one UNION ALL SELECT 'current', * FROM one
    UNION ALL SELECT 'snapshots', state, date_year, 2 * n, 2 * amt FROM one
""")
def two_targets_roundtrip(t: Tables) -> DataFrame:
    """One result in a partitioned history and a current table, and appended twice as snapshot."""
    report = t.orders.groupBy(
        F.col("o_orderstatus").alias("state"), F.year("o_orderdate").cast("long").alias("date_year")
    ).agg(
        F.count("*").alias("n"),
        F.sum(as_money("o_totalprice")).cast("double").alias("amt"),
    )
    history, current = fresh_path(t.spark, "history"), fresh_path(t.spark, "current")
    publish_both(report, history, ["date_year"], current)
    snapshots = fresh_path(t.spark, "snapshots")
    for _ in range(2):
        append_snapshot(t.spark.read.parquet(current), snapshots)
    read = t.spark.read
    by = ["state", "date_year"]
    summed = read.parquet(snapshots).groupBy(*by).agg(F.sum("n").alias("n"), F.sum("amt").alias("amt"))
    places = {
        "history": read.schema(report.schema).parquet(history),
        "current": read.parquet(current),
        "snapshots": summed,
    }
    out = None
    for name, df in places.items():
        one = df.select(F.lit(name).alias("place"), "state", "date_year", "n", "amt")
        out = one if out is None else out.unionByName(one)
    return out


@query(oracle="""
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice >= 300000 AND o_custkey IS NOT NULL)
""")
def customers_without_large_orders(t: Tables) -> DataFrame:
    """Customers without a large order; NULLs on either side never qualify or exclude."""
    large = t.orders.where("o_totalprice >= 300000")
    return not_in(t.customer.select("c_custkey", "c_name"), "c_custkey", large, "o_custkey")


@query(oracle="""
    SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS at, strftime(ts, '%Y%m%d') AS day, strftime(ts, '%H') AS hour FROM events
""")
def event_time_texts(t: Tables) -> DataFrame:
    """Compact time texts of events, and the day and hour in them."""
    at = compact_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    rows = t.events.select("event_id", at.alias("at"))
    return rows.select("event_id", "at", day_of_compact("at").alias("day"), hour_of_compact("at").alias("hour"))


@query(oracle="""
    SELECT o_orderstatus, count(*) AS order_count, CAST(max(o_orderkey) AS BIGINT) AS last_key FROM orders
    WHERE o_orderstatus <> 'P' GROUP BY 1
    UNION ALL
    SELECT o_orderstatus, count(*), CAST(max(o_orderkey) AS BIGINT) FROM orders
    WHERE o_orderstatus = 'P' AND o_orderkey % 2 = 0 GROUP BY 1
""")
def catalog_overwrite_roundtrip(t: Tables) -> DataFrame:
    """A partitioned catalog table filled, one partition overwritten by part of its rows, and read."""
    spark = t.spark
    name = fresh_path(spark, "orders_by_status").rpartition("/")[2].replace("-", "_")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    kind = rows.schema["o_orderkey"].dataType.simpleString()
    spark.sql(f"CREATE TABLE {name} (o_orderkey {kind}, o_orderstatus STRING) USING parquet PARTITIONED BY (o_orderstatus)")
    insert_overwrite(rows, name)
    insert_overwrite(rows.where("o_orderstatus = 'P' AND o_orderkey % 2 = 0"), name)
    return read_table(spark, name).groupBy("o_orderstatus").agg(
        F.count("*").alias("order_count"), F.max("o_orderkey").cast("long").alias("last_key"))


@query(oracle="""
    SELECT n_name AS name, 'text' AS kind FROM nation UNION ALL SELECT n_name, 'orc' FROM nation
""")
def file_format_roundtrip(t: Tables) -> DataFrame:
    """Names written and read as lines of text and as another file format."""
    names = t.nation.select("n_name")
    lines, orc = fresh_path(t.spark, "names-text"), fresh_path(t.spark, "names-orc")
    overwrite(names, lines, fmt="text")
    overwrite(names, orc, fmt="orc")
    read = read_text(t.spark, lines).select(F.col("value").alias("name"), F.lit("text").alias("kind"))
    return read.unionByName(read_path(t.spark, orc, "orc").select(F.col("n_name").alias("name"), F.lit("orc").alias("kind")))


@query(oracle="""
    SELECT o_orderstatus, count(*) AS order_count, CAST(max(o_orderkey) AS BIGINT) AS last_key FROM orders
    WHERE o_orderstatus <> 'P' OR o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1
""")
def catalog_urgent_overwrite_roundtrip(t: Tables) -> DataFrame:
    """A partitioned catalog table filled, the partition of pending orders overwritten by the urgent ones, and read."""
    spark = t.spark
    name = fresh_path(spark, "urgent_orders").rpartition("/")[2].replace("-", "_")
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    kind = rows.schema["o_orderkey"].dataType.simpleString()
    spark.sql(f"CREATE TABLE {name} (o_orderkey {kind}, o_orderpriority STRING, o_orderstatus STRING) "
              "USING parquet PARTITIONED BY (o_orderstatus)")
    insert_overwrite(rows, name)
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    insert_overwrite(rows.where((F.col("o_orderstatus") == "P") & urgent), name)
    return read_table(spark, name).groupBy("o_orderstatus").agg(
        F.count("*").alias("order_count"), F.max("o_orderkey").cast("long").alias("last_key"))


@query(oracle="""
    SELECT doc_id, text, lang, source, n_chars, kind FROM documents CROSS JOIN (VALUES ('text'), ('orc')) AS kinds(kind)
""")
def document_format_roundtrip(t: Tables) -> DataFrame:
    """Whole documents written and read as lines of text and as another file format."""
    docs = t.documents.select("doc_id", "text", "lang", "source", "n_chars")
    lines, orc = fresh_path(t.spark, "documents-text"), fresh_path(t.spark, "documents-orc")
    overwrite(docs.select(F.to_json(F.struct("*")).alias("value")), lines, fmt="text")
    overwrite(docs, orc, fmt="orc")
    read = read_text(t.spark, lines).select(F.from_json("value", docs.schema).alias("row"), F.lit("text").alias("kind"))
    return read.select("row.*", "kind").unionByName(read_path(t.spark, orc, "orc").withColumn("kind", F.lit("orc")))
