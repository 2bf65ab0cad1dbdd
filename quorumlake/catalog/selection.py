"""Scans, filters, sorting and reshaping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.values import type_tag
from ..operators import select as sel
from ..operators.spread import best_per_key
from ..operators.store import new_records
from ..sources.typed_docs import decode
from .registry import load, load_wide, query

NOW = dt.datetime(2024, 1, 20, 12)
IGNORED = ["small ring", "red widget", None]


@query("scan_table", "SELECT n_nationkey AS nation_id, n_name, n_regionkey FROM nation")
def scan_table(spark, root):
    return load(spark, root, "nation").withColumnRenamed("n_nationkey", "nation_id")


@query("lookup_by_id", "SELECT * FROM customer WHERE c_custkey = 42")
def lookup_by_id(spark, root):
    return sel.row_by_id(load(spark, root, "customer"), "c_custkey", 42)


@query(
    "bulk_lookup",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer "
    "WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def bulk_lookup(spark, root):
    urgent = load(spark, root, "orders").where("o_orderpriority = '1-URGENT'")
    ids = urgent.select(F.col("o_custkey").alias("c_custkey"))
    return sel.rows_by_ids(load(spark, root, "customer"), ids, "c_custkey").select(
        "c_custkey", "c_name", "c_mktsegment"
    )


@query(
    "decode_typed_docs",
    """SELECT CAST(event_id AS VARCHAR) AS doc_id, user_id, value, event_type,
              value > 5 AS high, ts, CAST(NULL AS VARCHAR) AS note
       FROM events""",
)
def decode_typed_docs(spark, root):
    events = load(spark, root, "events")

    def typed(kind, value):
        return F.struct(value.cast("string").alias(kind))

    fields = F.struct(
        typed("integerValue", F.col("user_id")).alias("user_id"),
        typed("doubleValue", F.col("value")).alias("value"),
        typed("stringValue", F.col("event_type")).alias("event_type"),
        typed("booleanValue", F.col("value") > 5).alias("high"),
        typed("timestampValue", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("ts"),
        typed("nullValue", F.lit(None)).alias("note"),
    )
    documents = events.select(
        F.concat(F.lit("projects/p/documents/event/"), F.col("event_id").cast("string")).alias("name"),
        F.to_json(fields).alias("fields"),
    )
    wanted = {
        "user_id": "long", "value": "double", "event_type": "string",
        "high": "boolean", "ts": "timestamp", "note": "string",
    }
    return decode(documents, "doc_id", wanted).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _filter(name, table, columns, conditions, sql_where):
    @query(name, f"SELECT {', '.join(columns)} FROM {table} WHERE {sql_where}")
    def run(spark, root):
        return sel.select_rows(load(spark, root, table), conditions).select(*columns)

    return run


_ORDER = ["o_orderkey", "o_orderstatus", "o_totalprice"]
_filter("filter_eq", "orders", _ORDER, [("o_orderstatus", "F")], "o_orderstatus = 'F'")
_filter("filter_gt", "orders", _ORDER, [("o_totalprice", ">", 400000.0)], "o_totalprice > 400000")
_filter("filter_lt", "orders", _ORDER, [("o_totalprice", "<", 20000.0)], "o_totalprice < 20000")
_filter("filter_gteq", "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"], [("l_quantity", ">=", 49.0)], "l_quantity >= 49")
_filter("filter_lteq", "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"], [("l_quantity", "<=", 2.0)], "l_quantity <= 2")
_filter("filter_in", "orders", _ORDER, [("o_orderpriority", "in", ["1-URGENT", "2-HIGH"])], "o_orderpriority IN ('1-URGENT', '2-HIGH')")
_filter(
    "filter_conjunction", "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"],
    [("l_returnflag", "R"), ("l_quantity", ">", 30.0), ("l_discount", "<=", 0.04)],
    "l_returnflag = 'R' AND l_quantity > 30 AND l_discount <= 0.04",
)
_filter("filter_nonempty", "part", ["p_partkey", "p_name"], [("p_name", ">", "")], "p_name > ''")


@query("filter_array_contains", "SELECT doc_id FROM documents WHERE list_contains(string_split(text, ' '), 'the')")
def filter_array_contains(spark, root):
    docs = load_wide(spark, root, "documents").select("doc_id", F.split("text", " ").alias("terms"))
    return sel.select_rows(docs, [("terms", "in", "the")]).select("doc_id")


@query(
    "filter_timebound",
    "SELECT event_id, ts FROM events "
    "WHERE ts > TIMESTAMP '2024-01-12 12:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'",
)
def filter_timebound(spark, root):
    now = F.lit(NOW).cast("timestamp_ntz")
    return load(spark, root, "events").where(sel.within_window(F.col("ts"), now, 8)).select("event_id", "ts")


@query(
    "filter_status",
    "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders "
    "WHERE nullif(o_orderstatus, 'P') IS DISTINCT FROM 'F'",
)
def filter_status(spark, root):
    orders = load(spark, root, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return orders.where(sel.not_status(F.col("status"), "F"))


@query(
    "filter_ignore_list",
    "SELECT p_partkey, name FROM (SELECT p_partkey, nullif(p_name, 'blue bolt') AS name FROM part) "
    "WHERE name IS NOT NULL AND name NOT IN ('small ring', 'red widget')",
)
def filter_ignore_list(spark, root):
    parts = load(spark, root, "part").select("p_partkey", F.nullif("p_name", F.lit("blue bolt")).alias("name"))
    return parts.where(sel.not_ignored(F.col("name"), IGNORED))


@query(
    "dtype_tag",
    """SELECT event_id,
       CASE typeof(user_id) WHEN 'BIGINT' THEN 'INTEGER' END AS user_tag,
       CASE typeof(value) WHEN 'DOUBLE' THEN 'DOUBLE' END AS value_tag,
       CASE typeof(event_type) WHEN 'VARCHAR' THEN 'STRING' END AS type_tag,
       CASE typeof(ts) WHEN 'TIMESTAMP' THEN 'TIMESTAMP' END AS ts_tag
       FROM events""",
)
def dtype_tag(spark, root):
    events = load(spark, root, "events")
    return events.select(
        "event_id",
        type_tag(events, "user_id").alias("user_tag"),
        type_tag(events, "value").alias("value_tag"),
        type_tag(events, "event_type").alias("type_tag"),
        type_tag(events, "ts").alias("ts_tag"),
    )


@query(
    "null_safe_keys",
    """WITH k AS (SELECT c_custkey, c_nationkey, nullif(c_mktsegment, 'BUILDING') AS segment, c_acctbal FROM customer)
       SELECT c_custkey, c_nationkey, segment FROM k WHERE c_acctbal >= 0 AND NOT EXISTS (
         SELECT 1 FROM k AS s WHERE s.c_acctbal < 0 AND s.c_nationkey = k.c_nationkey
         AND s.segment IS NOT DISTINCT FROM k.segment)""",
)
def null_safe_keys(spark, root):
    keyed = load(spark, root, "customer").select(
        "c_custkey", "c_nationkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_acctbal"
    )
    fresh = new_records(keyed.where("c_acctbal < 0"), keyed.where("c_acctbal >= 0"), ["c_nationkey", "segment"])
    return fresh.select("c_custkey", "c_nationkey", "segment")


@query(
    "rows_as_map",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (
         PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""",
)
def rows_as_map(spark, root):
    keyed = sel.keyed_rows(load(spark, root, "orders"), "o_custkey", F.desc("o_orderdate"), F.desc("o_orderkey"))
    return keyed.select("o_custkey", "row.o_orderkey", "row.o_totalprice")


@query("rows_as_frame", "SELECT l_partkey, l_orderkey, l_linenumber, l_quantity FROM lineitem")
def rows_as_frame(spark, root):
    rows = load(spark, root, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return sel.id_first(rows, "l_partkey")


@query(
    "filter_local_uri",
    """SELECT page_id, uri FROM (
         SELECT page_id, url AS uri FROM pages UNION ALL
         SELECT page_id, regexp_replace(url, '^https?://', '') AS uri FROM pages)
       WHERE NOT regexp_matches(uri, '^(https?|gc|s3)://')""",
)
def filter_local_uri(spark, root):
    pages = load_wide(spark, root, "pages")
    bare = pages.select("page_id", F.regexp_replace("url", "^https?://", "").alias("uri"))
    both = pages.select("page_id", F.col("url").alias("uri")).unionByName(bare)
    return both.where(tx.is_local_uri(F.col("uri")))


@query("sort_desc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC")
def sort_desc(spark, root):
    return sel.select_rows(load(spark, root, "orders"), order="o_totalprice", id_column="o_orderkey").select("o_orderkey", "o_totalprice")


@query("sort_asc", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice")
def sort_asc(spark, root):
    return sel.select_rows(load(spark, root, "part"), order=("p_retailprice", "ASCENDING"), id_column="p_partkey").select(
        "p_partkey", "p_retailprice"
    )


@query("sort_limit", "SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 100")
def sort_limit(spark, root):
    return sel.select_rows(load(spark, root, "orders").select("o_orderkey"), order="o_orderkey", limit=100)


@query(
    "select_rows",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders "
    "WHERE o_orderstatus = 'O' AND o_totalprice > 100000 ORDER BY o_orderkey LIMIT 50",
)
def select_rows(spark, root):
    filters = [("o_orderstatus", "O"), ("o_totalprice", ">", 100000.0)]
    orders = load(spark, root, "orders").select(*_ORDER)
    return sel.select_rows(orders, filters, ("o_orderkey", False), 50)


@query(
    "prefer_format",
    """SELECT l_orderkey, l_linestatus || l_returnflag AS format FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY
           list_position(['R', 'A', 'N'], l_returnflag), l_linestatus) AS r FROM lineitem) WHERE r = 1""",
)
def prefer_format(spark, root):
    rank = F.array_position(F.array(F.lit("R"), F.lit("A"), F.lit("N")), F.col("l_returnflag"))
    best = best_per_key(load(spark, root, "lineitem"), ["l_orderkey"], rank, F.col("l_linestatus"))
    return best.select("l_orderkey", F.concat("l_linestatus", "l_returnflag").alias("format"))


@query(
    "distinct_values",
    "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer",
)
def distinct_values(spark, root):
    return load(spark, root, "customer").select("c_mktsegment", "c_nationkey").distinct()


@query(
    "union_all",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def union_all(spark, root):
    customers = load(spark, root, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = load(spark, root, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return customers.unionByName(suppliers)


@query("union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, root):
    customers = load(spark, root, "customer").select(F.col("c_nationkey").alias("nation"))
    suppliers = load(spark, root, "supplier").select(F.col("s_nationkey").alias("nation"))
    return customers.unionByName(suppliers).distinct()


@query("drop_unmatched", "SELECT doc_id, quality FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def drop_unmatched(spark, root):
    docs = load_wide(spark, root, "documents").select("doc_id")
    return docs.join(load(spark, root, "labels"), "doc_id", "left").where("quality is not null").select("doc_id", "quality")
