"""Registered queries over the driver's tables, each with a DuckDB oracle.

Every query reads whole tables and runs the ingestion operators on text that
Spark derives from them (stringified columns, CSV records, header rows ...).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import types as ft
from ..functions.convert import cast_field, to_boolean, to_date, to_datetime, to_time
from ..functions.infer import infer_code, type_bit
from ..functions.text import (base_name, java_split, normalize_header, table_name, uri_bucket,
                              uri_path, uri_scheme)
from ..operators.fill import fill_typed
from ..operators.headers import normalize_headers, valid_headers
from ..operators.lookup import lookup_join
from ..operators.schema import infer_schema, merge_masks
from ..sources.plan import candidate_starts, pair_point_array
from ..sources.records import parse_csv_records
from ..options import IngestOptions
from ..session import new_work_dir
from .ingest import read_tables
from .fixtures import build_archive
from . import file_queries
from . import oracle as O


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


CONVERSATIONS_PER_FILE = 20      # conversations in one file of the text and archive inputs


def _s(c: str) -> F.Column:
    return F.col(c).cast("string")


def _iso_date(c: str) -> F.Column:
    """yyyy-MM-dd of a zone-less timestamp (no session time zone involved)."""
    return F.to_date(F.col(c)).cast("string")


def _iso_datetime(c: str) -> F.Column:
    """yyyy-MM-ddTHH:mm:ss[.ffffff] of a zone-less timestamp."""
    return F.translate(F.col(c).cast("string"), " ", "T")


def _infer_name(c) -> F.Column:
    return ft.type_name(infer_code(c))


def _resolve_name(mask) -> F.Column:
    return ft.type_name(ft.resolve_mask(mask))


# --------------------------------------------------------------------------- A1 C10
ORDERS_TEXT_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                    "o_orderpriority"]


def _orders_text(spark, d):
    o = _t(spark, d, "orders")
    return o.select(_s("o_orderkey").alias("o_orderkey"), _s("o_custkey").alias("o_custkey"),
                    "o_orderstatus", _s("o_totalprice").alias("o_totalprice"),
                    _iso_date("o_orderdate").alias("o_orderdate"),
                    "o_orderpriority")


def infer_types_orders(spark, d):
    long = _orders_text(spark, d).unpivot([], ORDERS_TEXT_COLS, "column_name", "value")
    typed = long.select("column_name", _infer_name(F.col("value")).alias("field_type"))
    return typed.groupBy("column_name", "field_type").agg(F.count(F.lit(1)).alias("n"))


_ORDERS_TEXT_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
  o_orderpriority FROM orders"""

SQL = {}
SQL["infer_types_orders"] = f"""
WITH s AS ({_ORDERS_TEXT_SQL}),
l AS ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, {c} AS value FROM s" for c in ORDERS_TEXT_COLS)})
SELECT column_name, {O.infer_name_sql('value')} AS field_type, count(*) AS n FROM l GROUP BY 1, 2"""

# --------------------------------------------------------------------------- F7 A5


def table_schema_orders(spark, d):
    """Merged schema of stringified ``orders`` (whole table) -> warehouse schema rows."""
    from ..sinks.tables import warehouse_schema
    codes = infer_schema(_orders_text(spark, d), ORDERS_TEXT_COLS)       # one aggregate
    rows = [(f["name"], i, ft.TYPE_NAMES[c], f["type"], f["mode"]) for i, (f, c) in
            enumerate(zip(warehouse_schema(ORDERS_TEXT_COLS, codes), codes))]
    return spark.createDataFrame(rows, "column_name string, position int, field_type string, "
                                       "warehouse_type string, mode string")


_WAREHOUSE_SQL = """CASE t WHEN 'INT' THEN 'INT64' WHEN 'LONG' THEN 'INT64' WHEN 'DOUBLE' THEN 'FLOAT64'
  WHEN 'BOOLEAN' THEN 'BOOL' WHEN 'DATE' THEN 'DATE' WHEN 'TIME' THEN 'TIME' WHEN 'DATETIME' THEN 'DATETIME'
  ELSE 'STRING' END"""
SQL["table_schema_orders"] = f"""
WITH s AS ({_ORDERS_TEXT_SQL}),
m AS (SELECT {', '.join(f'bit_or({O.bit_sql(c)}) AS {c}' for c in ORDERS_TEXT_COLS)} FROM s),
t AS ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, CAST({i} AS INTEGER) AS position, {O.resolve_sql(c)} AS t FROM m" for i, c in enumerate(ORDERS_TEXT_COLS))})
SELECT column_name, position, t AS field_type, {_WAREHOUSE_SQL} AS warehouse_type, 'NULLABLE' AS mode FROM t"""

# --------------------------------------------------------------------------- A2 A3
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"]


def _lineitem_text(spark, d):
    li = _t(spark, d, "lineitem")
    cols = [(_s(c) if c != "l_shipdate" else _iso_datetime(c)).alias(c) for c in LINEITEM_COLS]
    return li.select(F.col("l_returnflag").alias("file_key"), *cols)


_LINEITEM_TEXT_SQL = "SELECT l_returnflag AS file_key, " + ", ".join(
    (f"CAST({c} AS VARCHAR) AS {c}" if c != "l_shipdate"
     else "strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS l_shipdate") for c in LINEITEM_COLS
) + " FROM lineitem"


def merge_schema_lineitem(spark, d):
    masks = merge_masks(_lineitem_text(spark, d), LINEITEM_COLS, keys=["file_key"])
    return masks.select("file_key", *[_resolve_name(F.col(c)).alias(c) for c in LINEITEM_COLS])


SQL["merge_schema_lineitem"] = f"""
WITH s AS ({_LINEITEM_TEXT_SQL}),
m AS (SELECT file_key, {', '.join(f'bit_or({O.bit_sql(c)}) AS {c}' for c in LINEITEM_COLS)} FROM s GROUP BY file_key)
SELECT file_key, {', '.join(f'{O.resolve_sql(c)} AS {c}' for c in LINEITEM_COLS)} FROM m"""

# --------------------------------------------------------------------------- A5 C11
GLOBAL_COLS = ["c0", "c1", "c2", "c3", "c4"]


def merge_schema_global(spark, d):
    c = _t(spark, d, "customer").select(
        _s("c_custkey").alias("c0"), F.col("c_name").alias("c1"), _s("c_nationkey").alias("c2"),
        _s("c_acctbal").alias("c3"), F.col("c_mktsegment").alias("c4"))
    s = _t(spark, d, "supplier").select(
        _s("s_suppkey").alias("c0"), F.col("s_name").alias("c1"), _s("s_nationkey").alias("c2"),
        _s("s_acctbal").alias("c3"), (F.col("s_acctbal") > 0).cast("string").alias("c4"))
    masks = merge_masks(c.unionByName(s), GLOBAL_COLS)
    return masks.select(*[F.col(x).alias(f"{x}_mask") for x in GLOBAL_COLS],
                        *[_resolve_name(F.col(x)).alias(x) for x in GLOBAL_COLS])


SQL["merge_schema_global"] = f"""
WITH u AS (
  SELECT CAST(c_custkey AS VARCHAR) c0, c_name c1, CAST(c_nationkey AS VARCHAR) c2, CAST(c_acctbal AS VARCHAR) c3, c_mktsegment c4 FROM customer
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR), CAST(s_acctbal AS VARCHAR), CAST(s_acctbal > 0 AS VARCHAR) FROM supplier),
m AS (SELECT {', '.join(f'bit_or({O.bit_sql(x)}) AS {x}' for x in GLOBAL_COLS)} FROM u)
SELECT {', '.join(f'CAST({x} AS INTEGER) AS {x}_mask' for x in GLOBAL_COLS)}, {', '.join(f'{O.resolve_sql(x)} AS {x}' for x in GLOBAL_COLS)} FROM m"""

# --------------------------------------------------------------------------- F5 C1-C9
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def typed_cast_events(spark, d):
    e = _t(spark, d, "events")
    text = e.select(_s("event_id").alias("event_id"),
                    _iso_datetime("ts").alias("ts"),
                    _s("user_id").alias("user_id"), "event_type", _s("value").alias("value"),
                    "props")
    codes = infer_schema(text, EVENT_COLS)          # action 1: merged schema
    return fill_typed(text, EVENT_COLS, codes)     # lazy typed projection


SQL["typed_cast_events"] = """
SELECT CAST(event_id AS INTEGER) AS event_id, ts, CAST(user_id AS INTEGER) AS user_id,
  NULLIF(event_type, '') AS event_type, value, NULLIF(props, '') AS props FROM events"""

# --------------------------------------------------------------------------- A3 mixed numerics


def mixed_column_merge(spark, d):
    p = _t(spark, d, "part")
    r = F.col("p_size") % 7
    v = (F.when(r == 0, F.lit("")).when(r.isin(1, 2), _s("p_size"))
         .when(r == 3, (F.col("p_partkey") + F.lit(3000000000)).cast("string"))
         .otherwise(_s("p_retailprice")))
    s = p.select("p_brand", (F.col("p_size") % 4).alias("size_class"), v.alias("v"),
                 type_bit(v).alias("bit"))
    return (s.groupBy("p_brand", "size_class")
            .agg(_resolve_name(F.bit_or("bit")).alias("merged_type"),
                 F.count(F.when(F.col("v") != "", 1)).alias("n_values"),
                 F.count(F.when(F.col("v") == "", 1)).alias("n_empty"),
                 F.max(F.col("v").try_cast("double")).alias("max_value")))


SQL["mixed_column_merge"] = f"""
WITH s AS (SELECT p_brand, p_size % 4 AS size_class,
  CASE WHEN p_size % 7 = 0 THEN '' WHEN p_size % 7 IN (1, 2) THEN CAST(p_size AS VARCHAR)
       WHEN p_size % 7 = 3 THEN CAST(p_partkey + 3000000000 AS VARCHAR) ELSE CAST(p_retailprice AS VARCHAR) END AS v
  FROM part)
SELECT p_brand, size_class, {O.resolve_sql('bit_or(' + O.bit_sql('v') + ')')} AS merged_type,
  count(CASE WHEN v <> '' THEN 1 END) AS n_values, count(CASE WHEN v = '' THEN 1 END) AS n_empty,
  max(TRY_CAST(v AS DOUBLE)) AS max_value
FROM s GROUP BY p_brand, size_class"""

# --------------------------------------------------------------------------- F5 lossy audit


def _lossy_text():
    date = _iso_date("o_orderdate")
    dt = _iso_datetime("o_orderdate")
    tm = F.format_string("%02d:%02d", F.col("o_custkey") % 24, F.col("o_orderkey") % 60)
    even = (F.col("o_orderkey") % 2) == 0
    pr = F.col("o_orderpriority")
    return (F.when(pr.isin("1-URGENT", "2-HIGH"), F.when(even, date).otherwise(dt))
            .when(pr == "3-MEDIUM", F.when(even, tm).otherwise(dt))
            .otherwise(F.when(even, date).otherwise(tm)))


def lossy_cast_audit(spark, d):
    o = _t(spark, d, "orders").select("o_orderpriority", _lossy_text().alias("v"))
    o = o.select("*", type_bit(F.col("v")).alias("bit"), _infer_name(F.col("v")).alias("value_type"))
    masks = o.groupBy("o_orderpriority").agg(F.bit_or("bit").alias("mask"))
    code = ft.resolve_mask(F.col("mask"))
    joined = lookup_join(o, masks.select("o_orderpriority", code.alias("code")), "o_orderpriority")
    typed_null = (F.when(F.col("code") == ft.DATETIME, to_datetime(F.col("v")).isNull())
                  .when(F.col("code") == ft.DATE, to_date(F.col("v")).isNull())
                  .when(F.col("code") == ft.TIME, to_time(F.col("v")).isNull())
                  .otherwise(F.lit(False)))
    return (joined.groupBy("o_orderpriority", ft.type_name(F.col("code")).alias("merged_type"),
                           "value_type")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count(F.when(typed_null, 1)).alias("n_lossy")))


SQL["lossy_cast_audit"] = f"""
WITH o AS (SELECT o_orderpriority,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN
         CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END
       WHEN o_orderpriority = '3-MEDIUM' THEN
         CASE WHEN o_orderkey % 2 = 0 THEN printf('%02d:%02d', o_custkey % 24, o_orderkey % 60) ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END
       ELSE CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE printf('%02d:%02d', o_custkey % 24, o_orderkey % 60) END
  END AS v FROM orders),
m AS (SELECT o_orderpriority, {O.resolve_sql('bit_or(' + O.bit_sql('v') + ')')} AS merged_type FROM o GROUP BY 1),
j AS (SELECT o.*, m.merged_type, {O.infer_name_sql('v')} AS value_type FROM o JOIN m USING (o_orderpriority))
SELECT o_orderpriority, merged_type, value_type, count(*) AS n,
  count(CASE WHEN merged_type = 'DATETIME' AND value_type <> 'DATETIME' THEN 1 END) AS n_lossy
FROM j GROUP BY 1, 2, 3"""

# --------------------------------------------------------------------------- C4 C5
BOOL_SAMPLE = ["true", "FALSE", "Yes", "no", "Y", "n", "T", "f", "maybe", "1"]


def boolean_words(spark, d):
    lab = _t(spark, d, "labels")
    words = F.array(*[F.lit(w) for w in BOOL_SAMPLE])
    w = F.element_at(words, ((F.col("doc_id") + F.col("quality") + F.col("toxic")) % 10).cast("int") + 1)
    s = lab.select("doc_id", w.alias("word"))
    return s.select("doc_id", "word", _infer_name(F.col("word")).alias("field_type"),
                    to_boolean(F.col("word")).alias("bool_value"))


SQL["boolean_words"] = f"""
WITH s AS (SELECT doc_id, [{', '.join(O.q(w) for w in BOOL_SAMPLE)}][((doc_id + quality + toxic) % 10) + 1] AS word FROM labels)
SELECT doc_id, word, {O.infer_name_sql('word')} AS field_type,
  CASE WHEN length(word) <= 5 AND lower(word) IN ({O.BOOL_LIST}) THEN lower(word) IN ({O.TRUE_LIST}) END AS bool_value
FROM s"""

# --------------------------------------------------------------------------- C6-C8


def _temporal_text():
    date = _iso_date("l_shipdate")
    hm = F.format_string("%02d:%02d", F.col("l_partkey") % 24, F.col("l_suppkey") % 60)
    frac = F.format_string("%03d", F.col("l_partkey") % 1000)
    n = F.col("l_linenumber")
    return (F.when(n == 1, F.concat(date, F.lit("+05:00")))
            .when(n == 2, F.concat(date, F.lit("Z")))
            .when(n == 3, hm)
            .when(n == 4, F.concat(hm, F.lit(":07."), frac, F.lit("000")))
            .when(n == 5, F.concat(date, F.lit("T"), hm, F.lit(":30-03:30")))
            .when(n == 6, F.concat(date, F.lit("t"), hm))
            .otherwise(F.concat(date, F.lit("T"), hm, F.lit(":59"))))


def iso_temporal_normalize(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", _temporal_text().alias("raw"))
    return li.select("l_orderkey", "l_linenumber", "raw",
                     _infer_name(F.col("raw")).alias("field_type"),
                     to_date(F.col("raw")).alias("date_value"),
                     to_time(F.col("raw")).alias("time_value"),
                     to_datetime(F.col("raw")).alias("datetime_value"))


SQL["iso_temporal_normalize"] = f"""
WITH s AS (SELECT l_orderkey, l_linenumber,
  CASE l_linenumber
    WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d') || '+05:00'
    WHEN 2 THEN strftime(l_shipdate, '%Y-%m-%d') || 'Z'
    WHEN 3 THEN printf('%02d:%02d', l_partkey % 24, l_suppkey % 60)
    WHEN 4 THEN printf('%02d:%02d', l_partkey % 24, l_suppkey % 60) || ':07.' || printf('%03d', l_partkey % 1000) || '000'
    WHEN 5 THEN strftime(l_shipdate, '%Y-%m-%d') || 'T' || printf('%02d:%02d', l_partkey % 24, l_suppkey % 60) || ':30-03:30'
    WHEN 6 THEN strftime(l_shipdate, '%Y-%m-%d') || 't' || printf('%02d:%02d', l_partkey % 24, l_suppkey % 60)
    ELSE strftime(l_shipdate, '%Y-%m-%d') || 'T' || printf('%02d:%02d', l_partkey % 24, l_suppkey % 60) || ':59'
  END AS raw FROM lineitem),
t AS (SELECT *, {O.infer_name_sql('raw')} AS field_type FROM s)
SELECT l_orderkey, l_linenumber, raw, field_type,
  CASE WHEN field_type = 'DATE' THEN CAST(substr(raw, 1, 10) AS DATE) END AS date_value,
  {O.to_time_sql('raw')} AS time_value,
  CASE WHEN field_type = 'DATETIME' THEN {O.to_datetime_sql('raw')} END AS datetime_value
FROM t"""

# --------------------------------------------------------------------------- F2 F3


def _doc_lines(spark, d):
    docs = _t(spark, d, "documents")
    return docs.select("doc_id", F.posexplode(F.split(F.col("text"), "\n", -1)).alias("line_no", "line"))


def header_normalize(spark, d):
    lines = _doc_lines(spark, d)
    toks = lines.select("doc_id", "line_no", F.posexplode(F.split(F.col("line"), " ", -1)).alias("pos", "raw"))
    return toks.select("doc_id", "line_no", "pos", "raw", normalize_header(F.col("raw")).alias("name"))


_DOC_LINES_SQL = """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
ln AS (SELECT doc_id, CAST(unnest(range(len(lines))) AS INTEGER) AS line_no, unnest(lines) AS line FROM l)"""

SQL["header_normalize"] = f"""{_DOC_LINES_SQL},
t AS (SELECT doc_id, line_no, string_split(line, ' ') AS toks FROM ln),
tk AS (SELECT doc_id, line_no, CAST(unnest(range(len(toks))) AS INTEGER) AS pos, unnest(toks) AS raw FROM t)
SELECT doc_id, line_no, pos, raw, {O.normalize_header_sql('raw')} AS name FROM tk"""


def header_validate(spark, d):
    lines = _doc_lines(spark, d)
    names = normalize_headers(F.split(F.col("line"), " ", -1))
    return lines.select("doc_id", "line_no", names.alias("names")).select(
        "doc_id", "line_no", F.size("names").alias("n_names"),
        valid_headers(F.col("names"), case_sensitive=True).alias("valid"))


SQL["header_validate"] = f"""{_DOC_LINES_SQL},
n AS (SELECT doc_id, line_no, list_transform(string_split(line, ' '), lambda x: {O.normalize_header_sql('x')}) AS names FROM ln)
SELECT doc_id, line_no, CAST(len(names) AS INTEGER) AS n_names,
  NOT (len(list_filter(names, lambda x: x IS NULL OR trim(x) = '')) > 0
       OR len(list_filter(names, lambda x: {O.infer_code_sql('x')} <> {ft.STRING})) > 0
       OR len(list_distinct(names)) <> len(names)) AS valid
FROM n"""

# --------------------------------------------------------------------------- S16


def regex_split_records(spark, d):
    docs = _t(spark, d, "documents")
    recs = docs.select("doc_id", F.posexplode(java_split(F.col("text"), "\n+")).alias("rec_no", "record"))
    fields = java_split(F.col("record"), " +")
    return recs.select("doc_id", "rec_no", F.size(fields).alias("n_fields"),
                       F.array_join(fields, "|").alias("fields"))


SQL["regex_split_records"] = f"""
WITH r AS (SELECT doc_id, {O.java_split_sql('text', chr(10) + '+')} AS recs FROM documents),
rr AS (SELECT doc_id, CAST(unnest(range(len(recs))) AS INTEGER) AS rec_no, unnest(recs) AS record FROM r),
f AS (SELECT doc_id, rec_no, {O.java_split_sql('record', ' +')} AS fields FROM rr)
SELECT doc_id, rec_no, CAST(len(fields) AS INTEGER) AS n_fields, array_to_string(fields, '|') AS fields FROM f"""

# --------------------------------------------------------------------------- K2 C12-C14


def table_name_from_uri(spark, d):
    pg = _t(spark, d, "pages")
    u = F.col("url")
    return pg.select("page_id", uri_scheme(u).alias("scheme"), uri_bucket(u).alias("bucket"),
                     uri_path(u).alias("object_path"), base_name(u).alias("base_name"),
                     F.when(uri_path(u).isNotNull(), table_name(u)).alias("table_name"))


_URI = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/]+)/(.+)$"
_P = f"regexp_extract(url, {O.q(_URI)}, 3)"
_BASE = f"regexp_replace(regexp_extract({_P}, '([^/\\\\]*)$', 1), '\\.[^./\\\\]*$', '')"
SQL["table_name_from_uri"] = f"""
SELECT page_id,
  CASE WHEN regexp_matches(url, {O.q(_URI)}) THEN regexp_extract(url, {O.q(_URI)}, 1) END AS scheme,
  CASE WHEN regexp_matches(url, {O.q(_URI)}) THEN regexp_extract(url, {O.q(_URI)}, 2) END AS bucket,
  CASE WHEN regexp_matches(url, {O.q(_URI)}) THEN {_P} END AS object_path,
  CASE WHEN regexp_matches(url, {O.q(_URI)}) THEN {_BASE} END AS base_name,
  CASE WHEN regexp_matches(url, {O.q(_URI)}) THEN regexp_replace({_BASE}, '\\W', '_', 'g') END AS table_name
FROM pages"""

# --------------------------------------------------------------------------- J1 J2


def header_lookup_join(spark, d):
    li = _t(spark, d, "lineitem")
    v = (F.when(F.col("l_returnflag") == "A", F.floor("l_quantity").cast("bigint").cast("string"))
         .when(F.col("l_returnflag") == "N", _s("l_extendedprice"))
         .otherwise(F.when(F.col("l_linenumber") % 2 == 0, _iso_date("l_shipdate"))
                    .otherwise(F.concat(F.lit("x"), _s("l_linenumber")))))
    recs = li.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("file_key"), v.alias("v"))
    schema_map = (recs.select("file_key", type_bit(F.col("v")).alias("bit"))
                  .groupBy("file_key").agg(F.bit_or("bit").alias("mask"))
                  .select("file_key", ft.resolve_mask(F.col("mask")).alias("code")))
    j = lookup_join(recs, schema_map, "file_key")
    code = F.col("code")
    return j.select("l_orderkey", "l_linenumber", "file_key",
                    ft.type_name(code).alias("field_type"),
                    F.when(code.isin(ft.INT, ft.LONG), cast_field(F.col("v"), ft.LONG)).alias("int_value"),
                    F.when(code == ft.DOUBLE, cast_field(F.col("v"), ft.DOUBLE)).alias("double_value"),
                    F.when(code == ft.STRING, cast_field(F.col("v"), ft.STRING)).alias("string_value"))


SQL["header_lookup_join"] = f"""
WITH r AS (SELECT l_orderkey, l_linenumber, l_returnflag AS file_key,
  CASE WHEN l_returnflag = 'A' THEN CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR)
       WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS VARCHAR)
       ELSE CASE WHEN l_linenumber % 2 = 0 THEN strftime(l_shipdate, '%Y-%m-%d') ELSE 'x' || CAST(l_linenumber AS VARCHAR) END
  END AS v FROM lineitem),
m AS (SELECT file_key, {O.resolve_sql('bit_or(' + O.bit_sql('v') + ')')} AS field_type FROM r GROUP BY 1)
SELECT l_orderkey, l_linenumber, file_key, field_type,
  CASE WHEN field_type IN ('INT', 'LONG') THEN CAST(v AS BIGINT) END AS int_value,
  CASE WHEN field_type = 'DOUBLE' THEN CAST(v AS DOUBLE) END AS double_value,
  CASE WHEN field_type = 'STRING' THEN NULLIF(v, '') END AS string_value
FROM r JOIN m USING (file_key)"""

# --------------------------------------------------------------------------- S11 S14 R2-R4
SPLIT_CHUNK = 4096


def split_ranges(spark, d):
    """Split plan of each document taken as a file (character offsets): data starts
    after the first line; candidates every SPLIT_CHUNK; the first record separator
    in each candidate window is a split point; adjacent points form the chunks."""
    docs = _t(spark, d, "documents")
    text = F.col("text")
    files = docs.select("doc_id", "text", F.char_length(text).cast("long").alias("size"),
                        F.locate("\n", text).cast("long").alias("nl"))
    files = files.withColumn("data_start", F.when(F.col("nl") > 0, F.col("nl")).otherwise(F.col("size")))
    starts = candidate_starts(F.col("size"), SPLIT_CHUNK)
    # first separator at or after each window start (1-based position = the point after it)
    found = F.transform(starts, lambda w: F.struct(
        F.call_function("locate", F.lit("\n"), text, (w + 1).cast("int")).cast("long").alias("p"),
        F.least(w + SPLIT_CHUNK, F.col("size")).alias("end")))
    points = F.concat(F.array(F.col("data_start"), F.col("size")),
                      F.transform(F.filter(found, lambda x: (x["p"] > 0) & (x["p"] <= x["end"])),
                                  lambda x: x["p"]))
    pairs = files.select("doc_id", F.explode(pair_point_array(points)).alias("c"))
    return pairs.select("doc_id", F.col("c.start").alias("chunk_start"), F.col("c.end").alias("chunk_end"))


SQL["split_ranges"] = f"""
WITH f AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS size, CAST(strpos(text, chr(10)) AS BIGINT) AS nl FROM documents),
f2 AS (SELECT *, CASE WHEN nl > 0 THEN nl ELSE size END AS data_start FROM f),
w AS (SELECT doc_id, text, (i + 1) * {SPLIT_CHUNK} AS win_start, least((i + 2) * {SPLIT_CHUNK}, size) AS win_end
      FROM f2, LATERAL (SELECT unnest(range(size // {SPLIT_CHUNK})) AS i)),
fd AS (SELECT doc_id, win_start + strpos(substr(text, win_start + 1), chr(10)) AS nl, win_end,
              strpos(substr(text, win_start + 1), chr(10)) AS rel FROM w),
p AS (SELECT doc_id, data_start AS point FROM f2 UNION SELECT doc_id, size FROM f2
      UNION SELECT doc_id, nl FROM fd WHERE rel > 0 AND nl <= win_end),
pr AS (SELECT doc_id, point AS chunk_start, lead(point) OVER (PARTITION BY doc_id ORDER BY point) AS chunk_end FROM p)
SELECT doc_id, chunk_start, chunk_end FROM pr WHERE chunk_end IS NOT NULL"""

# --------------------------------------------------------------------------- F6


def quarantine_ragged(spark, d):
    li = _t(spark, d, "lineitem")
    vals = F.array(_s("l_orderkey"), _s("l_partkey"), _s("l_suppkey"), _s("l_linenumber"))
    rec = F.array_join(F.slice(vals, 1, (F.col("l_linenumber") % 3 + 2).cast("int")), ",")
    recs = li.select("l_orderkey", "l_linenumber", rec.alias("record"))
    parsed = parse_csv_records(recs, "record", 3, IngestOptions(), count_fields=True)
    return parsed.select("l_orderkey", "l_linenumber", "n_fields",
                         F.col("corrupt").__invert__().alias("width_ok"))


SQL["quarantine_ragged"] = """
SELECT l_orderkey, l_linenumber, CAST(l_linenumber % 3 + 2 AS INTEGER) AS n_fields,
  (l_linenumber % 3 + 2) = 3 AS width_ok FROM lineitem"""

# --------------------------------------------------------------------------- S15


def csv_line_parse(spark, d):
    conv = _t(spark, d, "conversations")
    rec = F.concat_ws(",", _s("conv_id"), _s("turn"), F.col("role"),
                      F.concat(F.lit('"'), F.replace(F.col("text"), F.lit('"'), F.lit('""')), F.lit('"')))
    recs = conv.select(rec.alias("record"))
    names = ["conv_id", "turn", "role", "text"]
    parsed = parse_csv_records(recs, "record", 4, IngestOptions(), names=names)
    codes = infer_schema(parsed, names)
    return fill_typed(parsed, names, codes)


SQL["csv_line_parse"] = """
SELECT CAST(conv_id AS INTEGER) AS conv_id, CAST(turn AS INTEGER) AS turn,
  NULLIF(role, '') AS role, NULLIF(text, '') AS text FROM conversations"""

# --------------------------------------------------------------------------- files end to end
def _stage_dir(spark, name: str) -> str:
    return new_work_dir(spark, name)


def _orders_csv(spark, d) -> str:
    out = _stage_dir(spark, "orders-csv")
    _t(spark, d, "orders").write.option("header", True).csv(out)
    return out


def ingest_end_to_end(spark, d):
    """orders -> CSV files -> ingest (headers, exact parallel split, full-data
    inference, typed cast) -> aggregate of the typed table."""
    res = read_tables(spark, _orders_csv(spark, d), IngestOptions(chunk_size=1 << 20),
                      table_name="orders")["orders"]
    t = res.data
    return (t.groupBy("o_orderstatus", F.year("o_orderdate").alias("o_year"))
            .agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("max_totalprice"),
                 F.min("o_orderkey").alias("min_orderkey"),
                 F.countDistinct("o_custkey").alias("n_customers")))


SQL["ingest_end_to_end"] = """
SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS o_year, count(*) AS n_orders,
  max(o_totalprice) AS max_totalprice, CAST(min(o_orderkey) AS INTEGER) AS min_orderkey,
  count(DISTINCT o_custkey) AS n_customers
FROM orders GROUP BY 1, 2"""

DOC_COLS = ["doc_id", "lang", "source", "n_chars", "text"]


def _quoted_text(text):
    return F.concat(F.lit('"'), F.col("source"), F.lit('" wrote, "'), text, F.lit('"'))


def csv_split_parallel(spark, d):
    """documents (long texts with newlines, commas and quotes) -> quoted CSV ->
    exact parallel split in 4 KiB chunks, so records span many chunks."""
    docs = _t(spark, d, "documents").select("doc_id", "lang", "source", "n_chars",
                                            _quoted_text(F.col("text")).alias("text"))
    out = _stage_dir(spark, "documents-csv")
    docs.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(out)
    res = read_tables(spark, out, IngestOptions(chunk_size=4096), table_name="documents")
    return res["documents"].data


SQL["csv_split_parallel"] = """
SELECT CAST(doc_id AS INTEGER) AS doc_id, lang, source, CAST(n_chars AS INTEGER) AS n_chars,
  '"' || source || '" wrote, "' || text || '"' AS text FROM documents"""

LINEITEM_TYPED_SQL = """
SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey,
  CAST(l_suppkey AS INTEGER) AS l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem"""


def csv_split_heuristic(spark, d):
    """lineitem -> CSV -> the importer's heuristic split-point search (64 KiB
    candidate windows) -> chunk ranges -> parse -> typed table."""
    out = _stage_dir(spark, "lineitem-csv")
    _t(spark, d, "lineitem").write.option("header", True).csv(out)
    opts = IngestOptions(chunk_size=1 << 16, split_mode="heuristic")
    return read_tables(spark, out, opts, table_name="lineitem")["lineitem"].data


SQL["csv_split_heuristic"] = LINEITEM_TYPED_SQL

def csv_roundtrip_customer(spark, d):
    """customer -> CSV with every field quoted -> ingest -> typed customer."""
    out = _stage_dir(spark, "customer-csv")
    _t(spark, d, "customer").write.option("header", True).option("quoteAll", True) \
        .option("escape", '"').csv(out)
    return read_tables(spark, out, IngestOptions(), table_name="customer")["customer"].data


SQL["csv_roundtrip_customer"] = """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
  c_acctbal, c_mktsegment FROM customer"""

CONV_TYPED_SQL = """
SELECT CAST(conv_id AS INTEGER) AS conv_id, CAST(turn AS INTEGER) AS turn,
  NULLIF(role, '') AS role, NULLIF(text, '') AS text FROM conversations"""


def _conv_text_files(spark, d, sep: str) -> str:
    """conversations as text files, one per bucket, each starting with a header
    line; texts keep their raw newlines."""
    conv = _t(spark, d, "conversations")
    bucket = F.floor(F.col("conv_id") / CONVERSATIONS_PER_FILE)
    body = conv.select(bucket.alias("bucket"),
                       F.lit(1).alias("k0"), "conv_id", "turn",
                       F.concat_ws(sep, _s("conv_id"), _s("turn"), F.col("role"), F.col("text")).alias("value"))
    heads = body.select("bucket").distinct().select("bucket", F.lit(0).alias("k0"),
                                          F.lit(-1).cast("long").alias("conv_id"),
                                          F.lit(-1).cast("long").alias("turn"),
                                          F.lit(sep.join(["conv_id", "turn", "role", "text"])).alias("value"))
    out = _stage_dir(spark, "conversations-text")
    (body.unionByName(heads).repartition("bucket")
     .sortWithinPartitions("bucket", "k0", "conv_id", "turn")
     .select("bucket", "value").write.partitionBy("bucket").text(out))
    return out


def regex_parse_file(spark, d):
    """Regex mode on files: records end at a newline followed by ``id|turn|``,
    fields split at ``|``; split points are the first record-regex match of each
    candidate window (Java regex, evaluated by Spark)."""
    out = _conv_text_files(spark, d, "|")
    opts = IngestOptions(record_regex=r"\n(?=\d+\|\d+\|)", field_regex=r"\|", chunk_size=4096)
    return read_tables(spark, out, opts, table_name="conversations")["conversations"].data


SQL["regex_parse_file"] = CONV_TYPED_SQL


def archive_expand(spark, d):
    """conversations -> CSV inside gzip, zip, tar.gz, lz4 and tar archives (one
    archive per bucket of at most ~50k rows) -> detect, expand, ingest."""
    conv = _t(spark, d, "conversations")
    dest = _stage_dir(spark, "conversations-archives")
    grouped = conv.withColumn("bucket", F.floor(F.col("conv_id") / CONVERSATIONS_PER_FILE).cast("int"))
    written = grouped.groupBy("bucket").applyInPandas(build_archive(dest), "bucket int, path string")
    written.write.mode("overwrite").parquet(dest + "_manifest")   # runs the writer tasks once
    res = read_tables(spark, dest, IngestOptions(), table_name="conversations")
    return res["conversations"].data


SQL["archive_expand"] = CONV_TYPED_SQL

QUERIES_FILES = {
    "ingest_end_to_end": ingest_end_to_end,
    "csv_split_parallel": csv_split_parallel,
    "csv_split_heuristic": csv_split_heuristic,
    "csv_roundtrip_customer": csv_roundtrip_customer,
    "regex_parse_file": regex_parse_file,
    "archive_expand": archive_expand,
    **file_queries.QUERIES,
}
SQL.update(file_queries.SQL)


QUERIES = {
    "infer_types_orders": infer_types_orders,
    "table_schema_orders": table_schema_orders,
    "merge_schema_lineitem": merge_schema_lineitem,
    "merge_schema_global": merge_schema_global,
    "typed_cast_events": typed_cast_events,
    "mixed_column_merge": mixed_column_merge,
    "lossy_cast_audit": lossy_cast_audit,
    "boolean_words": boolean_words,
    "iso_temporal_normalize": iso_temporal_normalize,
    "header_normalize": header_normalize,
    "header_validate": header_validate,
    "regex_split_records": regex_split_records,
    "table_name_from_uri": table_name_from_uri,
    "header_lookup_join": header_lookup_join,
    "split_ranges": split_ranges,
    "quarantine_ragged": quarantine_ragged,
    "csv_line_parse": csv_line_parse,
    **QUERIES_FILES,
}
