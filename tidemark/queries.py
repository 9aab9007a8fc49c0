"""A query for each operator, over whole tables, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import encode as E
from .operators import changelog as C
from .operators import sharding as H
from .operators import splits as G
from .plans import document as D
from .plans import search as Q
from .sources.index import Field, IndexCatalog
from .sources.topic import records
from .storage import fresh_path, saved, table
from .streaming.runner import Ingest

ASCII_WORDS = "[^a-z0-9]+"
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def fields_of(docs: DataFrame, key: str) -> DataFrame:
    """A row for each value of each field of documents."""
    return docs.select(key, F.explode("doc").alias("field", "vs")).select(key, "field", F.explode("vs").alias("value"))


def _long(source: str, key: str, fields: dict[str, str]) -> str:
    """SQL for fields_of: field name to text expression."""
    return " union all ".join(f"select {key}, '{n}' as field, {e} as value from {source} where {e} is not null" for n, e in fields.items())


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a changelog of users."""
    kind = F.when(F.col("event_type") == "signup", "+I").when(F.col("event_type").isin("purchase", "click"), "+U").when(F.col("event_type") == "view", "-U").otherwise("-D")
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id", "user_id", "value", "props", "ts", kind.alias("_row_kind"), (F.col("user_id") % 8).alias("_bucket"),
        (F.datediff("ts", F.lit("2024-01-01")) + 1).cast("long").alias("_snapshot_id"), F.col("event_id").alias("_seq"),
    )


CHANGES = """
changes as (select event_id, user_id, value, props, ts,
  case when event_type = 'signup' then '+I' when event_type in ('purchase', 'click') then '+U' when event_type = 'view' then '-U' else '-D' end _row_kind,
  user_id % 8 _bucket, cast(date_diff('day', date '2024-01-01', cast(ts as date)) + 1 as bigint) _snapshot_id, event_id _seq from events),
ops as (select *, case when _row_kind in ('+I', '+U') then 'ADD' else 'DELETE' end op from changes where _row_kind <> '-U'),
ranked as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn from ops)
"""
ORDER = ("ts", "event_id")


# -- rows as documents --


@query(_long("customer", "c_custkey", {n: f"cast({n} as varchar)" for n in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")}))
def p1_projection(spark, sf_dir):
    return fields_of(D.documents(table(spark, sf_dir, "customer"), keep=["c_custkey"]), "c_custkey")


@query(_long("customer", "c_custkey", {n: f"cast({n} as varchar)" for n in ("c_custkey", "c_acctbal")}))
def p2_prefix_drop(spark, sf_dir):
    return fields_of(D.documents(table(spark, sf_dir, "customer"), keep=["c_custkey"], drop_prefixes=["c_na", "c_m"]), "c_custkey")


@query(_long("nation", "n_nationkey", {"id": "cast(n_nationkey as varchar)", "title": "n_name", "n_regionkey": "cast(n_regionkey as varchar)"}))
def p3_rename(spark, sf_dir):
    return fields_of(D.documents(table(spark, sf_dir, "nation"), keep=["n_nationkey"], rename={"n_nationkey": "id", "n_name": "title"}), "n_nationkey")


@query(_long("customer", "c_custkey", {"c_custkey": "cast(c_custkey as varchar)", "name": "c_name", "segment": "c_mktsegment"}))
def p4_drop_then_rename(spark, sf_dir):
    made = D.documents(table(spark, sf_dir, "customer"), keep=["c_custkey"], drop_prefixes=["c_acct", "c_nation"], rename={"c_name": "name", "c_mktsegment": "segment", "c_acctbal": "lost"})
    return fields_of(made, "c_custkey")


@query(
    "select d.doc_id, 1 + (case when quality is null then 0 else 1 end) + (case when toxic is null then 0 else 1 end) as n_fields, "
    "'doc_id' || case when quality is null then '' else ',quality' end || case when toxic is null then '' else ',toxic' end as names "
    "from documents d left join labels l on d.doc_id = l.doc_id"
)
def p5_doc_null_elision(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    docs = D.documents(rows, keep=["doc_id"])
    return docs.select("doc_id", F.size("doc").alias("n_fields"), F.array_join(F.array_sort(F.map_keys("doc")), ",").alias("names"))


def _nested(spark, sf_dir) -> DataFrame:
    parsed = F.from_json("props", "k int").alias("props")
    return table(spark, sf_dir, "events").select("event_id", F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind"), parsed).alias("user"))


@query("select event_id, user_id as user_id, event_type as user_kind, cast(json_extract(props, '$.k') as integer) as user_props_k from events")
def p6_flatten(spark, sf_dir):
    return D.flatten(_nested(spark, sf_dir))


@query(_long("events", "event_id", {"event_id": "cast(event_id as varchar)", "user_id": "cast(user_id as varchar)", "user_kind": "event_type", "user_props_k": "cast(json_extract(props, '$.k') as varchar)"}))
def p6_flat_documents(spark, sf_dir):
    return fields_of(D.documents(_nested(spark, sf_dir), keep=["event_id"], policy=E.TOPIC), "event_id")


@query("select event_id, value from events where event_type <> 'error'")
def p7_record_filter(spark, sf_dir):
    value = F.when(F.col("event_type") != "error", F.struct("event_id", "value"))
    return records(table(spark, sf_dir, "events").select(value.alias("value")))


@query("select o_orderkey % 5 as shard, count(*) as n, sum(o_orderkey) as keys from orders group by 1")
def p9_shard_scan(spark, sf_dir):
    """Each of five instances reads its partition of a partitioned copy of the orders; together they read all."""
    path = fresh_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    orders.withColumn("part", H.shard_of(F.col("o_orderkey"), 5)).write.partitionBy("part").parquet(path)
    strategy = H.ModuloSharding(5, "part")
    strategy.validate("orders", ["part"])
    copy = spark.read.schema("o_orderkey long, part long").parquet(path)
    each = [strategy.apply(copy, f"search-orders-{i}").groupBy(F.lit(i).cast("long").alias("shard")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")) for i in range(5)]
    return C.appended(*each)


# -- values as text --


@query("select l_orderkey, l_linenumber, cast(l_orderkey as varchar) as a, cast(l_linenumber as varchar) as b, case when l_linenumber > 3 then 'true' else 'false' end as c from lineitem")
def t1_ints(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("late", F.col("l_linenumber") > 3)
    return rows.select("l_orderkey", "l_linenumber", *[E.scalar(F.col(c), rows.schema[c].dataType).alias(n) for c, n in (("l_orderkey", "a"), ("l_linenumber", "b"), ("late", "c"))])


@query("select l_orderkey, l_linenumber, cast(l_quantity as varchar) as a, cast(l_extendedprice as varchar) as b, cast(l_discount as varchar) as c from lineitem")
def t2_doubles(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", *[E.scalar(F.col(c), T.DoubleType()).alias(n) for c, n in (("l_quantity", "a"), ("l_extendedprice", "b"), ("l_discount", "c"))])


@query("select o_orderkey, o_orderstatus as status, o_orderpriority as priority from orders")
def t3_strings(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return rows.select("o_orderkey", E.scalar(F.col("o_orderstatus"), T.StringType()).alias("status"), E.scalar(F.col("o_orderpriority"), T.StringType()).alias("priority"))


@query("select o_orderkey, cast(cast(o_totalprice as decimal(14, 2)) as varchar) as price from orders")
def t4_decimal(spark, sf_dir):
    kind = T.DecimalType(14, 2)
    return table(spark, sf_dir, "orders").select("o_orderkey", E.scalar(F.col("o_totalprice").cast(kind), kind).alias("price"))


@query("select o_orderkey, cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as varchar) as day from orders")
def t5_epoch_day(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", E.scalar(F.to_date("o_orderdate"), T.DateType()).alias("day"))


@query("select event_id, cast((epoch_us(ts) // 1000) % 86400000 as varchar) as ms from events")
def t6_time_of_day(spark, sf_dir):
    ms = (E.epoch_millis(F.col("ts"), T.TimestampNTZType()) % 86_400_000).cast("int")
    return table(spark, sf_dir, "events").select("event_id", E.scalar(ms, T.IntegerType()).alias("ms"))


@query("select event_id, cast(epoch_us(ts) // 1000 as varchar) as ms from events")
def t7_epoch_ms(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", E.scalar(F.col("ts"), T.TimestampNTZType()).alias("ms"))


@query("select doc_id, md5(to_base64(encode(text))) as digest from documents")
def t8_base64(spark, sf_dir):
    text = E.scalar(F.col("text").cast("binary"), T.BinaryType())
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.cast("binary")).alias("digest"))


@query(
    "select doc_id, md5(replace(replace(replace(replace(replace(text, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(10), chr(92) || 'n'), "
    "chr(13), chr(92) || 'r'), chr(9), chr(92) || 't')) as digest from documents"
)
def t9_escape(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(E.escape(F.col("text")).cast("binary")).alias("digest"))


@query(
    "select l_orderkey, '[' || string_agg(cast(l_linenumber as varchar), ',' order by l_linenumber, l_returnflag) || ']' as numbers, "
    "'[' || string_agg(case when l_returnflag = 'N' then 'null' else '\"' || l_returnflag || '\"' end, ',' order by l_linenumber, l_returnflag) || ']' as flags from lineitem group by 1"
)
def t10_array_json(spark, sf_dir):
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag", flag.alias("f"))))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(lines.alias("s"))
    numbers, flags = F.transform("s", lambda s: s["l_linenumber"]), F.transform("s", lambda s: s["f"])
    return rows.select("l_orderkey", E.json_array(numbers, T.ArrayType(T.IntegerType())).alias("numbers"), E.json_array(flags, T.ArrayType(T.StringType())).alias("flags"))


@query("select n_regionkey, '{' || string_agg('\"' || n_name || '\":\"' || n_nationkey || '\"', ',' order by n_name) || '}' as nations from nation group by 1")
def t11_map_json(spark, sf_dir):
    pairs = F.map_from_entries(F.collect_list(F.struct("n_name", "n_nationkey")))
    rows = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(pairs.alias("m"))
    return rows.select("n_regionkey", E.json_map(F.col("m"), rows.schema["m"].dataType).alias("nations"))


@query("select n_nationkey, '{\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}' as json, '{\"nested\":\"row\"}' as strict from nation")
def t12_struct_json(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").withColumn("s", F.struct("n_name", "n_regionkey"))
    kind = rows.schema["s"].dataType
    return rows.select("n_nationkey", E.text_of(F.col("s"), kind, E.LAKE).alias("json"), E.text_of(F.col("s"), kind, E.STRICT_LAKE).alias("strict"))


@query("select l_orderkey, cast(l_linenumber as varchar) as value from lineitem where l_returnflag <> 'N'")
def t14_multivalue(spark, sf_dir):
    """Arrays with null elements as multi-valued fields: nulls go, and orders without values have no field."""
    number = F.when(F.col("l_returnflag") != "N", F.col("l_linenumber"))
    values = F.transform(F.collect_list(F.struct(number.alias("n"))), lambda s: s["n"])
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(values.alias("lines"))
    docs = D.documents(rows, keep=["l_orderkey"], policy=E.TOPIC)
    return fields_of(docs, "l_orderkey").where("field = 'lines'").drop("field")


@query("select cast(c_custkey as varchar) as _id, c_name from customer")
def t15_id_text(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(E.id_text(F.col("c_custkey"), T.LongType(), "c_custkey").alias("_id"), "c_name")


@query("select o_orderkey % 30 as shard, (0 - o_orderkey) % 30 as plain, ((0 - o_orderkey) % 30 + 30) % 30 as wrapped, count(*) as n from orders group by all")
def t17_modulo(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(H.shard_of(k, 30).alias("shard"), H.shard_of(-k, 30, False).alias("plain"), H.shard_of(-k, 30).alias("wrapped"))
    return rows.groupBy("shard", "plain", "wrapped").agg(F.count("*").alias("n"))


@query("select source, round(sum(strlen(text)) / 1048576.0, 2) as mb from documents group by 1")
def t18_megabytes(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.sum(F.octet_length("text")).alias("b")).select("source", E.megabytes(F.col("b")).alias("mb"))


# -- changelogs --


@query(f"with {CHANGES} select _row_kind, case when _row_kind = '-U' then 'SKIP' when _row_kind = '-D' then 'DELETE' else 'ADD' end as op, count(*) as n from changes group by all")
def c1_dispatch(spark, sf_dir):
    rows = changelog(spark, sf_dir).withColumn("op", F.coalesce(C.operation(F.col("_row_kind")), F.lit("SKIP")))
    return rows.groupBy("_row_kind", "op").agg(F.count("*").alias("n"))


@query(f"with {CHANGES} select user_id, op, event_id, value from ranked where rn = 1")
def c2_fold(spark, sf_dir):
    return C.fold(C.operations(changelog(spark, sf_dir)), "user_id", ORDER).select("user_id", "op", "event_id", "value")


@query(f"with {CHANGES} select user_id, event_id, value from ranked where rn = 1 and op = 'ADD'")
def c2_live(spark, sf_dir):
    return C.live(C.operations(changelog(spark, sf_dir)), "user_id", ORDER).select("user_id", "event_id", "value")


RUNS = f"""
with {CHANGES}, turned as (select *, case when lag(op) over w = op then 0 else 1 end t from ops window w as (partition by _bucket order by ts, event_id)),
runs as (select *, sum(t) over (partition by _bucket order by ts, event_id rows unbounded preceding) run from turned),
cut as (select *, (row_number() over (partition by _bucket, run order by ts, event_id) - 1) // 3 batch from runs)
"""


@query(f"{RUNS} select _bucket, cast(run as bigint) as run, op, count(*) as n, min(event_id) as least from runs group by all")
def c3_runs(spark, sf_dir):
    made = C.batches(C.operations(changelog(spark, sf_dir)), "_bucket", ORDER)
    return made.groupBy("_bucket", "run", "op").agg(F.count("*").alias("n"), F.min("event_id").alias("least"))


@query(f"{RUNS} select _bucket, cast(run as bigint) as run, cast(batch as bigint) as batch, op, count(*) as n, string_agg(cast(event_id as varchar), ',' order by ts, event_id) as ids from cut group by all")
def c4_batches(spark, sf_dir):
    made = C.sent(C.operations(changelog(spark, sf_dir)), "event_id", "_bucket", ("ts", "_seq"), 3)
    return made.withColumn("ids", F.array_join(F.transform("values", lambda v: v.cast("string")), ",")).drop("values")


@query(f"with {CHANGES} select case when _row_kind in ('+I', '+U') and cast(json_extract(props, '$.k') as integer) % 10 = 0 then 'bad' else 'good' end as kind, count(*) as n, sum(event_id) as ids from changes group by 1")
def c7_poison_split(spark, sf_dir):
    poison = F.col("_row_kind").isin("+I", "+U") & (F.from_json("props", "k int").getField("k") % 10 == 0)
    good, bad = C.quarantine(changelog(spark, sf_dir), F.when(poison, "can't be converted"))
    sums = [df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), F.sum("event_id").alias("ids")) for kind, df in (("good", good), ("bad", bad))]
    return C.appended(*sums)


@query(
    f"with {CHANGES}, good as (select * from ops where not (op = 'ADD' and cast(json_extract(props, '$.k') as integer) % 10 = 0)), "
    "last as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) r from good) select user_id, event_id from last where r = 1 and op = 'ADD'"
)
def c7_fold_without_poison(spark, sf_dir):
    poison = F.col("_row_kind").isin("+I", "+U") & (F.from_json("props", "k int").getField("k") % 10 == 0)
    good, _ = C.quarantine(changelog(spark, sf_dir), F.when(poison, "can't be converted"))
    return C.live(C.operations(good), "user_id", ORDER).select("user_id", "event_id")


@query("select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_custkey is not null and o_orderpriority = '1-URGENT')")
def c8_delete_by_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return C.without_ids(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), ids, "c_custkey")


@query("select event_type, 2 * count(*) as n, 2 * sum(event_id) as ids from events group by 1")
def c10_append_only(spark, sf_dir):
    """A topic without ids delivered twice: duplicates stay."""
    events = table(spark, sf_dir, "events")
    return C.appended(events, events).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The changelog's operations up to snapshot 15 and after it."""
    ops = C.operations(changelog(spark, sf_dir)).withColumn("_id", F.col("user_id").cast("string"))
    return ops.where("_snapshot_id <= 15"), ops.where("_snapshot_id > 15")


@query(f"with {CHANGES} select cast(user_id as varchar) as _id, event_id, value from ranked where rn = 1 and op = 'ADD'")
def j2_upsert(spark, sf_dir):
    """Two snapshots applied one after the other come to the fold of both."""
    first, then = _halves(spark, sf_dir)
    current = C.live(first, "_id", ORDER).select("_id", "event_id", "value")
    return C.upsert(current, C.fold(then, "_id", ORDER), "_id")


@query("select count(*) as n, sum(o_orderkey) as keys from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def j3_semi_join(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return Q.term_set_join(table(spark, sf_dir, "orders"), wanted, "o_custkey").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("select cast(c_custkey as varchar) as key, c_name as name, cast(null as varchar) as region from customer union all select cast(n_nationkey as varchar), n_name, cast(n_regionkey as varchar) from nation")
def u1_append(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("name"))
    b = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("region"))
    return C.appended(a, b)


# -- splits and progress --


def _splits(spark, sf_dir) -> DataFrame:
    """A split for each user and snapshot; users of multiples of ten have no bucket, and some splits no sequence number."""
    c = changelog(spark, sf_dir).groupBy("user_id", "_snapshot_id").agg(F.min("_seq").alias("seq"), F.count("*").alias("row_count"))
    return c.select(
        F.concat_ws("-", "user_id", "_snapshot_id").alias("split_id"), F.when(F.col("user_id") % 10 != 0, F.col("user_id") % 8).alias("_bucket"), "_snapshot_id",
        F.when(F.col("user_id") % 7 != 0, F.col("seq")).alias("_min_seq"), (F.col("row_count") * 1000).alias("file_size"), "row_count",
    )


SPLITS = f"""
with {CHANGES}, splits as (select user_id || '-' || _snapshot_id split_id, coalesce(case when user_id % 10 <> 0 then user_id % 8 end, 0) _bucket, _snapshot_id,
  case when user_id % 7 <> 0 then min(_seq) end _min_seq, count(*) * 1000 file_size, count(*) row_count from changes group by user_id, _snapshot_id)
"""


@query(f"{SPLITS} select _bucket, count(*) as splits from splits group by 1")
def g1_bucket_group(spark, sf_dir):
    return _splits(spark, sf_dir).groupBy(G.bucket_of(F.col("_bucket")).alias("_bucket")).agg(F.count("*").alias("splits"))


@query(f"{SPLITS} select split_id, _bucket, cast(row_number() over (partition by _bucket order by _snapshot_id, coalesce(_min_seq, 0), split_id) as integer) as place from splits")
def g2_split_order(spark, sf_dir):
    return G.ordered_splits(_splits(spark, sf_dir)).select("split_id", "_bucket", "place")


@query(f"{SPLITS} select _bucket, cast(sum(file_size) as bigint) as bytes, round(sum(file_size) / 1048576.0, 2) as mb from splits group by rollup(_bucket)")
def g3_bucket_sizes(spark, sf_dir):
    return G.bucket_sizes(_splits(spark, sf_dir))


@query(f"{SPLITS} select _bucket, cast(sum(file_size) as bigint) as bytes, cast(sum(row_count) as bigint) as rows, count(*) as splits from splits group by 1")
def g4_bucket_stats(spark, sf_dir):
    return G.bucket_stats(_splits(spark, sf_dir))


@query(
    "with b as (select user_id, count(*) docs, sum(event_id % 100) ms from events group by 1) select cast(sum(docs) as bigint) as docs, count(*) as batches, cast(sum(ms) as bigint) as ms, "
    "round(sum(docs) * 1000.0 / sum(ms), 6) as docs_per_sec, round(sum(docs) * 1.0 / count(*), 6) as docs_per_batch, round(sum(ms) * 1.0 / count(*), 6) as ms_per_batch from b"
)
def g6_throughput(spark, sf_dir):
    batches = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("docs"), F.sum(F.col("event_id") % 100).alias("ms"))
    return G.throughput(batches).withColumns({c: F.round(c, 6) for c in ("docs_per_sec", "docs_per_batch", "ms_per_batch")})


# -- the index and its queries --

DOCUMENT_FIELDS = [
    Field("doc_id", "_ID", doc_values=True),
    Field("text", "TEXT", search=True),
    Field("lang", "ATOM", search=True, doc_values=True),
    Field("source", "ATOM", search=True, doc_values=True),
    Field("n_chars", "DOUBLE", doc_values=True),
]


class _Columns:
    """An index whose table is at hand: queries are judged without writing it first."""

    def __init__(self, rows: DataFrame, fields: list[Field]):
        from .sources.index import IndexSchema

        self.schema, self._rows, self.id = IndexSchema(fields), rows, fields[0].name

    def table(self) -> DataFrame:
        typed = [F.col(f.name).cast("double" if f.type == "DOUBLE" else "string").alias(f.name) for f in self.schema.fields]
        return self._rows.select(F.col(self.id).cast("string").alias("_id"), *typed)


def _found(spark, sf_dir, q) -> DataFrame:
    index = _Columns(table(spark, sf_dir, "documents"), DOCUMENT_FIELDS)
    return index.table().where(q.predicate(index.schema))


@query("select cast(doc_id as varchar) as _id from documents")
def r1_match_all(spark, sf_dir):
    return _found(spark, sf_dir, Q.MatchAll()).select("_id")


@query("select cast(doc_id as varchar) as _id, source from documents")
def r2_empty_query(spark, sf_dir):
    return _found(spark, sf_dir, Q.Empty()).select("_id", "source")


@query("select cast(doc_id as varchar) as _id, lang from documents where lang = 'de'")
def r3_term(spark, sf_dir):
    return _found(spark, sf_dir, Q.Term("lang", "de")).select("_id", "lang")


@query("select cast(doc_id as varchar) as _id from documents where list_has_any(regexp_split_to_array(lower(text), '[^a-z0-9]+'), ['license', 'password'])")
def r4_match(spark, sf_dir):
    return _found(spark, sf_dir, Q.Match("text", "License PASSWORD", ASCII_WORDS)).select("_id")


@query(
    "with d as (select doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '') w from documents), "
    "c as (select doc_id, len(w) n, len(list_filter(w, lambda x: x = 'license')) a, len(list_filter(w, lambda x: x = 'password')) b from d), "
    "s as (select count(*) n, avg(n) m, count(*) filter (where a > 0) da, count(*) filter (where b > 0) db from c), "
    "r as (select doc_id, ln(1 + (s.n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * c.n / m)) "
    "+ ln(1 + (s.n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * c.n / m)) score from c, s where a + b > 0) "
    "select cast(doc_id as varchar) as _id, round(score, 6) as score from r"
)
def r4_bm25(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("_id"), "text")
    return Q.bm25(docs, "_id", "text", "license password", ASCII_WORDS).withColumn("score", F.round("score", 6))


@query("select cast(doc_id as varchar) as _id, source from documents where source in ('src1', 'src7', 'none')")
def r5_terms_in_set(spark, sf_dir):
    return _found(spark, sf_dir, Q.TermInSet("source", ["src1", "src7", "none"])).select("_id", "source")


@query("select cast(doc_id as varchar) as _id, 1.0::double as score, lang, cast(n_chars as double) as n_chars from documents where lang = 'es' order by cast(doc_id as varchar) limit 95 offset 5")
def r6_retrieve(spark, sf_dir):
    index = _Columns(table(spark, sf_dir, "documents"), DOCUMENT_FIELDS)
    return Q.search(index, Q.Term("lang", "es"), 5, 100, ["lang", "n_chars"]).hits


@query("select cast(doc_id as varchar) as _id, n_chars || '.0' as n_chars from documents")
def r7_rendered(spark, sf_dir):
    return _found(spark, sf_dir, Q.Empty()).select("_id", Q.rendered(F.col("n_chars")).alias("n_chars"))


@query("select cast(o_orderkey as varchar) as _id, o_orderstatus from orders order by 1 limit 10 offset 20")
def g8_page(spark, sf_dir):
    """The third page of ten hits."""
    index = _Columns(table(spark, sf_dir, "orders"), [Field("o_orderkey", "_ID"), Field("o_orderstatus", "ATOM")])
    return Q.search(index, Q.MatchAll(), 20, 30, ["o_orderstatus"]).hits.select("_id", "o_orderstatus")


@query("select count(*) as total from documents where lang = 'en'")
def g9_total_hits(spark, sf_dir):
    index = _Columns(table(spark, sf_dir, "documents"), DOCUMENT_FIELDS)
    return spark.range(1).select(F.lit(Q.search(index, Q.Term("lang", "en"), 0, 0).total).cast("long").alias("total"))


@query("select 'search_' || n_name || '-' || n_nationkey as service, n_nationkey as shard from nation")
def p8_shard_id(spark, sf_dir):
    """Shards that services are named for; a service knows its own on its driver, so names are few."""
    named = table(spark, sf_dir, "nation").select(F.concat(F.lit("search_"), "n_name", F.lit("-"), "n_nationkey").alias("service")).collect()
    return spark.createDataFrame([(r["service"], H.shard_id(r["service"], 25)) for r in named], "service string, shard int")


@query(
    "select * from (values ('open what is not created', 'index made does not exist, or isnt started'), ('open what is not started', 'index made does not exist, or isnt started'), "
    "('create again', 'index made exists'), ('register a field again', 'index made has a field id'), ('started', 'id, name')) t(step, outcome)"
)
def r8_lifecycle(spark, sf_dir):
    """Created, given fields, started; what comes too early or twice is refused."""
    catalog, rows = IndexCatalog(spark, fresh_path(spark, "indexes")), []

    def refused(step, act):
        try:
            act()
        except (RuntimeError, ValueError) as e:
            rows.append((step, str(e).replace("'", "")))

    refused("open what is not created", lambda: catalog.open("made"))
    catalog.create("made")
    refused("open what is not started", lambda: catalog.open("made"))
    refused("create again", lambda: catalog.create("made"))
    catalog.register("made", [Field("id", "_ID"), Field("name", "ATOM")])
    refused("register a field again", lambda: catalog.register("made", [Field("id", "ATOM")]))
    rows.append(("started", ", ".join(f.name for f in catalog.start("made").schema.fields)))
    return spark.createDataFrame(rows, "step string, outcome string")


USER_FIELDS = [Field("user_id", "_ID"), Field("event_id", "ATOM"), Field("value", "DOUBLE")]


@query(f"with {CHANGES} select cast(user_id as varchar) as _id, cast(event_id as varchar) as event_id, value from ranked where rn = 1 and op = 'ADD'")
def s9_index_upsert(spark, sf_dir):
    """The changelog written to an index in two batches, each sent twice, and the index read back."""
    return _ingested(spark, sf_dir, [b for p in ("_snapshot_id <= 15", "_snapshot_id > 15") for b in (p, p)], [0, 0, 1, 1])


def _ingested(spark, sf_dir, parts: list[str], numbers: list[int]) -> DataFrame:
    """An index after parts of the changelog, applied one after another as batches of these numbers."""
    catalog = IndexCatalog(spark, fresh_path(spark, "indexes"))
    catalog.create("users")
    catalog.register("users", USER_FIELDS)
    catalog.start("users")
    rows = changelog(spark, sf_dir)
    ingest = Ingest(catalog, "users", drop_prefixes=["ts", "props"], order=("_snapshot_id", "ts", "_seq"))
    for part, number in zip(parts, numbers, strict=True):
        ingest.apply_changes(rows.where(part), number)
    return catalog.open("users").table().select("_id", "event_id", "value")


@query(f"with {CHANGES} select cast(user_id as varchar) as _id, cast(event_id as varchar) as event_id, value from ranked where rn = 1 and op = 'ADD'")
def s5_out_of_order(spark, sf_dir):
    """The changelog's snapshots in batches that come in the wrong order: older operations don't undo newer ones."""
    return _ingested(spark, sf_dir, ["_snapshot_id between 11 and 20", "_snapshot_id > 20", "_snapshot_id <= 10"], [0, 1, 2])


@query("select cast(c_custkey as varchar) as _id, c_name from customer where c_custkey not in (select o_custkey from orders where o_custkey is not null and o_orderpriority = '1-URGENT')")
def s10_delete_by_query(spark, sf_dir):
    """Customers put into an index, and those with urgent orders deleted from it."""
    catalog = IndexCatalog(spark, fresh_path(spark, "indexes"))
    catalog.create("customers")
    catalog.register("customers", [Field("c_custkey", "_ID"), Field("c_name", "TEXT", search=True)])
    index = catalog.start("customers")
    rows = table(spark, sf_dir, "customer").withColumn("_id", F.col("c_custkey").cast("string"))
    index.add(D.documents(rows, keep=["_id"], meta=["_id"]))
    index.delete(table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").cast("string").alias("_id")))
    return index.table().select("_id", "c_name")


@query("select cast(doc_id as varchar) as _id, lang, source from documents where lang = 'en'")
def s4_lake_to_search(spark, sf_dir):
    """End to end: a table projected to documents, an index of them, and a term query on it."""
    catalog = IndexCatalog(spark, fresh_path(spark, "indexes"))
    catalog.create("docs")
    catalog.register("docs", DOCUMENT_FIELDS)
    index = catalog.start("docs")
    rows = table(spark, sf_dir, "documents").withColumn("_id", F.col("doc_id").cast("string"))
    index.add(D.documents(rows, keep=["_id"], meta=["_id"]))
    hits = index.table().where(Q.Term("lang", "en").predicate(index.schema))
    return hits.select("_id", "lang", "source")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saved(s4_lake_to_search(spark, sf_dir), "flagship")
