"""The registered queries: every operator applied to whole tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.interleave import interleave_code
from ..functions.numbering import assign_identity
from ..functions.scalars import interval, parse_ts, round_cast, trunc_ts, ts
from ..operators import filters, joins, loads, profiles, querylog, reports, sketches
from ..operators import upkeep as keep
from ..session import new_name, new_path, stage
from ..sources import eventlog, files, footers, grams, synthetic, zones
from ..streaming import loads as streams
from . import fixtures as fx
from . import history, identity, jobs, parts, procedures, tables, upkeep
from .fixtures import EVENTS_NOW, ORDERS_NOW
from .layout import Layout, files_of, pieces_of, write_files

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

MONTH = ("1998-01-01", "1998-01-31")
ORDER_COLUMNS = ["customer_id", "order_date", "total_amount", "status"]
SALES_SORT = ("sale_date", "region", "store_id")


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# --- Scans -----------------------------------------------------------------------------------------------------------

def _sales_csv(spark: SparkSession, sf: str) -> str:
    return fx.written(spark, sf, "sales_csv", lambda p: fx.sales_as_text(spark, sf).write.csv(p))


def _sales_parquet(spark: SparkSession, sf: str) -> str:
    return fx.written(spark, sf, "sales_parquet", lambda p: fx.sales(spark, sf).write.parquet(p))


def _sales_partitioned(spark: SparkSession, sf: str) -> str:
    return fx.written(spark, sf, "sales_partitioned", lambda p: (
        fx.sales_by_month(spark, sf).hint("rebalance", "sale_date", "region")
        .write.partitionBy("sale_date", "region").csv(p)))


@query
def scan_delimited(spark: SparkSession, sf: str) -> DataFrame:
    """Text dates compared as text, then parsed; what does not parse is NULL."""
    rows = files.read_delimited(spark, _sales_csv(spark, sf), fx.SALES_CSV_SCHEMA)
    chosen = filters.between_dates_as_text(rows, "sale_date", *MONTH).where("region = 'West'")
    return reports.top_k(chosen, [F.col("sale_id")], 1000).select(
        "sale_id", "product_id", "customer_id", "sale_amount",
        parse_ts(F.col("sale_date")).alias("sale_date_timestamp"), "region", "store_id")


@query
def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    rows = files.read_parquet(spark, _sales_parquet(spark, sf), fx.SALES_SCHEMA)
    chosen = filters.between(rows, "sale_date", *MONTH).where("region = 'West' AND category = 'Electronics'")
    return reports.top_k(chosen, [F.col("sale_date").desc(), F.col("sale_id")], 1000).drop("is_active")


@query
def scan_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Whole partitioned table, counted per partition."""
    rows = files.read_partitioned(spark, _sales_partitioned(spark, sf), fx.SALES_PART_SCHEMA)
    return rows.groupBy("sale_date", "region").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("sale_amount").cast(reports.MONEY).alias("sale_amount"))


@query
def filter_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Sorted by the partition date, which is not in the result."""
    rows = files.read_partitioned(spark, _sales_partitioned(spark, sf), fx.SALES_PART_SCHEMA)
    day = F.col("sale_date")
    chosen = rows.where(day.between(*[F.lit(d).cast("date") for d in MONTH])
                        & (F.col("region") == "West") & (F.col("category") == "Electronics"))
    return reports.top_k(chosen, [day.desc(), F.col("sale_id")], 1000).select(
        "sale_id", "product_id", "customer_id", "sale_amount", "store_id", "category")


@query
def register_partition(spark: SparkSession, sf: str) -> DataFrame:
    """One partition registered by hand, the rest found below the table's folder."""
    database, place = new_name("ext"), new_path(spark, "ext")
    files.create_database(spark, database, place)
    base = new_path(spark, "registered")
    fx.sales_by_month(spark, sf).hint("rebalance", "sale_date", "region").write.partitionBy(
        "sale_date", "region").parquet(base)
    table = f"{database}.sales"
    files.create_external_table(spark, table, fx.SALES_PART_SCHEMA, "parquet", base, ("sale_date", "region"))
    files.register_partition(spark, table, {"sale_date": "1998-01-01", "region": "West"},
                             f"{base}/sale_date=1998-01-01/region=West")
    files.recover_partitions(spark, table)
    return spark.table(table).groupBy("sale_date", "region").agg(F.count(F.lit(1)).alias("row_count"))


@query
def extract_files(spark: SparkSession, sf: str) -> DataFrame:
    path = sf if ":/" in sf or sf.startswith("/") else f"file:{sf}"
    return files.extract(spark, f"{path}/orders.parquet").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("o_totalprice").cast("decimal(10,2)")).cast(reports.MONEY).alias("total_price"))


@query
def generate_sales(spark: SparkSession, sf: str) -> DataFrame:
    """One synthetic sale per order."""
    ids = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    return synthetic.generate_sales(ids, 1, ORDERS_NOW)


@query
def generate_facts(spark: SparkSession, sf: str) -> DataFrame:
    """One synthetic fact per event."""
    ids = fx.table(spark, sf, "events").select(F.col("event_id").alias("id"))
    return synthetic.generate_facts(ids, 1, EVENTS_NOW)


REPORTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
            "benchmark", "labels", "conversations")


@query
def compression_report(spark: SparkSession, sf: str) -> DataFrame:
    """Codec, encodings and sizes of every column of the given tables, each a file or a folder of files."""
    return footers.compression_report(spark, {n: (f"{sf}/{n}.parquet", "*.parquet") for n in REPORTED})


@query
def compression_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The part of that report which SQL can tell: values per column, all of a known codec."""
    known = F.col("codec").isin("SNAPPY", "GZIP", "ZSTD", "LZ4", "LZ4_RAW", "BROTLI", "UNCOMPRESSED")
    return compression_report(spark, sf).select("table_name", "column_name", "value_count", known.alias("codec_known"),
                                                (F.col("compressed_bytes") > 0).alias("has_bytes"))


# --- Sinks and layout ------------------------------------------------------------------------------------------------

def _sales_table(spark: SparkSession, sf: str, layout: Layout) -> DataFrame:
    table = new_name("sales")
    tables.save_table(fx.sales(spark, sf), table, layout)
    return spark.table(table)


@query
def append_load(spark: SparkSession, sf: str) -> DataFrame:
    """Rows missing from the target, appended to it; columns go by name."""
    table = new_name("orders")
    tables.save_table(fx.tgt_orders(spark, sf), table)
    fresh = joins.missing(fx.src_orders(spark, sf), spark.table(table), ["order_id"])
    tables.append(fresh.select(*reversed(fresh.columns)), table)
    return spark.table(table)


@query
def layout_even(spark: SparkSession, sf: str) -> DataFrame:
    return _sales_table(spark, sf, Layout(dist="even"))


@query
def layout_auto(spark: SparkSession, sf: str) -> DataFrame:
    return _sales_table(spark, sf, Layout())


@query
def layout_key(spark: SparkSession, sf: str) -> DataFrame:
    return _sales_table(spark, sf, Layout(dist="key", key="customer_id", sort=SALES_SORT))


@query
def layout_all_join(spark: SparkSession, sf: str) -> DataFrame:
    """Parts and their small, replicated category dimension."""
    table = new_name("categories")
    tables.save_table(fx.product_categories(spark, sf), table, Layout(dist="all"))
    parts = fx.table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category_id"), "p_size")
    return joins.broadcast_dim(parts, spark.table(table), ["category_id"])


def _sorted(spark: SparkSession, sf: str) -> str:
    return fx.written(spark, sf, "sales_sorted", lambda p: write_files(
        fx.sales(spark, sf), p, Layout(sort=SALES_SORT)))


@query
def layout_compound_sort(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_parquet(spark, _sorted(spark, sf))


@query
def layout_interleaved(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_parquet(spark, _interleaved(spark, sf))


def _interleaved(spark: SparkSession, sf: str) -> str:
    return fx.written(spark, sf, "sales_interleaved", lambda p: write_files(
        fx.sales(spark, sf), p, Layout(interleave=("sale_date", "region", "store_id", "product_id"))))


@query
def interleave_key(spark: SparkSession, sf: str) -> DataFrame:
    """The clustering code with fixed bounds."""
    years = [ts(f"{y}-01-01 00:00:00") for y in (1996, 1998, 2000)]
    code = interleave_code([(F.col("sale_date"), years), (F.col("region"), ["East", "West"]),
                            (F.col("store_id"), [25, 50, 75]), (F.col("product_id"), ["PROD_3", "PROD_6"])], 2)
    return fx.sales(spark, sf).select("sale_id", code.alias("code"))


@query
def layout_encoded(spark: SparkSession, sf: str) -> DataFrame:
    encodings = {"sale_id": "delta", "product_id": "dict", "sale_date": "delta", "region": "dict", "store_id": "delta",
                 "category": "dict", "customer_id": "plain"}
    return _sales_table(spark, sf, Layout(encodings=encodings, codec="zstd"))


@query
def layout_bloom(spark: SparkSession, sf: str) -> DataFrame:
    """Sales of some customers, one of whom does not exist, from files in no order that have Bloom filters."""
    rows, path = fx.sales(spark, sf), new_path(spark, "bloom")
    write_files(rows, path, Layout(dist="even", bloom=("customer_id",)))
    return files.read_parquet(spark, path, fx.SALES_SCHEMA).where(F.col("customer_id").isin("CUST_7", "CUST_70", "CUST_none"))


@query
def native_vs_external(spark: SparkSession, sf: str) -> DataFrame:
    """The same filter on the native copy and on the files; both answers side by side."""
    outside = files.read_parquet(spark, _sales_parquet(spark, sf), fx.SALES_SCHEMA)
    table = new_name("native")
    tables.save_table(outside, table, Layout(dist="key", key="customer_id", sort=SALES_SORT))

    def answer(rows: DataFrame, side: str) -> DataFrame:
        return filters.between(rows, "sale_date", *MONTH).where("region = 'West'").agg(
            F.lit(side).alias("side"), F.count(F.lit(1)).alias("row_count"),
            F.sum("sale_amount").cast(reports.MONEY).alias("sale_amount"))
    return answer(spark.table(table), "native").unionByName(answer(outside, "external"))


# --- Filters ---------------------------------------------------------------------------------------------------------

@query
def filter_compound(spark: SparkSession, sf: str) -> DataFrame:
    """Only files whose zones meet both ranges are opened."""
    low, high = MONTH
    return zones.scan_zones(spark, _sorted(spark, sf), {"sale_date": (ts(low), ts(high)), "region": (F.lit("West"), F.lit("West"))})


@query
def filter_interleaved(spark: SparkSession, sf: str) -> DataFrame:
    store = F.lit(100)
    return zones.scan_zones(spark, _interleaved(spark, sf), {"region": (F.lit("West"), F.lit("West")), "store_id": (store, store)})


@query
def filter_time_series(spark: SparkSession, sf: str) -> DataFrame:
    path = fx.written(spark, sf, "time_series", lambda p: write_files(
        fx.time_series(spark, sf), p, Layout(sort=("timestamp",))))
    return filters.between(files.read_parquet(spark, path), "timestamp", "2024-01-01 00:00:00", "2024-01-15 23:59:59")


@query
def filter_string_dates(spark: SparkSession, sf: str) -> DataFrame:
    """The same month by text order and by parsed time."""
    rows = fx.sales_as_text(spark, sf)

    def chosen(typed: bool, rule: str) -> DataFrame:
        return filters.between_dates_as_text(rows, "sale_date", *MONTH, typed=typed).select(
            F.lit(rule).alias("rule"), "sale_id", "sale_date")
    return chosen(False, "text").unionByName(chosen(True, "typed"))


@query
def parse_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    return fx.sales_as_text(spark, sf).select("sale_id", parse_ts(F.col("sale_date")).alias("parsed"))


@query
def cast_rounding(spark: SparkSession, sf: str) -> DataFrame:
    lines = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity")
    price = F.col("l_extendedprice")
    exact = lines.withColumn("exact", price.cast("decimal(12,2)"))
    return exact.select(
        "l_orderkey", round_cast(price, lines.schema["l_extendedprice"].dataType, "bigint").alias("from_double"),
        round_cast(F.col("exact"), exact.schema["exact"].dataType, "bigint").alias("from_decimal"))


# --- Joins -----------------------------------------------------------------------------------------------------------

@query
def existing_orders(spark: SparkSession, sf: str) -> DataFrame:
    return joins.existing(fx.src_orders(spark, sf), fx.tgt_orders(spark, sf), ["order_id"])


@query
def new_orders(spark: SparkSession, sf: str) -> DataFrame:
    return joins.missing(fx.src_orders(spark, sf), fx.tgt_orders(spark, sf), ["order_id"])


@query
def join_inner_multi(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer and nation."""
    orders, customer, nation = (fx.table(spark, sf, t) for t in ("orders", "customer", "nation"))
    return (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("o_orderkey", "c_name", "n_name", F.col("o_totalprice").cast("decimal(10,2)").alias("price")))


@query
def join_colocated(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and orders, bucketed alike by customer."""
    layout = Layout(dist="key", key="customer_id")
    left, right = new_name("orders"), new_name("customers")
    tables.save_table(fx.src_orders(spark, sf), left, layout)
    tables.save_table(fx.customers(spark, sf), right, layout)
    return joins.colocated_join(spark, left, right, "customer_id").select(
        "customer_id", "customer_name", "order_id", "total_amount")


@query
def update_from(spark: SparkSession, sf: str) -> DataFrame:
    """A source that lacks some of the target's orders: those stay as they are."""
    return loads.update_from(fx.tgt_orders(spark, sf), fx.src_orders(spark, sf).where("order_id % 15 <> 4"), ["order_id"],
                             ["total_amount", "status"])


@query
def key_violations(spark: SparkSession, sf: str) -> DataFrame:
    return joins.key_violations(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- Reports ---------------------------------------------------------------------------------------------------------

@query
def top_customers(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_by_sum(fx.transactions(spark, sf), "customer_id", "amount", "transaction_date", ORDERS_NOW,
                              "30 DAYS", "completed", 100)


@query
def daily_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.period_report(fx.transactions(spark, sf), "day", "transaction_date", "amount", ORDERS_NOW, "30 DAYS")


@query
def throughput(spark: SparkSession, sf: str) -> DataFrame:
    runs = filters.recent(fx.batch_runs(spark, sf), "processing_date", EVENTS_NOW, "7 DAYS")
    return reports.throughput(runs, "records_processed", "processing_time_seconds").orderBy(
        F.col("processing_date").desc(), "batch_id").drop("batch_id")


@query
def high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    return reports.high_water_mark(fx.tgt_orders(spark, sf), "order_date")


@query
def latest_version(spark: SparkSession, sf: str) -> DataFrame:
    """The newest line of each order."""
    tiebreak = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return reports.latest_version(fx.table(spark, sf, "lineitem"), ["l_orderkey"], "l_shipdate", tiebreak).select(
        "l_orderkey", "l_shipdate", *tiebreak)


@query
def keyset_page(spark: SparkSession, sf: str) -> DataFrame:
    return reports.keyset_page(fx.src_orders(spark, sf), "order_id", 100, 1000)


@query
def identity_across_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads by day of month, the second one run twice: every load's keys follow on those before it."""
    events = fx.table(spark, sf, "events").select("event_id", "ts", "event_type")
    table, ledger = new_name("events"), new_path(spark, "ledger")
    tables.save_table(events.limit(0).withColumn("row_key", F.lit(0).cast("bigint")), table)
    for load in ("0", "1", "1", "2"):
        rows = events.where(F.dayofmonth("ts") % 3 == int(load))
        identity.load_with_identity(rows, table, ledger, f"load {load}", ["ts", "event_id"])
    return spark.table(table)


@query
def assign_identity_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "events").select("event_id", "ts", "event_type")
    return assign_identity(rows, ["ts", "event_id"], name="row_key")


# --- Loads -----------------------------------------------------------------------------------------------------------

def _loaded(spark: SparkSession, sf: str, until: str) -> DataFrame:
    return fx.src_orders(spark, sf).where(F.col("order_date") <= ts(until))


@query
def inc_by_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return loads.incremental_by_timestamp(fx.src_orders(spark, sf), _loaded(spark, sf, "2001-01-01 00:00:00"),
                                          "order_date", ORDERS_NOW)


@query
def inc_by_timestamp_initial(spark: SparkSession, sf: str) -> DataFrame:
    source = fx.src_orders(spark, sf)
    return loads.incremental_by_timestamp(source, source.where(F.col("order_id") < 0), "order_date",
                                          "2001-01-01 00:00:00")


@query
def inc_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A target that lacks a tenth of its rows: those within the lookback are found."""
    return loads.incremental_by_timestamp(
        fx.src_orders(spark, sf), _loaded(spark, sf, "2001-01-01 00:00:00").where("order_id % 10 <> 0"), "order_date",
        ORDERS_NOW, lookback="365 DAYS", keys=["order_id"])


@query
def inc_by_id(spark: SparkSession, sf: str) -> DataFrame:
    source = fx.src_orders(spark, sf)
    return loads.incremental_by_id(source, source.where("order_date < TIMESTAMP_NTZ '1995-01-03 00:00:00'"), "order_id")


@query
def inc_by_id_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return loads.incremental_by_id(fx.src_orders(spark, sf), fx.tgt_orders(spark, sf), "order_id", fill_gaps=True)


def _classified(spark: SparkSession, sf: str, **options) -> DataFrame:
    return loads.classify_changes(fx.src_orders(spark, sf), fx.tgt_orders(spark, sf), ["order_id"],
                                  ["status", "total_amount"], ORDERS_NOW, **options)


@query
def cdc_classify(spark: SparkSession, sf: str) -> DataFrame:
    return _classified(spark, sf)


@query
def cdc_classify_plain(spark: SparkSession, sf: str) -> DataFrame:
    return _classified(spark, sf, null_safe=False)


@query
def cdc_classify_window(spark: SparkSession, sf: str) -> DataFrame:
    """Only rows created in the last 30 days, and all that differ."""
    return _classified(spark, sf, window="30 DAYS")


def _with_gone(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A source that has lost a fifteenth of its orders, and the target."""
    return fx.src_orders(spark, sf).where("order_id % 15 <> 4"), fx.tgt_orders(spark, sf)


@query
def cdc_deletes(spark: SparkSession, sf: str) -> DataFrame:
    source, target = _with_gone(spark, sf)
    return loads.classify_changes(source, target, ["order_id"], ["status", "total_amount"], ORDERS_NOW,
                                  detect_deletes=True)


@query
def cdc_apply(spark: SparkSession, sf: str) -> DataFrame:
    source, target = _with_gone(spark, sf)
    changes = stage(cdc_deletes(spark, sf), "changes")
    loaded = target.drop("created_at").withColumn("loaded_at", ts("2001-06-30 00:00:00"))
    return loads.apply_changes(loaded, changes, ["order_id"], ORDER_COLUMNS, {"loaded_at": ts(ORDERS_NOW)})


def _three_batches(spark: SparkSession, sf: str) -> tuple[DataFrame, list[DataFrame]]:
    """A target, and three batches of changes: the classified ones; updates, also of keys that are gone; new rows under keys that
    were deleted, and deletions."""
    base = fx.tgt_orders(spark, sf).drop("created_at").withColumn("loaded_at", ts("2001-06-30 00:00:00"))
    rows = fx.src_orders(spark, sf).drop("created_at")
    first = cdc_deletes(spark, sf).drop("processed_at")
    second = rows.where("order_id % 4 = 0").withColumn("status", F.lit("B2")).withColumn(
        "total_amount", (F.col("total_amount") + 10).cast("decimal(10,2)")).withColumn("operation_type", F.lit("UPDATE"))
    again = F.col("order_id") % 30 == 4
    third = rows.where(again | (F.col("order_id") % 7 == 0)).withColumn("status", F.lit("B3")).withColumn(
        "operation_type", F.when(again, "INSERT").otherwise("DELETE"))
    return base, [first, second, third]


@query
def replay_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The target as of each of three recorded batches; the second one is recorded twice."""
    base, batches = _three_batches(spark, sf)
    folder = new_path(spark, "changes")
    for number in (0, 1, 1, 2):
        history.record(batches[number], folder, ["order_id"], number)
    log = history.recorded(spark, folder, batches[0].schema)
    states = [history.rebuilt(base, log, ["order_id"], n).withColumn("as_of_batch", F.lit(n)) for n in range(3)]
    return states[0].unionByName(states[1]).unionByName(states[2])


@query
def staging_purge(spark: SparkSession, sf: str) -> DataFrame:
    """Staged rows processed at the time the order was created."""
    staging = fx.src_orders(spark, sf).withColumnRenamed("created_at", "processed_at")
    return loads.purge_staging(staging, "2001-01-01 12:00:00")


@query
def delta_load(spark: SparkSession, sf: str) -> DataFrame:
    feed = fx.table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return loads.delta_load(feed, feed.where("event_id % 3 = 0"), ["user_id"], "ts", EVENTS_NOW, ["event_id"],
                            window="24 HOURS")


@query
def batch_assign(spark: SparkSession, sf: str) -> DataFrame:
    source = fx.src_orders(spark, sf)
    return loads.batch_assign(source, source.where("order_id < 0"), "order_id", 1000).select("order_id", "batch_no")


@query
def batch_load(spark: SparkSession, sf: str) -> DataFrame:
    """Batches committed one by one into a table that already holds the low ids."""
    table, log = new_name("orders"), new_path(spark, "run_log")
    source = fx.src_orders(spark, sf)
    top = source.agg(F.call_function("div", F.max("order_id"), F.lit(2)).alias("half")).scalar()
    tables.save_table(source.where(F.col("order_id") <= top), table)
    jobs.new_run_log(spark, log)
    size = max(1, source.count() // 4)
    batches = stage(loads.batch_assign(source, spark.table(table), "order_id", size), "batches")
    jobs.load_batches(batches, table, "order_id", log, "orders", ORDERS_NOW)
    return spark.table(table)


@query
def batch_load_streamed(spark: SparkSession, sf: str) -> DataFrame:
    """The batches as a stream of files, which breaks off in its second batch and is started again."""
    path, mark, table = new_path(spark, "feed"), new_path(spark, "mark"), new_name("orders")
    source = fx.src_orders(spark, sf)
    source.repartitionByRange(4, "order_id").write.parquet(path)
    tables.save_segmented(source.limit(0), table)

    def load() -> None:
        found = streams.read_new_files(spark, path, source.schema, maxFilesPerTrigger=1)
        streams.stream_batches(found, table, mark)
    with tables.interrupted(after=3), suppress(StreamingQueryException):
        load()
    load()
    return tables.rows_of(spark, table)


@query
def upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A source that lacks some of the target's orders: those stay as they are."""
    return loads.upsert(fx.tgt_orders(spark, sf).withColumn("updated_at", F.lit(None).cast("timestamp_ntz")),
                        fx.src_orders(spark, sf).where("order_id % 15 <> 4"), ["order_id"], ORDER_COLUMNS, {"updated_at": ts(ORDERS_NOW)})


@query
def upsert_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """A batch of one year's orders into a table partitioned by year: other years are not touched."""
    table, layout = new_name("orders"), Layout(partition_by=("order_year",))

    def by_year(df: DataFrame) -> DataFrame:
        return df.withColumn("order_year", F.year("order_date"))
    tables.save_table(by_year(fx.tgt_orders(spark, sf)), table, layout)
    batch = by_year(fx.src_orders(spark, sf)).where("order_year = 1998")
    tables.upsert_table(batch, table, ["order_id"], ORDER_COLUMNS)
    return spark.table(table)


def _by_year(df: DataFrame) -> DataFrame:
    return df.withColumn("order_year", F.year("order_date"))


@query
def upsert_moved_key(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose date, and with it their partition, has changed by a year: each is in its new partition only."""
    table = new_name("orders")
    tables.save_table(_by_year(fx.tgt_orders(spark, sf)), table, Layout(partition_by=("order_year",)))
    moved = fx.src_orders(spark, sf).where("order_id % 15 = 4").withColumn("order_date", F.col("order_date") + interval("1 YEAR"))
    tables.upsert_table(_by_year(moved), table, ["order_id"], ORDER_COLUMNS)
    return spark.table(table)


@query
def upsert_after_failure(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog fails in the middle of a swap of partitions; the same upsert again gives what one clean run gives."""
    table = new_name("orders")
    tables.save_table(_by_year(fx.tgt_orders(spark, sf)), table, Layout(partition_by=("order_year",)))
    batch = _by_year(fx.src_orders(spark, sf).where("order_id % 15 <> 4"))
    with tables.interrupted(after=3), suppress(tables.Interrupted):
        tables.upsert_table(batch, table, ["order_id"], ORDER_COLUMNS)
    tables.upsert_table(batch, table, ["order_id"], ORDER_COLUMNS)
    return spark.table(table)


@query
def upsert_segments(spark: SparkSession, sf: str) -> DataFrame:
    """A table without partitions, in segments by date: a batch of one month's orders, old and new, rewrites few of them."""
    table = new_name("orders")
    tables.save_segmented(fx.tgt_orders(spark, sf), table, Layout(sort=("order_date",), files=12))
    batch = fx.src_orders(spark, sf).where("order_date >= TIMESTAMP_NTZ '1998-01-01' AND order_date < TIMESTAMP_NTZ '1998-02-01'")
    tables.upsert_table(batch, table, ["order_id"], ORDER_COLUMNS)
    return tables.rows_of(spark, table)


@query
def delete_segments(spark: SparkSession, sf: str) -> DataFrame:
    """A delete from a segmented table, and an append to it."""
    table = new_name("orders")
    tables.save_segmented(fx.tgt_orders(spark, sf), table, Layout(sort=("order_date",), files=8))
    tables.delete_from(spark, table, F.col("order_date") < ts("1994-01-01"))
    tables.append(fx.src_orders(spark, sf).where("order_date < TIMESTAMP_NTZ '1994-01-01' AND order_id % 10 = 0"), table)
    return tables.rows_of(spark, table)


@query
def upsert_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """A table in hash buckets, upserted without saying so."""
    table = new_name("orders")
    tables.save_table(fx.tgt_orders(spark, sf), table, Layout(dist="key", key="customer_id", buckets=5))
    tables.upsert_table(fx.src_orders(spark, sf).where("order_id % 15 <> 4"), table, ["order_id"], ORDER_COLUMNS)
    return spark.table(table)


@query
def delete_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """A delete that empties one partition and thins out the others."""
    table = new_name("orders")
    tables.save_table(_by_year(fx.src_orders(spark, sf)), table, Layout(partition_by=("order_year",)))
    tables.delete_from(spark, table, (F.col("order_year") == 1997) | (F.col("order_id") % 7 == 0))
    return spark.table(table)


@query
def compact_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """A partitioned table of many small files, compacted and clustered without naming its partitions."""
    table = new_name("orders")
    tables.save_table(_by_year(fx.src_orders(spark, sf)).repartition(16), table, Layout(partition_by=("order_year",)))
    upkeep.compact(spark, table, Layout(interleave=("customer_id", "total_amount")), F.col("status") == "P")
    return spark.table(table)


@query
def cdc_repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of orders as a feed with many versions per key: the newest counts."""
    lines = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag")
    known = reports.latest_version(lines.where("l_orderkey % 3 <> 0"), ["l_orderkey"], "l_linenumber", ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    return loads.classify_changes(lines, known, ["l_orderkey"], ["l_returnflag", "l_partkey"], ORDERS_NOW, version_col="l_shipdate",
                                  tiebreak=["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])


@query
def proc_by_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    table = _loaded_table(spark, sf, "order_date <= TIMESTAMP_NTZ '2001-01-01 00:00:00'")
    procedures.load_by_timestamp(fx.src_orders(spark, sf), table, "order_date", ORDERS_NOW)
    return spark.table(table)


@query
def proc_by_id(spark: SparkSession, sf: str) -> DataFrame:
    table = _loaded_table(spark, sf, "order_date < TIMESTAMP_NTZ '1995-01-03 00:00:00'")
    procedures.load_by_id(fx.src_orders(spark, sf), table, "order_id", ORDERS_NOW)
    return spark.table(table)


@query
def proc_delta(spark: SparkSession, sf: str) -> DataFrame:
    feed, table = fx.table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value"), new_name("events")
    tables.save_table(feed.where("event_id % 3 = 0").withColumn("loaded_at", F.lit(None).cast("timestamp_ntz")), table)
    procedures.load_delta(feed, table, ["user_id"], "ts", EVENTS_NOW, ["event_id"], window="24 HOURS")
    return spark.table(table)


@query
def proc_batches(spark: SparkSession, sf: str) -> DataFrame:
    table = _loaded_table(spark, sf, "order_id < 5")
    source = fx.src_orders(spark, sf)
    procedures.load_in_batches(source, table, "order_id", ORDERS_NOW, batch_size=max(1, source.count() // 3))
    return spark.table(table)


@query
def proc_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The table after the changes are applied; the staging table holds them."""
    source, target = _with_gone(spark, sf)
    table, staging = new_name("orders"), new_name("staging")
    tables.save_table(target.drop("created_at").withColumn("loaded_at", F.lit(None).cast("timestamp_ntz")), table)
    changes = _classified(spark, sf)
    tables.save_table(changes.limit(0), staging)
    procedures.load_changes(source, table, staging, ["order_id"], ["status", "total_amount"], ORDER_COLUMNS, ORDERS_NOW, detect_deletes=True)
    noted = spark.table(staging).groupBy("order_id").agg(F.max("operation_type").alias("noted"))
    return spark.table(table).join(noted, "order_id", "left")


@query
def daily_sales_load(spark: SparkSession, sf: str) -> DataFrame:
    """The logged daily load on a catalog table."""
    table, log, source = new_name("sales"), new_path(spark, "run_log"), new_path(spark, "sales")
    fx.sales(spark, sf).write.parquet(source)
    jobs.new_run_log(spark, log)
    old = fx.sales(spark, sf).where("sale_id % 2 = 0 AND sale_date < TIMESTAMP_NTZ '2001-07-20 00:00:00'").select(
        "sale_id", "customer_id", "product_id", (F.col("sale_amount") + 1).cast("decimal(10,2)").alias("sale_amount"), "sale_date", "region",
        "store_id", F.lit(None).cast("timestamp_ntz").alias("processed_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    tables.save_table(old, table)
    jobs.daily_sales_load(spark, source, table, ORDERS_NOW, log)
    return spark.table(table).drop("processed_at")


def _loaded_table(spark: SparkSession, sf: str, condition: str) -> str:
    table = new_name("orders")
    tables.save_table(fx.src_orders(spark, sf).where(condition).withColumn("loaded_at", F.lit(None).cast("timestamp_ntz")), table)
    return table


@query
def default_fill(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.tgt_orders(spark, sf).withColumn("loaded_at", F.when(F.col("order_id") % 3 != 0, F.col("order_date")))
    return loads.default_fill(rows, "loaded_at", ts(ORDERS_NOW))


@query
def delete_where(spark: SparkSession, sf: str) -> DataFrame:
    """Deletes low facts; rows of unknown status stay when deleting by status."""
    return loads.delete_where(fx.tgt_orders(spark, sf), F.col("status") == "X")


@query
def delete_from_table(spark: SparkSession, sf: str) -> DataFrame:
    table = new_name("facts")
    tables.save_table(fx.facts(spark, sf), table, Layout(sort=("timestamp", "category")))
    tables.delete_from(spark, table, F.col("metric_value") < 100, Layout(sort=("timestamp", "category")))
    return spark.table(table)


@query
def daily_transform(spark: SparkSession, sf: str) -> DataFrame:
    return loads.daily_transform(fx.sales(spark, sf), ORDERS_NOW)


@query
def load_history(spark: SparkSession, sf: str) -> DataFrame:
    return loads.load_history(fx.load_history(spark, sf), EVENTS_NOW)


# --- Upkeep ----------------------------------------------------------------------------------------------------------

def _upkeep_tables(spark: SparkSession, sf: str) -> dict:
    return {"sales": (fx.sales(spark, sf), ~F.col("is_active")),
            "facts": (fx.facts(spark, sf), F.col("metric_value") < 100),
            "orders": (fx.tgt_orders(spark, sf), F.col("status") == "X"),
            "lines": (fx.table(spark, sf, "lineitem"), F.col("l_quantity") < 3),
            "untouched": (fx.customers(spark, sf), F.lit(False))}


@query
def maintenance_needed(spark: SparkSession, sf: str) -> DataFrame:
    return keep.maintenance_candidates(_upkeep_tables(spark, sf))


@query
def maintenance_by_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return keep.maintenance_candidates(_upkeep_tables(spark, sf), ratio=0.1)


@query
def deleted_rows_report(spark: SparkSession, sf: str) -> DataFrame:
    return keep.deleted_rows_report(_upkeep_tables(spark, sf))


@query
def compact(spark: SparkSession, sf: str) -> DataFrame:
    """Many small files with deleted rows become few sorted ones without."""
    table = new_name("sales")
    tables.save_table(fx.sales(spark, sf), table, Layout(dist="even", files=24))
    upkeep.compact(spark, table, Layout(sort=("sale_date", "region")), ~F.col("is_active"))
    return spark.table(table)


@query
def selective_compact(spark: SparkSession, sf: str) -> DataFrame:
    """Report of a round of upkeep over three tables, one of which does not exist."""
    names = {}
    for name in ("sales", "facts"):
        rows, deleted = _upkeep_tables(spark, sf)[name]
        table = new_name(name)
        tables.save_table(rows, table)
        names[table] = deleted
    names[new_name("absent")] = F.lit(True)
    report = upkeep.selective_compact(spark, names, ratio=0.15)
    return report.select(F.substring_index("table_name", "_", 1).alias("table_name"), "deleted_before", "total_before",
                         "deleted_after", "total_after", "compacted", F.col("error").isNotNull().alias("failed"))


@query
def analyze_table(spark: SparkSession, sf: str) -> DataFrame:
    """Exact parts of the collected statistics."""
    table, columns = new_name("orders"), ["order_id", "total_amount", "status"]
    tables.save_table(fx.tgt_orders(spark, sf), table)
    keep.analyze_table(spark, table)
    keep.analyze_table(spark, table, columns, bins=16)
    return keep.column_statistics(spark, table, columns).select("column_name", "min_value", "max_value", "null_count")


PROFILED = ["sale_id", "product_id", "customer_id", "sale_amount", "sale_date", "region", "store_id", "category", "is_active"]


@query
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.sales(spark, sf)
    return profiles.column_profile(rows, PROFILED, ["sale_id"], 5).select(
        "column_name", "n_distinct", "null_fraction", "correlation",
        F.array_join("most_common_vals", ",").alias("most_common_vals"),
        F.round(F.aggregate("most_common_freqs", F.lit(0.0), lambda a, x: a + x), 4).alias("most_common_share"))


@query
def most_common_values(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.most_common_values(fx.sales(spark, sf), PROFILED, 10)


@query
def profile_after_append(spark: SparkSession, sf: str) -> DataFrame:
    """Profile from the counts of three loads, of which one is corrected later: only what was loaded or corrected is counted."""
    rows, folder = fx.sales(spark, sf), new_path(spark, "counts")
    for region, chosen in (("West", "region = 'West' AND store_id > 50"), ("East", "region = 'East'"),
                           ("Central", "region = 'Central'"), ("West", "region = 'West'")):
        parts.put(profiles.value_counts(rows.where(chosen), PROFILED), folder, region)
    counts = stage(profiles.added_counts(parts.kept(spark, folder, "column_name STRING, value STRING, value_count BIGINT")), "counts")
    return profiles.profile_of_counts(counts, 5).select(
        "column_name", "n_distinct", "null_fraction", F.array_join("most_common_vals", ",").alias("most_common_vals"),
        F.round(F.aggregate("most_common_freqs", F.lit(0.0), lambda a, x: a + x), 4).alias("most_common_share"))


@query
def approximate_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The sketches' figures next to the exact ones: distinct counts within three standard errors (15 %), common values with their exact shares."""
    rows = fx.sales(spark, sf)
    exact = profiles.column_profile(rows, PROFILED, None, 5).select("column_name", F.col("n_distinct").alias("n"), F.col("most_common_freqs").alias("f"))
    few = F.col("n") <= 100  # where the sketch holds every value
    return profiles.approximate_profile(rows, PROFILED, 5).join(exact, "column_name").select(
        "column_name", "null_fraction", (F.abs(F.col("n_distinct") - F.col("n")) <= 0.15 * F.col("n") + 1).alias("distinct_close"),
        (~few | (F.col("most_common_freqs")[0] == F.col("f")[0])).alias("top_share_close"))


@query
def encoding_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.encoding_profile(fx.sales(spark, sf), PROFILED, ["sale_id"])


@query
def key_skew(spark: SparkSession, sf: str) -> DataFrame:
    lines = fx.table(spark, sf, "lineitem")
    return keep.key_skew(lines, "l_partkey", 16, F.pmod("l_partkey", F.lit(16)))


@query
def zone_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Zones of a thousand sales that a month's filter opens, and whether the sorted files have the same ranges by their
    column and by their footers."""
    lo, hi = ts(MONTH[0]), ts(MONTH[1])
    zones = keep.zone_overlap(keep.zone_ranges(fx.sales(spark, sf), "sale_date", F.expr("sale_id div 1000")), lo, hi)
    read = keep.zone_ranges(layout_compound_sort(spark, sf), "sale_date").drop("file_path")
    footer = footers.column_ranges(spark, _sorted(spark, sf), "sale_date", "timestamp_ntz").select(*read.columns)
    differ = read.exceptAll(footer).unionByName(footer.exceptAll(read))
    return zones.crossJoin(differ.agg((F.count(F.lit(1)) == 0).alias("footers_agree")))


@query
def filter_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """Queries of some classes that are neither upkeep nor deletes."""
    chosen = filters.none_like(fx.query_log(spark, sf), "query", ["VACUUM%", "ANALYZE%", "DELETE%"])
    return filters.one_of(chosen, "service_class", ["view", "click", "purchase"]).select("query_id", "query", "service_class")


@query
def reencode_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table written again in other encodings and another codec: the same rows."""
    table = new_name("sales")
    tables.save_table(fx.sales(spark, sf), table, Layout(codec="snappy"))
    tables.reencode(spark, table, {"sale_id": "delta", "region": "dict", "category": "dict"}, "zstd")
    return spark.table(table)


@query
def maintain_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Upkeep of all tables of a database but those whose name is left out by a pattern."""
    database = new_name("upkeep")
    files.create_database(spark, database, new_path(spark, "upkeep"))
    deleted = {}
    for name in ("sales", "facts", "orders"):
        rows, deleted[name] = _upkeep_tables(spark, sf)[name]
        tables.save_table(rows, f"{database}.{name}")
    report = procedures.maintain_schema(spark, database, deleted, exclude=["ord%", "pg_%"], share=0.15)
    return report.select("table_name", "deleted_before", "total_before", "deleted_after", "total_after", "compacted")


@query
def load_query_log(spark: SparkSession, sf: str) -> DataFrame:
    """The query log of event-log lines rendered from the events: a start, an end, a job and a task of every query."""
    row, path = fx.table(spark, sf, "events"), new_path(spark, "eventlog")
    sql = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecution"
    at = F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000 + (
        F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")) * 1000
    number = F.col("event_id")
    lines = [
        F.struct(F.lit(sql + "Start").alias("Event"), number.alias("executionId"), F.col("event_type").alias("description"), at.alias("time")),
        F.struct(F.lit(sql + "End").alias("Event"), number.alias("executionId"), (at + number % 5000).alias("time")),
        F.struct(F.lit("SparkListenerJobStart").alias("Event"), number.alias("Job ID"), F.array(number).alias("Stage IDs"), F.struct(
            number.cast("string").alias("spark.sql.execution.id"), F.concat(F.lit("pool"), (number % 3).cast("string")).alias("spark.scheduler.pool")).alias("Properties")),
        F.struct(F.lit("SparkListenerTaskEnd").alias("Event"), number.alias("Stage ID"), F.struct(
            (number * 7 % 1000).alias("Peak Execution Memory"), (number % 3 * 1_500_000).alias("Disk Bytes Spilled"),
            F.struct((number * 17).alias("Bytes Read"), F.col("user_id").alias("Records Read")).alias("Input Metrics")).alias("Task Metrics"))]
    # A file is one application's log: all lines of a query lie in one.
    row.repartition("event_id").select(F.explode(F.array(*[F.to_json(x) for x in lines])).alias("value")).write.text(path)
    return eventlog.load_query_log(spark, path).drop("app")


# --- Query log -------------------------------------------------------------------------------------------------------

@query
def log_recent(spark: SparkSession, sf: str) -> DataFrame:
    return querylog.recent_queries(fx.query_log(spark, sf), EVENTS_NOW, "1 HOUR")


@query
def log_by_class(spark: SparkSession, sf: str) -> DataFrame:
    return querylog.class_report(fx.query_log(spark, sf), EVENTS_NOW, "24 HOURS")


@query
def log_heavy(spark: SparkSession, sf: str) -> DataFrame:
    return querylog.slow_queries(fx.query_log(spark, sf), EVENTS_NOW)


@query
def log_memory(spark: SparkSession, sf: str) -> DataFrame:
    return querylog.memory_heavy(fx.query_log(spark, sf), EVENTS_NOW)


@query
def log_hourly_p95(spark: SparkSession, sf: str) -> DataFrame:
    return querylog.class_percentile(fx.query_log(spark, sf), "hour", 0.95, EVENTS_NOW, "24 HOURS").withColumn(
        "p95_execution_time", F.round("p95_execution_time", 4))


@query
def log_daily_median(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log by day and class."""
    return querylog.class_percentile(fx.query_log(spark, sf), "day", 0.5, EVENTS_NOW, "60 DAYS").withColumn(
        "p50_execution_time", F.round("p50_execution_time", 4))


@query
def log_sketched(spark: SparkSession, sf: str) -> DataFrame:
    """The last day and the last week by class from hourly sketches of three loads, all of which reach into every hour, one of
    them loaded twice. Counts and extremes as they are, percentile and distinct count held against the log itself."""
    log, folder, group = fx.query_log(spark, sf), new_path(spark, "sketches"), ["service_class"]
    for load in (0, 1, 2, 1):
        late = log.where(F.col("query_id") % 3 == load)
        kept = sketches.period_sketches(late, "hour", "start_time", group, "total_time", "bytes")
        parts.put(kept, folder, f"load-{load}")
    kept, out = parts.kept(spark, folder, kept.schema), []
    for days, start in ((1, "2024-01-30 00:00:00"), (7, "2024-01-24 00:00:00")):
        report = sketches.span_report(kept, "hour", start, EVENTS_NOW, group, 0.95)
        rows = log.where((F.col("start_time") >= ts(start)) & (F.col("start_time") < ts(EVENTS_NOW)))
        exact = rows.join(report.select(*group, "percentile"), group).groupBy(*group).agg(
            F.count_if(F.col("total_time") < F.col("percentile")).alias("below"), F.count_if(F.col("total_time") <= F.col("percentile")).alias("upto"),
            F.count_distinct("bytes").alias("different"))
        out.append(report.join(exact, group).select(
            F.lit(days).alias("days"), *group, "row_count", "average", "least", "most",
            sketches.rank_is_near(F.col("below"), F.col("upto"), F.col("row_count"), 0.95).alias("percentile_near"),
            (F.abs(F.col("distinct") - F.col("different")) <= 1 + 4 * sketches.DISTINCT_ERROR * F.col("different")).alias("distinct_near")))
    return out[0].unionByName(out[1])


@query
def log_table_access(spark: SparkSession, sf: str) -> DataFrame:
    return querylog.recent_queries(fx.query_log(spark, sf), EVENTS_NOW, "1 HOUR", "%ext_sales%")


@query
def log_text_search(spark: SparkSession, sf: str) -> DataFrame:
    """Queries on a table, from a log in files of which only those are opened that may hold the table's name."""
    log, path = fx.query_log(spark, sf), new_path(spark, "log")
    write_files(log, path, Layout(sort=("query",), files=max(8, files_of(log))))
    grams.note_grams(spark, path, "query")
    return grams.search_text(spark, path, "query", "%ext_sales%")


@query
def log_maintenance(spark: SparkSession, sf: str) -> DataFrame:
    return querylog.maintenance_statements(fx.query_log(spark, sf), EVENTS_NOW, "24 HOURS")


@query
def log_maintenance_strict(spark: SparkSession, sf: str) -> DataFrame:
    return querylog.maintenance_statements(fx.query_log(spark, sf), EVENTS_NOW, "24 HOURS", strict=True)


@query
def log_table_history(spark: SparkSession, sf: str) -> DataFrame:
    return querylog.recent_queries(fx.query_log(spark, sf), EVENTS_NOW, "48 HOURS", "%sales_with_deletes%").select(
        "query", "service_class", "start_time", "total_time", "rows", "bytes")


# --- Jobs ------------------------------------------------------------------------------------------------------------

@query
def daily_sales_job(spark: SparkSession, sf: str) -> DataFrame:
    target = fx.warehouse_sales(spark, sf)
    return jobs.daily_sales_job(spark, _sales_parquet(spark, sf), target, ORDERS_NOW)


@query
def load_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Rows counted while they are appended."""
    table = new_name("orders")
    tables.save_table(_loaded(spark, sf, "2001-01-01 00:00:00"), table)
    return jobs.load_with_metrics(inc_by_timestamp(spark, sf), table, ORDERS_NOW).select(
        F.substring_index("target", "_", 1).alias("target"), "records_loaded", "load_time")


@query
def sql_transform(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.sql_transform(
        spark, "SELECT region, count(*) AS row_count, CAST(sum(sale_amount) AS DECIMAL(20,2)) AS sale_amount "
               "FROM {sales} WHERE is_active = :active GROUP BY region", {"active": True}, sales=fx.sales(spark, sf))


@query
def fn_transform(spark: SparkSession, sf: str) -> DataFrame:
    def above(df: DataFrame, floor: int) -> DataFrame:
        return df.where(F.col("sale_amount") > floor).select("sale_id", "sale_amount")
    return jobs.fn_transform(fx.sales(spark, sf), above, floor=100_000)


@query
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.run_summary(fx.run_log(spark, sf))


@query
def run_details(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.run_details(fx.run_log(spark, sf))


# --- Streams ---------------------------------------------------------------------------------------------------------

@query
def stream_append(spark: SparkSession, sf: str) -> DataFrame:
    """Orders appended as a stream, in two runs on one checkpoint."""
    source, target, mark = new_path(spark, "incoming"), new_path(spark, "appended"), new_path(spark, "mark")
    orders = fx.src_orders(spark, sf)
    for half in (0, 1):
        orders.where(F.col("order_id") % 2 == half).write.mode("append").parquet(source)
        streams.stream_append(streams.read_new_files(spark, source, orders.schema), target, mark)
    return spark.read.schema(orders.schema).parquet(target)


def _in_files(rows: DataFrame, n: int) -> str:
    """A folder of about ``n`` files, or more for large data, whose order is not that of time."""
    path = new_path(rows.sparkSession, "incoming")
    rows.repartition(max(n, pieces_of(rows)), F.xxhash64(*rows.columns)).write.parquet(path)
    return path


@query
def stream_latest_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Newest event per user and hour of day, from a stream of all events onto a table of early ones; times are cut to the
    day, so many versions tie."""
    feed = fx.table(spark, sf, "events").select("user_id", F.hour("ts").alias("hour"), trunc_ts("day", F.col("ts")).alias("ts"),
                                                "event_id", "event_type", "value")
    table, keys = new_name("latest"), ["user_id", "hour"]
    early = feed.where("ts < TIMESTAMP_NTZ '2024-01-10 00:00:00'")
    tables.save_table(reports.latest_version(early, keys, "ts", ["event_id"]), table)
    rows = streams.read_new_files(spark, _in_files(feed, 4), feed.schema, maxFilesPerTrigger="1")
    streams.stream_latest_upsert(rows, table, keys, "ts", ["event_id"], ["event_id", "event_type", "value"], new_path(spark, "mark"))
    return spark.table(table)


@query
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """A stream that carries every event twice, and every fifth once more an hour later, which is kept."""
    feed = fx.table(spark, sf, "events").select("event_id", "ts", "event_type", F.lit(0).alias("copy"))
    later = feed.where("event_id % 5 = 0").withColumn("ts", F.col("ts") + interval("1 HOUR"))
    every = feed.unionByName(feed.withColumn("copy", F.lit(1))).unionByName(later)
    table = new_name("once")
    tables.save_table(feed.drop("copy").limit(0), table)
    rows = streams.read_new_files(spark, _in_files(every, 4), every.schema, maxFilesPerTrigger="1")
    streams.stream_dedup(rows.drop("copy"), table, ["event_id"], "ts", new_path(spark, "mark"))
    return spark.table(table)
