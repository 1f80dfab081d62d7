"""Every query of the package over the given tables, by name.

Each callable takes a session and the folder of the tables and returns a DataFrame over all of
their rows. Queries that write do so in a fresh folder below the cluster's shared one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shoreline.functions import cleaning
from shoreline.functions.timestamps import bound
from shoreline.operators import cdc, contracts, federate, profile, quality, query, reports, star
from shoreline.operators.counts import Counts
from shoreline.operators.dedup import duplicate_counts, keep_latest
from shoreline.plans import adapters, pipeline
from shoreline.session import input_bytes, shared_folder
from shoreline.sources import changes, landing, share, tables
from shoreline.streaming import sinks
from shoreline.streaming.mirror import Mirror, freshness
from shoreline.streaming.views import AggregateView

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SALE_KEY = ["product_id", "user_id"]
SALE_ORDER = ["rating_count", "review_id"]
TEXT_NORMALIZERS = {
    "actual_price": cleaning.strip_currency,
    "rating": cleaning.comma_to_point,
    "rating_count": cleaning.drop_thousands,
}
SINCE = "2024-01-15 00:00:00"
NOW = "2024-01-15 12:00:00"
# A captured stream has this many files at least, and one for so many bytes of the events behind it: as
# envelopes these are some 35 times as many. It is read in as many batches however many files there are.
STREAM_FILES = 4
STREAM_FILE_BYTES = 8 << 20
# What makes an event's change newer, as the state's SQL orders them: a delete gets no precedence of its own.
CHANGE_ORDER = ("ts_ms", "event_timestamp", "event_type", "page_url", "utm_source")


def _comparable(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, last of all, so that results compare by value anywhere."""
    exact = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in exact}) if exact else df


def registered(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _comparable(function(spark, sf_dir.rstrip("/")))

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return run


def fresh_namespace(spark: SparkSession, purpose: str) -> str:
    namespace = f"{purpose}_{uuid.uuid4().hex[:8]}"
    tables.ensure_namespace(spark, namespace, shared_folder(spark, namespace))
    return namespace


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.orders(adapters.table(spark, sf_dir, "orders"))


def _event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.event_orders(adapters.table(spark, sf_dir, "events"))


_made: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[], str]) -> str:
    """Where something written once per session from the given tables is kept."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def landed_sales(spark: SparkSession, sf_dir: str) -> str:
    """Raw sales files, read the way a capture service's files would be."""

    def make() -> str:
        folder = shared_folder(spark, "captured")
        return landing.land(adapters.sales_raw(spark, sf_dir), folder, "public", "sales")

    return _once(spark, sf_dir, "sales", make)


def _stream_files(events: DataFrame) -> int:
    return max(STREAM_FILES, tables.buckets_for(input_bytes(events), STREAM_FILE_BYTES))


def landed_changes(spark: SparkSession, sf_dir: str) -> str:
    """Captured change files of the events."""

    def make() -> str:
        events = adapters.table(spark, sf_dir, "events")
        changed = adapters.envelope(events.repartition(_stream_files(events)))
        return landing.land(changed, shared_folder(spark, "captured"), "public", "web_events")

    return _once(spark, sf_dir, "web_events", make)


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.read_landing(spark, landed_sales(spark, sf_dir))


def _envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.read_landing(spark, landed_changes(spark, sf_dir))


def _envelope_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landed_changes(spark, sf_dir)
    files = _stream_files(adapters.table(spark, sf_dir, "events"))
    return changes.read_file_stream(spark, path, cdc.ENVELOPE, max_files_per_trigger=-(-files // 2))


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a folder of files that is read a few files at a time."""
    events = adapters.table(spark, sf_dir, "events")
    files = _stream_files(events)

    def make() -> str:
        path = shared_folder(spark, "events")
        events.repartition(files).write.parquet(path)
        return path

    path = _once(spark, sf_dir, "events", make)
    return changes.read_file_stream(spark, path, events.schema, max_files_per_trigger=-(-files // 2))


# Hourly revenue -------------------------------------------------------------------------------


@registered
def hourly_revenue(spark, sf_dir):
    return reports.hourly_revenue(_event_orders(spark, sf_dir))


@registered
def hourly_revenue_since(spark, sf_dir):
    return reports.hourly_revenue(_event_orders(spark, sf_dir), since=SINCE)


@registered
def hourly_revenue_by_day(spark, sf_dir):
    """The same from a copy stored by day, reading only the folders from that day on."""
    path = f"{shared_folder(spark, 'by_day')}/vendas"
    landing.write_by_day(_event_orders(spark, sf_dir), path, "pedido_em")
    return reports.hourly_revenue(landing.read_landing(spark, path), SINCE, "dia")


@registered
def hourly_revenue_newest(spark, sf_dir):
    return reports.newest_hours(reports.hourly_revenue(_event_orders(spark, sf_dir)))


# Contracts and staging ------------------------------------------------------------------------


def _text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.sales_text(_sales(spark, sf_dir))


@registered
def contract_conform(spark, sf_dir):
    return contracts.conform(_text(spark, sf_dir), contracts.SALES)


@registered
def contract_normalized(spark, sf_dir):
    return contracts.conform(_text(spark, sf_dir), contracts.SALES, TEXT_NORMALIZERS)


@registered
def contract_lost_values(spark, sf_dir):
    return contracts.lost_values(_text(spark, sf_dir), contracts.SALES)


@registered
def stg_dedup(spark, sf_dir):
    raw = contracts.conform(_sales(spark, sf_dir), contracts.SALES)
    return keep_latest(raw, ["product_id"], SALE_ORDER)


@registered
def stg_duplicates(spark, sf_dir):
    return duplicate_counts(_sales(spark, sf_dir), SALE_KEY)


@registered
def stg_upsert(spark, sf_dir):
    """Orders first, then events under the same contract: some keys replaced, some added."""
    name = f"{fresh_namespace(spark, 'stg')}.vendas"
    tables.upsert(spark, _orders(spark, sf_dir), name, ["order_id"])
    tables.upsert(spark, _event_orders(spark, sf_dir), name, ["order_id"])
    return tables.read_table(spark, name)


@registered
def stg_upsert_repeated_target(spark, sf_dir):
    """Line items per order as the target, whose key repeats; every match is updated."""
    lines = adapters.table(spark, sf_dir, "lineitem")
    named = lines.select(F.col("l_orderkey").alias("order_id"), F.col("l_quantity").alias("valor"))
    name = f"{fresh_namespace(spark, 'stg')}.linhas"
    tables.overwrite_table(spark, named, name)
    events = adapters.table(spark, sf_dir, "events")
    source = events.select(F.col("event_id").alias("order_id"), F.col("value").alias("valor"))
    tables.upsert(spark, source, name, ["order_id"])
    return tables.read_table(spark, name)


# Star schema ----------------------------------------------------------------------------------

def stored_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema's tables, built once per session; as in the job graph, later jobs and the
    dashboards read stored tables."""

    def build() -> str:
        namespace = fresh_namespace(spark, "star")
        raw = landed_sales(spark, sf_dir)
        pipeline.run_star_schema(spark, raw, namespace, SALE_KEY, SALE_ORDER)
        return namespace

    namespace = _once(spark, sf_dir, "star", build)
    names = [pipeline.STAGING, *quality.DIMENSION_RULES, *quality.FACT_RULES]
    return {n: tables.read_table(spark, f"{namespace}.{n}") for n in names}


@registered
def stg_sales(spark, sf_dir):
    return stored_star(spark, sf_dir)["stg_sales"]


@registered
def dim_product(spark, sf_dir):
    return star.dim_product(stored_star(spark, sf_dir)["stg_sales"])


@registered
def dim_user(spark, sf_dir):
    return star.dim_user(stored_star(spark, sf_dir)["stg_sales"])


@registered
def dim_rating(spark, sf_dir):
    return star.dim_rating(stored_star(spark, sf_dir)["stg_sales"])


@registered
def fact_product_rating(spark, sf_dir):
    t = stored_star(spark, sf_dir)
    fact = star.fact_product_rating(t["stg_sales"], t["dim_product"], t["dim_rating"])
    return fact.withColumn("avg_rating", F.round("avg_rating", 6))


@registered
def fact_sales_category(spark, sf_dir):
    t = stored_star(spark, sf_dir)
    return star.fact_sales_category(t["stg_sales"], t["dim_product"], t["dim_user"])


@registered
def pipeline_star(spark, sf_dir):
    """The whole job graph with its gates; how many rows each table got."""
    namespace = fresh_namespace(spark, "pipeline")
    made = pipeline.run_star_schema(
        spark, landed_sales(spark, sf_dir), namespace, ["product_id"], SALE_ORDER
    )
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in made.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@registered
def pipeline_star_sales(spark, sf_dir):
    """The last table of the whole job graph, staged by product."""
    namespace = fresh_namespace(spark, "pipeline")
    made = pipeline.run_star_schema(
        spark, landed_sales(spark, sf_dir), namespace, ["product_id"], SALE_ORDER
    )
    return made["fact_sales_category"]


@registered
def pipeline_rows(spark, sf_dir):
    """The rows that came into and out of the job graph's steps, counted while they were written."""
    counts = Counts()
    pipeline.run_star_schema(
        spark, landed_sales(spark, sf_dir), fresh_namespace(spark, "pipeline"), ["product_id"], SALE_ORDER, counts=counts
    )
    return counts.report(spark)


@registered
def pipeline_gated(spark, sf_dir):
    """What readers see after good rows were published and a later run was blocked by its gate."""
    namespace = fresh_namespace(spark, "pipeline")
    run = lambda raw: pipeline.run_star_schema(
        spark, raw, namespace, ["product_id"], SALE_ORDER, publish="after_gate"
    )
    good = _sales(spark, sf_dir)
    run(good)
    user = F.when(F.crc32(F.col("product_id").cast("binary")) % 3 > 0, F.col("user_id"))
    try:
        run(good.withColumn("user_id", user))
        blocked = False
    except quality.QualityGateError:
        blocked = True
    seen = [
        tables.read_table(spark, f"{namespace}.{name}")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count", F.lit(blocked).alias("blocked"))
        for name in [*quality.DIMENSION_RULES, *quality.FACT_RULES]
    ]
    return reduce(DataFrame.unionByName, seen)


# Dashboards -----------------------------------------------------------------------------------


@registered
def dash_rating_by_category(spark, sf_dir):
    t = stored_star(spark, sf_dir)
    top = reports.rating_by_category(t["fact_product_rating"], t["dim_product"])
    return top.withColumn("avg_rating", F.round("avg_rating", 6))


@registered
def dash_sales_rating(spark, sf_dir):
    t = stored_star(spark, sf_dir)
    return reports.sales_rating_by_category(
        t["dim_product"], t["dim_rating"], t["fact_sales_category"]
    )


@registered
def dash_rating_by_product(spark, sf_dir):
    t = stored_star(spark, sf_dir)
    listing = reports.rating_by_product(t["fact_product_rating"], t["dim_product"])
    return listing.withColumn("avg_rating", F.round("avg_rating", 6))


@registered
def dash_category_listing(spark, sf_dir):
    t = stored_star(spark, sf_dir)
    return reports.category_sales_listing(t["fact_sales_category"], t["dim_product"])


@registered
def dash_category_top(spark, sf_dir):
    t = stored_star(spark, sf_dir)
    return reports.category_sales_listing(
        t["fact_sales_category"], t["dim_product"], true_top_n=True
    )


@registered
def dash_total_sales(spark, sf_dir):
    return reports.total_sales(stored_star(spark, sf_dir)["fact_sales_category"])


@registered
def dash_sales_count(spark, sf_dir):
    return reports.sales_count(stored_star(spark, sf_dir)["fact_sales_category"])


# Quality --------------------------------------------------------------------------------------


@registered
def dq_report(spark, sf_dir):
    t = stored_star(spark, sf_dir)
    rules = {**quality.DIMENSION_RULES, **quality.FACT_RULES}
    result = quality.report({name: t[name] for name in rules}, rules)
    return result.withColumn("observed", F.round("observed", 6))


@registered
def dq_gate_failures(spark, sf_dir):
    """What a gate says that stops a job: the rules that failed and what they saw."""
    t = stored_star(spark, sf_dir)
    some_gone = F.when(~F.col("user_id").endswith("7"), F.col("user_id"))
    given = {**t, "dim_user": t["dim_user"].withColumn("user_id", some_gone)}
    rules = {**quality.DIMENSION_RULES, **quality.FACT_RULES}
    try:
        quality.gate({name: given[name] for name in rules}, rules)
        failures = []
    except quality.QualityGateError as error:
        failures = [tuple(r) for r in error.failures]
    columns = "table_name string, rule string, column_name string, observed double, passed boolean"
    return spark.createDataFrame(failures, columns)


@registered
def dq_sketched_unique(spark, sf_dir):
    """Uniqueness over a table that grows by days, each profiled once."""
    path = f"{shared_folder(spark, 'by_day')}/vendas"
    landing.write_by_day(_event_orders(spark, sf_dir), path, "pedido_em")
    days = landing.read_landing(spark, path)
    profiles, columns = shared_folder(spark, "profiles"), ["order_id", "customer_id", "status"]
    profile.update(spark, days.where(F.col("dia") < SINCE[:10]), profiles, columns, "dia")
    known = profile.update(spark, days, profiles, columns, "dia")
    return profile.unique_proportion(known).select("column_name", "row_count", "non_null", "passed")


# Change capture -------------------------------------------------------------------------------


@registered
def cdc_flatten(spark, sf_dir):
    return cdc.flatten_envelope(_envelope(spark, sf_dir))


@registered
def cdc_pii_drop(spark, sf_dir):
    return cdc.drop_columns(cdc.flatten_envelope(_envelope(spark, sf_dir)))


@registered
def cdc_insert_view(spark, sf_dir):
    return cdc.project_after(_envelope(spark, sf_dir))


@registered
def cdc_latest_by_version(spark, sf_dir):
    return cdc.latest_by_version(cdc.project_after(_envelope(spark, sf_dir)), ["event_id"])


@registered
def cdc_state_from_log(spark, sf_dir):
    log = cdc.drop_columns(cdc.flatten_envelope(_envelope(spark, sf_dir)))
    return cdc.state_from_log(log, ["event_id"], CHANGE_ORDER)


@registered
def cdc_stream_log(spark, sf_dir):
    """The event log written by a stream with a checkpoint, read back."""
    folder = shared_folder(spark, "log")
    log = cdc.drop_columns(cdc.flatten_envelope(_envelope_stream(spark, sf_dir)))
    sinks.append_log(
        log, f"{folder}/checkpoint", f"{folder}/log", trigger={"availableNow": True}
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/log")


@registered
def cdc_stream_state(spark, sf_dir):
    """The newest row per key kept by a stream that leaves deletes out."""
    stream = cdc.project_after(_envelope_stream(spark, sf_dir))
    name = f"{fresh_namespace(spark, 'state')}.web_events"
    state = Mirror(spark, name, stream.schema, ["event_id"], ["_ts_ms"], "_op", deletes="ignore")
    checkpoint = shared_folder(spark, "state_checkpoint")
    state.stream(stream, checkpoint, {"availableNow": True}).awaitTermination()
    return state.read()


def _offset_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The life of each key within one millisecond; only the offset tells its changes apart."""
    events = adapters.table(spark, sf_dir, "events")
    return cdc.flatten_envelope(
        adapters.envelope(events, F.col("event_id")).withColumns(
            {"ts_ms": F.lit(0).cast("bigint"), "partition": F.lit(0)}
        )
    ).select("event_id", "event_type", "op", "ts_ms", "offset")


@registered
def cdc_equal_versions(spark, sf_dir):
    """Newest change per key when nothing but the offset tells the changes apart."""
    return cdc.state_from_log(_offset_changes(spark, sf_dir), ["event_id"])


@registered
def cdc_frame_strip(spark, sf_dir):
    """Registry-framed messages without their frame."""
    events = adapters.table(spark, sf_dir, "events")
    body = F.col("event_type").cast("binary")
    framed = events.select("event_id", F.concat(F.unhex(F.lit("0000000007")), body).alias("value"))
    return framed.select("event_id", cdc.strip_confluent_header(F.col("value")).cast("string").alias("body"))


@registered
def cdc_two_consumers(spark, sf_dir):
    """Two queries with their own checkpoints both get every change: keys and how many copies."""
    folder = shared_folder(spark, "consumers")
    for i in range(2):
        log = cdc.flatten_envelope(_envelope_stream(spark, sf_dir)).select("event_id", "op", "ts_ms")
        sinks.append_log(
            log, f"{folder}/checkpoint{i}", f"{folder}/log{i}", trigger={"availableNow": True}
        ).awaitTermination()
    both = [spark.read.parquet(f"{folder}/log{i}").withColumn("consumer", F.lit(i)) for i in range(2)]
    return both[0].unionByName(both[1])


@registered
def cdc_log_replayed(spark, sf_dir):
    """A log of messages that were all delivered twice, in other batches, and are logged once."""
    folder = shared_folder(spark, "replayed")
    events = adapters.table(spark, sf_dir, "events")
    files = _stream_files(events)
    dealt = adapters.envelope(events.repartition(files), F.col("event_id"))
    sent = dealt.withColumn("partition", (F.col("offset") % 3).cast("int"))
    for _ in range(2):
        sent.write.mode("append").parquet(f"{folder}/messages")
    stream = changes.read_file_stream(spark, f"{folder}/messages", sent.schema, max_files_per_trigger=-(-3 * files // 4))
    arrived = stream.withColumn("arrived", F.col("_metadata.file_modification_time"))
    once = sinks.once(arrived, cdc.ARRIVAL, "arrived").drop("arrived")
    log = cdc.drop_columns(cdc.flatten_envelope(once)).drop(*cdc.ARRIVAL)
    sinks.append_log(
        log, f"{folder}/checkpoint", f"{folder}/log", trigger={"availableNow": True}
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/log")


@registered
def cdc_stream_until_stopped(spark, sf_dir):
    """A log written without a trigger: the query waits for more until it is stopped."""
    folder = shared_folder(spark, "log")
    log = cdc.drop_columns(cdc.flatten_envelope(_envelope_stream(spark, sf_dir)))
    running = sinks.append_log(log, f"{folder}/checkpoint", f"{folder}/log")
    running.processAllAvailable()
    was_active = running.isActive
    running.stop()
    return spark.read.parquet(f"{folder}/log").withColumn("was_active", F.lit(was_active))


# Materialized view ----------------------------------------------------------------------------


def revenue_view(spark: SparkSession, name: str, source: DataFrame) -> AggregateView:
    keys = {"hora": F.date_trunc("hour", "pedido_em")}
    return AggregateView(spark, name, source.schema, keys, {"receita": "valor"})


@registered
def mv_incremental(spark, sf_dir):
    """Two loads of events and a replay of the second."""
    rows = _event_orders(spark, sf_dir)
    view = revenue_view(spark, f"{fresh_namespace(spark, 'mv')}.receita_por_hora", rows)
    early = F.col("pedido_em") < bound(rows, "pedido_em", F.lit(SINCE))
    view.apply_delta(rows.filter(early), 0)
    view.apply_delta(rows.filter(~early), 1)
    view.apply_delta(rows.filter(~early), 1)
    return view.read()


@registered
def mv_state_merge(spark, sf_dir):
    """Partial states per hour and event type, merged per hour."""
    rows = _event_orders(spark, sf_dir)
    view = revenue_view(spark, f"{fresh_namespace(spark, 'mv')}.receita_por_hora", rows)
    partial = rows.select("pedido_em", "valor", "status")
    states = partial.groupBy(F.date_trunc("hour", "pedido_em").alias("hora"), "status").agg(
        F.count(F.lit(1)).alias("pedidos"),
        F.sum("valor").cast("decimal(38,2)").alias("receita"),
        F.count("valor").alias("receita__values"),
    )
    view.add(view.merged(states), "0")
    return view.read()


@registered
def mv_stream(spark, sf_dir):
    source = adapters.event_orders(_event_stream(spark, sf_dir))
    namespace = fresh_namespace(spark, "mv")
    view = revenue_view(spark, f"{namespace}.receita_por_hora", source)
    view.refresh(source, shared_folder(spark, "mv_checkpoint"))
    return view.read()


@registered
def mv_out_of_order(spark, sf_dir):
    """Loads 0, 5, then 2, 1, 3, 4 and 5 again: none is lost or counted twice."""
    rows = _event_orders(spark, sf_dir)
    view = revenue_view(spark, f"{fresh_namespace(spark, 'mv')}.receita_por_hora", rows)
    part = F.col("order_id") % 6
    for load in (0, 5, 2, 1, 3, 4, 5):
        view.apply_delta(rows.filter(part == load), load)
    return view.read()


@registered
def mv_signed_changes(spark, sf_dir):
    """Changes per country kept from envelopes in three loads, updates and deletes included."""
    images = cdc.signed_images(_envelope(spark, sf_dir)).select(
        "geo_country", "sign", F.col("click_id").cast("decimal(12,2)").alias("valor"), "event_type"
    )
    name = f"{fresh_namespace(spark, 'mv')}.por_pais"
    keys = {"geo_country": F.col("geo_country")}
    view = AggregateView(
        spark, name, images.schema, keys, {"receita": "valor"}, count="eventos", sign="sign"
    )
    removed = F.col("sign") < 0
    view.apply_delta(images.filter(~removed), 0)
    view.apply_delta(images.filter(removed & (F.col("event_type") == "was click")), 1)
    view.apply_delta(images.filter(removed & (F.col("event_type") != "was click")), 2)
    return view.read()


@registered
def mv_refresh_history(spark, sf_dir):
    source = adapters.event_orders(_event_stream(spark, sf_dir))
    namespace = fresh_namespace(spark, "mv")
    view = revenue_view(spark, f"{namespace}.receita_por_hora", source)
    checkpoint = shared_folder(spark, "mv_checkpoint")
    view.refresh(source, checkpoint)
    view.reset()
    again = shared_folder(spark, "mv_checkpoint")
    view.auto_refresh(source, again, {"availableNow": True}).awaitTermination()
    ended = (F.col("endtime") >= F.col("starttime")).alias("ended")
    return view.refresh_history().select("status", "refresh_type", ended).distinct()


# Replication ----------------------------------------------------------------------------------


def _flat_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.drop_columns(cdc.flatten_envelope(_envelope(spark, sf_dir)))


def _mirror(spark: SparkSession, schema, deletes: str = "apply", version=CHANGE_ORDER) -> Mirror:
    name = f"{fresh_namespace(spark, 'mirror')}.web_events"
    return Mirror(spark, name, schema, ["event_id"], version, deletes=deletes)


def _mirrored(spark: SparkSession, sf_dir: str, deletes: str = "apply") -> Mirror:
    """All changes in two batches: updates and deletes first, creates arriving late."""
    rows = _flat_changes(spark, sf_dir)
    mirror = _mirror(spark, rows.schema, deletes)
    mirror.apply(rows.filter("op <> 'c'"))
    mirror.apply(rows.filter("op = 'c'"))
    return mirror


@registered
def replica_mirror(spark, sf_dir):
    return _mirrored(spark, sf_dir).read()


@registered
def replica_mirror_keep_deleted(spark, sf_dir):
    return _mirrored(spark, sf_dir, deletes="ignore").read()


@registered
def replica_mirror_stream(spark, sf_dir):
    stream = cdc.drop_columns(cdc.flatten_envelope(_envelope_stream(spark, sf_dir)))
    mirror = _mirror(spark, stream.schema)
    checkpoint = shared_folder(spark, "mirror_checkpoint")
    mirror.stream(stream, checkpoint, {"availableNow": True}).awaitTermination()
    return mirror.read()


@registered
def replica_equal_versions(spark, sf_dir):
    """The same as a mirror that gets the later changes first."""
    rows = _offset_changes(spark, sf_dir)
    mirror = _mirror(spark, rows.schema, version=["ts_ms"])
    early = F.col("offset") % 4 < 2
    mirror.apply(rows.filter(~early))
    mirror.apply(rows.filter(early))
    return mirror.read()


def _copy_and_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A full copy of orders, and the events as later changes of the same table."""
    copy = cdc.snapshot_as_changes(_orders(spark, sf_dir), 0)
    later = _event_orders(spark, sf_dir).withColumns(
        {
            "op": F.when(F.col("status") == "error", "d").otherwise("u"),
            "ts_ms": F.unix_millis(F.col("pedido_em").cast("timestamp")),
        }
    )
    return copy, later


@registered
def replica_snapshot(spark, sf_dir):
    copy, later = _copy_and_changes(spark, sf_dir)
    return cdc.state_from_log(copy.unionByName(later), ["order_id"])


@registered
def replica_initial_load(spark, sf_dir):
    """The same kept as a mirror, which is loaded with the copy before the changes."""
    copy, later = _copy_and_changes(spark, sf_dir)
    name = f"{fresh_namespace(spark, 'mirror')}.vendas"
    mirror = Mirror(spark, name, copy.schema, ["order_id"])
    mirror.load(copy)
    mirror.apply(later)
    return mirror.read()


COPY_CHUNK = 500


@registered
def replica_chunked_copy(spark, sf_dir):
    """Orders copied in chunks while events change them, and the log of these changes.

    Each row is read at some moment between its chunk's low mark and twice a chunk later, so some
    changes are in the copy already, some reach it late, and all are in the log.
    """
    copy, _ = _copy_and_changes(spark, sf_dir)
    columns = [c for c in copy.columns if c not in ("op", "ts_ms")]
    log = adapters.order_changes(adapters.table(spark, sf_dir, "events"))
    low = F.expr(f"order_id div {COPY_CHUNK}") * (4 * COPY_CHUNK) + COPY_CHUNK
    read_at = low + F.pmod(F.xxhash64("order_id"), F.lit(2 * COPY_CHUNK))
    before = cdc.chunk_as_changes(copy.select(*columns), -1)
    seen = cdc.state_from_log(before.unionByName(log.where(F.col("offset") <= read_at)), ["order_id"], ("offset",))
    copied = cdc.chunk_as_changes(seen.select(*columns), low)
    return cdc.state_from_copy(copied, log, ["order_id"]).select(*columns)


@registered
def replica_full_load(spark, sf_dir):
    """Selected tables landed as gzip Parquet and read back; rows per table."""
    folder = shared_folder(spark, "landing")
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    landed = landing.full_load(
        lambda name: adapters.table(spark, sf_dir, name.rpartition(".")[2]),
        [f"source.public.{n}" for n in names],
        folder,
        includes=["source.public.*"],
        excludes=["source.public.n%"],
    )
    counts = [
        landing.read_landing(spark, path)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, path in landed.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@registered
def replica_full_load_orders(spark, sf_dir):
    """One of the landed tables, row by row."""
    landed = landing.full_load(
        lambda name: adapters.table(spark, sf_dir, "orders"), ["source.public.orders"], shared_folder(spark, "landing")
    )
    return landing.read_landing(spark, landed["source.public.orders"])


@registered
def freshness_lag(spark, sf_dir):
    source = _event_orders(spark, sf_dir)
    errors_removed = source.withColumn("op", F.when(F.col("status") == "error", "d"))
    destination = errors_removed.filter(~F.col("op").eqNullSafe("d"))
    return freshness(source, destination, "pedido_em")


# Federation, sharing, ad-hoc SQL --------------------------------------------------------------

LOOKUP_COLUMNS = ["order_id", "status", "updated_at", "pedidos_ultimos_90d", "chargebacks"]


@registered
def federated_lookup(spark, sf_dir):
    order = adapters.table(spark, sf_dir, "orders")
    return federate.lookup(
        adapters.live_orders(order),
        adapters.customer_history(order),
        F.col("order_id") == 902,
        columns=LOOKUP_COLUMNS,
    )


@registered
def federated_lookup_indexed(spark, sf_dir):
    """The lookup over history whose row groups carry Bloom filters of the key."""
    order = adapters.table(spark, sf_dir, "orders")
    path = shared_folder(spark, "history")
    landing.write_for_lookup(adapters.customer_history(order), path, {"customer_id": 1_000_000})
    return federate.lookup(
        adapters.live_orders(order),
        landing.read_landing(spark, path),
        F.col("order_id") == 902,
        columns=LOOKUP_COLUMNS,
    )


@registered
def federated_history(spark, sf_dir):
    live = adapters.live_events(adapters.table(spark, sf_dir, "events"))
    history = adapters.customer_history(adapters.table(spark, sf_dir, "orders"))
    return federate.with_history(live, history).select(*LOOKUP_COLUMNS)


@registered
def federated_recent(spark, sf_dir):
    live = adapters.live_events(adapters.table(spark, sf_dir, "events"))
    now = F.lit(NOW).cast("timestamp")
    return federate.recent(live, now=now).select("order_id", "status", "updated_at")


@registered
def share_proof(spark, sf_dir):
    """Rows written by the producer after sharing are seen by the consumer."""
    producer = fresh_namespace(spark, "producer")
    consumer = fresh_namespace(spark, "consumer")
    tables.overwrite_table(spark, _orders(spark, sf_dir), f"{producer}.vendas")
    share.publish(spark, producer, consumer)
    tables.upsert(spark, _event_orders(spark, sf_dir), f"{producer}.vendas", ["order_id"])
    shared = tables.read_table(spark, f"{consumer}.vendas")
    return shared.agg(
        F.count(F.lit(1)).alias("pedidos"), F.max("pedido_em").alias("ultimo_pedido")
    )


@registered
def share_revoked(spark, sf_dir):
    """Of two shared tables the one taken back is gone at once, the other one stays."""
    producer, consumer = fresh_namespace(spark, "producer"), fresh_namespace(spark, "consumer")
    tables.overwrite_table(spark, _orders(spark, sf_dir), f"{producer}.vendas")
    tables.overwrite_table(spark, _event_orders(spark, sf_dir), f"{producer}.eventos")
    share.publish(spark, producer, consumer)
    share.revoke(spark, consumer, ["vendas"])
    seen = []
    for name in ("vendas", "eventos"):
        visible = tables.table_exists(spark, f"{consumer}.{name}")
        rows = tables.read_table(spark, f"{consumer}.{name}") if visible else spark.range(0)
        count = F.count(F.lit(1)) if visible else F.lit(None).cast("bigint")
        seen.append(rows.agg(count.alias("row_count")).select(F.lit(name).alias("table_name"), F.lit(visible).alias("visible"), "row_count"))
    return reduce(DataFrame.unionByName, seen)


@registered
def bounded_query_outcomes(spark, sf_dir):
    """What becomes of statements that are answered, cut, refused, wrong or too slow."""
    view = f"bounded_orders_{uuid.uuid4().hex[:8]}"
    adapters.table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    statements = {
        "whole": f"SELECT o_orderstatus, COUNT(*) AS n FROM {view} GROUP BY o_orderstatus",
        "cut": f"SELECT * FROM {view}",
        "no such column": f"SELECT no_such_column FROM {view}",
        "drop": f"DROP VIEW {view}",
        "computed path": f"SELECT * FROM IDENTIFIER('parquet.`' || '{sf_dir}/orders.parquet`')",
        "reflection": f"SELECT reflect('java.lang.Math', 'abs', o_orderkey) FROM {view}",
        "too slow": f"SELECT SUM(sqrt(id % 7)) FROM range(1000000000000) WHERE id NOT IN (SELECT o_orderkey FROM {view})",
    }
    outcomes = []
    for name, sql in statements.items():
        try:
            got = query.bounded_query(spark, sql, max_rows=5 if name == "cut" else 1000, seconds=2 if name == "too slow" else 600)
            outcomes.append((name, "rows", got.row_count, got.truncated))
        except (query.QueryInputError, query.QueryFailed) as error:
            outcomes.append((name, type(error).__name__, None, None))
    return spark.createDataFrame(outcomes, "name string, outcome string, row_count bigint, truncated boolean")


@registered
def bounded_query(spark, sf_dir):
    view = f"bounded_orders_{uuid.uuid4().hex[:8]}"
    adapters.table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    return query.capped(
        spark,
        f"""
        WITH per_customer AS (
          SELECT o_custkey, COUNT(*) AS pedidos, MAX(o_orderdate) AS ultimo
          FROM {view} GROUP BY o_custkey)
        SELECT o_custkey, pedidos, ultimo FROM per_customer ORDER BY pedidos DESC, o_custkey
        """,
        max_rows=100,
    )


# Table writes ---------------------------------------------------------------------------------


@registered
def table_overwrite(spark, sf_dir):
    """The second full refresh replaces the first."""
    name = f"{fresh_namespace(spark, 'tables')}.vendas"
    tables.overwrite_table(spark, _orders(spark, sf_dir), name)
    tables.overwrite_table(spark, _event_orders(spark, sf_dir), name)
    return tables.read_table(spark, name)


@registered
def table_schema_guard(spark, sf_dir):
    """What the guard says to rows of another shape, and that the table keeps its rows."""
    name, orders = f"{fresh_namespace(spark, 'tables')}.vendas", _orders(spark, sf_dir)
    tables.overwrite_table(spark, orders, name)
    first, second, *rest = orders.columns
    others = [orders.drop("valor"), orders.withColumn("extra", F.lit(1)), orders.select(second, first, *rest)]
    faults = []
    for other in others:
        try:
            tables.overwrite_table(spark, other, name)
        except tables.SchemaMismatchError as error:
            faults.append(F.lit(str(error).partition(": ")[2]))
    stored = tables.read_table(spark, name).agg(F.count(F.lit(1)).alias("row_count"))
    return stored.select(F.explode(F.array(*faults)).alias("fault"), "row_count")


@registered
def table_bulk_load(spark, sf_dir):
    namespace = fresh_namespace(spark, "tables")
    folder = shared_folder(spark, "seed")
    landing.write_parquet(contracts.conform(_orders(spark, sf_dir), contracts.ORDERS), folder)
    tables.ensure_table(spark, f"{namespace}.vendas", contracts.ORDERS)
    tables.bulk_load(spark, folder, f"{namespace}.vendas")
    return tables.read_table(spark, f"{namespace}.vendas")


@registered
def land_gzip(spark, sf_dir):
    path = landing.land(
        _event_orders(spark, sf_dir), shared_folder(spark, "landing"), "public", "vendas"
    )
    return landing.read_landing(spark, path)
