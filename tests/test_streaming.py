import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from shoreline.operators import cdc
from shoreline.sources import changes
from shoreline.streaming import sinks
from shoreline.streaming.mirror import Mirror, freshness
from shoreline.streaming.views import AggregateView

NOW = {"availableNow": True}
LOG = "k string, v int, op string, ts_ms bigint"
SALES = "order_id bigint, pedido_em timestamp, valor decimal(12,2)"


def sales(spark, *data):
    made = [(i, t, v) for i, t, v in data]
    return spark.createDataFrame(made, "order_id bigint, t string, v string").select(
        "order_id",
        F.concat(F.lit("2026-03-01 "), "t").cast("timestamp").alias("pedido_em"),
        F.col("v").cast("decimal(12,2)").alias("valor"),
    )


def add_file(df, folder):
    df.coalesce(1).write.mode("append").parquet(str(folder))


@pytest.fixture
def source(spark, tmp_path):
    folder = tmp_path / "in"
    add_file(spark.createDataFrame([("a", 1, "c", 1), ("b", 1, "c", 2)], LOG), folder)
    schema = spark.createDataFrame([], LOG).schema
    return folder, lambda: changes.read_file_stream(spark, str(folder), schema)


def test_log_resumes_from_its_checkpoint(spark, source, tmp_path):
    folder, stream = source
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/ck"
    run = lambda: sinks.append_log(stream(), checkpoint, out, trigger=NOW).awaitTermination()
    run()
    run()
    assert spark.read.parquet(out).count() == 2
    add_file(spark.createDataFrame([("a", 2, "u", 3)], LOG), folder)
    run()
    assert rows(spark.read.parquet(out)) == [("a", 1, "c", 1), ("a", 2, "u", 3), ("b", 1, "c", 2)]


def test_a_new_checkpoint_starts_over_and_consumers_are_independent(spark, source, tmp_path):
    _, stream = source
    first = sinks.append_log(stream(), f"{tmp_path}/ck1", f"{tmp_path}/out1", trigger=NOW)
    second = sinks.append_log(stream(), f"{tmp_path}/ck2", f"{tmp_path}/out2", trigger=NOW)
    first.awaitTermination()
    second.awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out1")) == rows(spark.read.parquet(f"{tmp_path}/out2"))


def test_a_query_without_trigger_runs_until_stopped(source, tmp_path):
    _, stream = source
    query = sinks.append_log(stream(), f"{tmp_path}/ck", f"{tmp_path}/out")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert not query.isActive


def test_a_single_file_can_be_streamed(spark, source, tmp_path):
    folder, _ = source
    file = next(folder.glob("*.parquet"))
    stream = changes.read_file_stream(spark, str(file), spark.createDataFrame([], LOG).schema)
    sinks.append_log(stream, f"{tmp_path}/ck", f"{tmp_path}/out", trigger=NOW).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


# Mirror ---------------------------------------------------------------------------------------


def random_history(seed):
    """Changes of some keys with unique versions, and the state they lead to."""
    rng = random.Random(seed)
    state, log = {}, []
    for ts in range(1, 301):
        key = f"k{rng.randrange(25)}"
        op = "d" if key in state and rng.random() < 0.3 else ("u" if key in state else "c")
        value = rng.randrange(100)
        log.append((key, value, op, ts))
        if op == "d":
            del state[key]
        else:
            state[key] = (key, value, op, ts)
    return log, sorted(state.values())


@pytest.mark.parametrize("seed, parts", [(1, 0), (2, 4), (3, 4)])
def test_mirror_equals_the_source_for_any_split_and_order(spark, namespace, seed, parts):
    log, state = random_history(seed)
    random.Random(seed).shuffle(log)
    schema = spark.createDataFrame([], LOG).schema
    mirror = Mirror(spark, f"{namespace}.m", schema, ["k"], parts=parts)
    assert mirror.read().count() == 0
    cuts = sorted(random.Random(seed).sample(range(len(log)), 3))
    split = [log[a:b] for a, b in zip([0, *cuts], [*cuts, len(log)])]
    for part in [*split, split[1]]:  # the last one is a replay
        mirror.apply(spark.createDataFrame(part, LOG))
    assert rows(mirror.read()) == sorted(state, key=str)


def test_rows_without_a_key_are_not_kept(spark, namespace):
    mirror = Mirror(spark, f"{namespace}.m", spark.createDataFrame([], LOG).schema, ["k"])
    mirror.apply(spark.createDataFrame([("a", 1, "c", 1), (None, 1, "c", 1)], LOG))
    assert rows(mirror.read()) == [("a", 1, "c", 1)]


def test_equal_versions_are_settled_by_arrival_or_for_the_delete(spark, namespace):
    fields = "k string, v string, op string, ts_ms bigint, offset bigint"
    changes_ = [("a", "zeta", "u", 1, 1), ("a", "alpha", "u", 1, 2), ("b", "x", "u", 1, 3), ("b", "x", "d", 1, 4), ("c", "x", "d", 1, 5), ("c", "y", "c", 1, 6)]
    log = spark.createDataFrame(changes_, fields)
    assert [(r.k, r.v) for r in cdc.state_from_log(log, ["k"]).orderBy("k").collect()] == [("a", "alpha"), ("c", "y")]
    mirror = Mirror(spark, f"{namespace}.m", log.schema, ["k"])
    for rows_ in (changes_[1::2], changes_[::2]):
        mirror.apply(spark.createDataFrame(rows_, fields))
    assert [(r.k, r.v) for r in mirror.read().orderBy("k").collect()] == [("a", "alpha"), ("c", "y")]
    bare = spark.createDataFrame([("b", 9, "u", 1), ("b", 1, "d", 1)], LOG)
    assert cdc.state_from_log(bare, ["k"]).count() == 0
    late = Mirror(spark, f"{namespace}.n", bare.schema, ["k"])
    late.apply(bare.where("op = 'u'"))
    late.apply(bare.where("op = 'd'"))
    assert late.read().count() == 0


def test_a_late_update_does_not_bring_a_deleted_row_back(spark, namespace):
    schema = spark.createDataFrame([], LOG).schema
    mirror = Mirror(spark, f"{namespace}.m", schema, ["k"])
    mirror.apply(spark.createDataFrame([("a", 1, "d", 9)], LOG))
    mirror.apply(spark.createDataFrame([("a", 1, "u", 5)], LOG))
    assert mirror.read().count() == 0


def test_ignoring_deletes_keeps_the_last_row(spark, namespace):
    schema = spark.createDataFrame([], LOG).schema
    mirror = Mirror(spark, f"{namespace}.m", schema, ["k"], deletes="ignore")
    mirror.apply(spark.createDataFrame([("a", 1, "c", 1), ("a", 1, "d", 9)], LOG))
    assert rows(mirror.read()) == [("a", 1, "c", 1)]
    with pytest.raises(ValueError):
        Mirror(spark, f"{namespace}.n", schema, ["k"], deletes="maybe")


def test_streamed_mirror_follows_the_source_across_restarts(spark, namespace, source, tmp_path):
    """What each key's newest change was is kept by the state store, deletes included."""
    folder, stream = source
    schema = spark.createDataFrame([], LOG).schema
    mirror = Mirror(spark, f"{namespace}.m", schema, ["k"], parts=4)
    run = lambda checkpoint: mirror.stream(stream(), f"{tmp_path}/{checkpoint}", NOW).awaitTermination()
    run("ck")
    add_file(spark.createDataFrame([("a", 5, "u", 7), ("b", 1, "d", 8)], LOG), folder)
    run("ck")
    assert rows(mirror.read()) == [("a", 5, "u", 7)]
    add_file(spark.createDataFrame([("b", 4, "u", 6), ("a", 4, "u", 6), ("c", 1, "c", 9)], LOG), folder)
    run("ck")
    assert rows(mirror.read()) == [("a", 5, "u", 7), ("c", 1, "c", 9)]
    run("another")  # reads all of the source again
    assert rows(mirror.read()) == [("a", 5, "u", 7), ("c", 1, "c", 9)]
    assert rows(mirror.stored()) == [("a", 5, "u", 7), ("b", 1, "d", 8), ("c", 1, "c", 9)]


def test_state_is_kept_in_rocksdb_and_only_there(spark, namespace, source, tmp_path):
    _, stream = source
    mirror = Mirror(spark, f"{namespace}.m", spark.createDataFrame([], LOG).schema, ["k"])
    provider = lambda: spark.conf.get(sinks.STATE_STORE)
    before = provider()
    query = mirror.stream(stream(), f"{tmp_path}/ck", NOW)
    query.awaitTermination()
    assert provider() == before
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == 2 and any(k.startswith("rocksdb") for k in state["customMetrics"])


def test_a_stream_puts_out_changed_keys_only(spark, source, tmp_path):
    folder, stream = source
    mirror = Mirror(spark, "ns.unused", spark.createDataFrame([], LOG).schema, ["k"])
    seen = []
    run = lambda: sinks.each_batch(
        mirror.newest(stream()), lambda batch: seen.append(rows(batch)), f"{tmp_path}/ck", NOW
    ).awaitTermination()
    run()
    add_file(spark.createDataFrame([("a", 0, "u", 0)], LOG), folder)  # older than what is known
    run()
    assert seen == [[("a", 1, "c", 1), ("b", 1, "c", 2)], [("a", 1, "c", 1)]]


MESSAGES = "part int, pos bigint, v string, arrived timestamp"


def test_messages_delivered_again_are_logged_once(spark, tmp_path):
    at = lambda *data: spark.createDataFrame(data, "part int, pos bigint, v string, t string").selectExpr(
        "part", "pos", "v", "timestamp('2026-03-01 ' || t) AS arrived"
    )
    folder = tmp_path / "in"
    add_file(at((0, 1, "a", "10:00"), (1, 1, "b", "10:01"), (0, 1, "a", "10:02")), folder)

    def run():
        stream = changes.read_file_stream(spark, str(folder), spark.createDataFrame([], MESSAGES).schema)
        log = sinks.once(stream, ["part", "pos"], "arrived", "30 minutes")
        sinks.append_log(log, f"{tmp_path}/ck", f"{tmp_path}/out", trigger=NOW).awaitTermination()
        return [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("part", "pos", "v").orderBy("part", "pos").collect()]

    assert run() == [(0, 1, "a"), (1, 1, "b")]
    # the whole batch again after a restart, with a new message
    add_file(at((0, 1, "a", "10:10"), (1, 1, "b", "10:11"), (0, 2, "c", "10:12")), folder)
    assert run() == [(0, 1, "a"), (0, 2, "c"), (1, 1, "b")]


def test_the_log_and_the_mirror_agree(spark, namespace):
    log, state = random_history(9)
    frame = spark.createDataFrame(log, LOG)
    assert rows(cdc.state_from_log(frame, ["k"])) == sorted(state, key=str)


def test_freshness(spark):
    at = lambda *times: spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("ts"))
    source = at("2026-03-01 10:00:00", "2026-03-01 10:00:05.5")
    assert rows(freshness(source, at("2026-03-01 10:00:00"), "ts")) == [(2, 1, 5_500_000)]
    assert rows(freshness(source, source.limit(0), "ts")) == [(2, 0, None)]


# Materialized view ----------------------------------------------------------------------------


def revenue(spark, name, sign=None, schema=SALES):
    keys = {"hora": F.date_trunc("hour", "pedido_em")}
    return AggregateView(spark, name, spark.createDataFrame([], schema).schema, keys, {"receita": "valor"}, sign=sign)


def hours(view):
    return [(str(r.hora)[11:13], r.pedidos, r.receita) for r in view.read().orderBy("hora").collect()]


def test_view_follows_inserts(spark, namespace):
    view = revenue(spark, f"{namespace}.v")
    assert hours(view) == []
    view.apply_delta(sales(spark, (1, "10:05", "100"), (2, "10:40", "150"), (3, "11:10", "80")), 0)
    assert hours(view) == [("10", 2, Decimal(250)), ("11", 1, Decimal(80))]
    view.apply_delta(sales(spark, (4, "10:59", "100")), 1)
    assert hours(view)[0] == ("10", 3, Decimal(350))
    assert view.read().dtypes == [("hora", "timestamp"), ("pedidos", "bigint"), ("receita", "decimal(38,2)")]


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_equals_recomputed_for_any_split(spark, namespace, seed):
    rng = random.Random(seed)
    data = [
        (i, f"{rng.randrange(24):02d}:{rng.randrange(60):02d}", rng.choice([None, f"{rng.randrange(9999) / 100:.2f}"]))
        for i in range(200)
    ]
    view = revenue(spark, f"{namespace}.v")
    cuts = sorted(rng.sample(range(200), 3))
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, 200])):
        part = sales(spark, *data[a:b]) if b > a else spark.createDataFrame([], SALES)
        view.apply_delta(part, i)
        if rng.random() < 0.5:
            view.apply_delta(part, i)
    whole = sales(spark, *data).groupBy(F.date_trunc("hour", "pedido_em").alias("hora")).agg(
        F.count("*").alias("pedidos"), F.sum("valor").cast("decimal(38,2)").alias("receita")
    )
    assert rows(view.read()) == rows(whole)


def test_signed_changes_update_and_remove_groups(spark, namespace):
    view = revenue(spark, f"{namespace}.v", sign="sign", schema=f"{SALES}, sign int")
    signed = lambda sign, *data: sales(spark, *data).withColumn("sign", F.lit(sign))
    view.apply_delta(signed(1, (1, "10:00", "5"), (2, "11:00", "7"), (3, "11:30", None)), 0)
    view.apply_delta(signed(-1, (1, "10:00", "5"), (2, "11:00", "7")), 1)
    assert hours(view) == [("11", 1, None)]
    view.apply_delta(signed(1, (2, "11:00", "9")), 2)
    assert hours(view) == [("11", 2, Decimal(9))]


def test_doubles_cannot_be_summed_incrementally(spark, namespace):
    with pytest.raises(ValueError, match="exact"):
        revenue(spark, f"{namespace}.v", schema="pedido_em timestamp, valor double")


def test_a_view_is_read_without_shuffle(spark, namespace):
    view = revenue(spark, f"{namespace}.v")
    for i in range(2):
        view.apply_delta(sales(spark, (i, "10:05", "100")), i)
    assert "Exchange" not in plan(view.read()) and hours(view) == [("10", 2, Decimal(200))]


def test_groups_without_a_key_are_kept(spark, namespace):
    view = revenue(spark, f"{namespace}.v")
    for i in range(2):
        view.apply_delta(sales(spark, (1, "10:05", "1")).withColumn("pedido_em", F.lit(None).cast("timestamp")), i)
    assert [tuple(r) for r in view.read().collect()] == [(None, 2, Decimal(2))]


def test_a_load_replaces_what_it_brought_before(spark, namespace):
    view = revenue(spark, f"{namespace}.v")
    view.apply_delta(sales(spark, (1, "10:05", "100"), (2, "11:00", "1")), "monday")
    view.apply_delta(sales(spark, (3, "10:06", "5")), "tuesday")
    view.apply_delta(sales(spark, (1, "10:05", "70"), (2, "11:00", "1")), "monday")
    assert hours(view) == [("10", 2, Decimal(75)), ("11", 1, Decimal(1))]


@pytest.fixture
def sales_folder(spark, tmp_path):
    folder = tmp_path / "sales"
    add_file(sales(spark, (1, "10:05", "100")), folder)
    schema = spark.createDataFrame([], SALES).schema
    return folder, lambda: changes.read_file_stream(spark, str(folder), schema)


def test_manual_refresh_takes_in_only_what_is_new(spark, namespace, sales_folder, tmp_path):
    folder, stream = sales_folder
    view = revenue(spark, f"{namespace}.v")
    view.refresh(stream(), f"{tmp_path}/ck")
    add_file(sales(spark, (2, "10:06", "1")), folder)
    assert hours(view) == [("10", 1, Decimal(100))]
    view.refresh(stream(), f"{tmp_path}/ck")
    view.refresh(stream(), f"{tmp_path}/ck")
    assert hours(view) == [("10", 2, Decimal(101))]


def test_refresh_history_is_newest_first_and_capped(spark, namespace, sales_folder, tmp_path):
    folder, stream = sales_folder
    view = revenue(spark, f"{namespace}.v")
    assert view.refresh_history().count() == 0
    view.refresh(stream(), f"{tmp_path}/ck")
    add_file(sales(spark, (2, "10:06", "1")), folder)
    view.auto_refresh(stream(), f"{tmp_path}/ck", NOW).awaitTermination()
    found = view.refresh_history().collect()
    assert [(r.mv_name, r.status, r.refresh_type) for r in found] == [
        (f"{namespace}.v", "Success", "Auto"),
        (f"{namespace}.v", "Success", "Manual"),
    ]
    assert found[0].starttime >= found[1].starttime and found[0].endtime >= found[0].starttime
    assert view.refresh_history(newest=1).count() == 1
    assert revenue(spark, f"{namespace}.other").refresh_history().count() == 0


def test_a_failed_refresh_is_recorded(spark, namespace, sales_folder, tmp_path):
    _, stream = sales_folder
    view = revenue(spark, f"{namespace}.v")
    broken = stream().withColumn("valor", F.raise_error(F.lit("boom")).cast("decimal(12,2)"))
    with pytest.raises(Exception, match="boom"):
        view.refresh(broken, f"{tmp_path}/ck")
    assert [r.status for r in view.refresh_history().collect()] == ["Failed"]


def test_row_level_formats_are_left_alone(spark):
    schema = spark.createDataFrame([], LOG).schema
    with pytest.raises(ValueError, match="row-level"):
        Mirror(spark, "lake.ns.m", schema, ["k"])


@pytest.mark.parametrize("parts", [0, 4])
def test_mirror_starts_from_a_full_copy(spark, namespace, parts):
    copy = cdc.snapshot_as_changes(spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, v int"), 10)
    mirror = Mirror(spark, f"{namespace}.m", copy.schema, ["k"], parts=parts)
    mirror.load(copy)
    assert rows(mirror.read()) == [("a", 1, "r", 10), ("b", 1, "r", 10)]
    mirror.apply(spark.createDataFrame([("a", 0, "u", 9), ("b", 1, "d", 11), ("c", 1, "c", 12)], LOG))
    assert rows(mirror.read()) == [("a", 1, "r", 10), ("c", 1, "c", 12)]
    with pytest.raises(ValueError, match="already holds"):
        mirror.load(copy)


@pytest.mark.parametrize("seed", [4, 5])
def test_view_over_envelopes_follows_updates_and_deletes(spark, namespace, seed):
    log, state = random_history(seed)
    held, changes_ = {}, []
    for key, value, op, ts in log:
        after = None if op == "d" else (key, value)
        changes_.append((held.get(key), after, op, ts))
        held[key] = after
    envelope = "before struct<k: string, v: int>, after struct<k: string, v: int>, op string, ts_ms bigint"
    group = {"bucket": F.col("v") % 5}
    images = cdc.signed_images(spark.createDataFrame(changes_, envelope))
    view = AggregateView(spark, f"{namespace}.v", images.schema, group, {"total": "v"}, "n", "sign")
    for i in range(3):
        part = spark.createDataFrame(changes_[i * 100 : (i + 1) * 100], envelope)
        view.apply_delta(cdc.signed_images(part), i)
    want = {}
    for _, value, _, _ in state:
        n, total = want.get(value % 5, (0, 0))
        want[value % 5] = (n + 1, total + value)
    assert {r.bucket: (r.n, r.total) for r in view.read().collect()} == want


def test_a_new_checkpoint_needs_a_reset(spark, namespace, sales_folder, tmp_path):
    folder, stream = sales_folder
    view = revenue(spark, f"{namespace}.v")
    view.refresh(stream(), f"{tmp_path}/ck1")
    add_file(sales(spark, (2, "10:06", "1")), folder)
    with pytest.raises(ValueError, match="another checkpoint"):
        view.refresh(stream(), f"{tmp_path}/ck2")
    assert view.refresh_history(1).first().status == "Failed"
    view.refresh(stream(), f"{tmp_path}/ck1")
    before = hours(view)
    view.reset()
    assert hours(view) == []
    view.refresh(stream(), f"{tmp_path}/ck2")
    assert hours(view) == before == [("10", 2, Decimal(101))]
