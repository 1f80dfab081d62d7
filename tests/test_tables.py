import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from shoreline.operators import cdc
from shoreline.sources import landing, share, tables

SCHEMA = "id bigint, part string, v int"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_overwrite_replaces_and_readers_of_the_name_see_it(spark, namespace):
    name = f"{namespace}.t"
    first = tables.overwrite_table(spark, frame(spark, [(1, "a", 1)]), name)
    assert rows(tables.read_table(spark, name)) == [(1, "a", 1)]
    second = tables.overwrite_table(spark, frame(spark, [(2, "b", 2)]), name)
    assert first != second == tables.stored_table(spark, name)
    assert rows(tables.read_table(spark, name)) == [(2, "b", 2)]


def test_overwrite_may_read_the_table_it_replaces(spark, namespace):
    name = f"{namespace}.t"
    tables.overwrite_table(spark, frame(spark, [(1, "a", 1)]), name)
    tables.overwrite_table(spark, tables.read_table(spark, name).withColumn("v", F.col("v") + 1), name)
    assert rows(tables.read_table(spark, name)) == [(1, "a", 2)]


def stored(spark, namespace):
    return [t.tableName for t in spark.sql(f"SHOW TABLES IN {namespace}").collect() if tables.is_internal(t.tableName)]


def test_the_table_before_stays_for_its_readers(spark, namespace):
    name = f"{namespace}.t"
    tables.overwrite_table(spark, frame(spark, [(0, "a", 0)]), name)
    for i in range(1, 4):
        held = tables.read_table(spark, name)
        tables.overwrite_table(spark, frame(spark, [(i, "a", i)]), name)
        assert rows(held) == [(i - 1, "a", i - 1)] and len(stored(spark, namespace)) == 2
    assert rows(tables.read_table(spark, name)) == [(3, "a", 3)]


def test_several_names_switch_together_or_not_at_all(spark, namespace, monkeypatch):
    names = [f"{namespace}.{t}" for t in "abc"]
    for name in names[:2]:
        tables.overwrite_table(spark, frame(spark, [(1, "old", 1)]), name)
    write = lambda: {n: tables.overwrite_table(spark, frame(spark, [(2, "new", 2)]), n, published=False) for n in names}
    seen = lambda: [rows(spark.table(n))[0][1] for n in names if spark.catalog.tableExists(n)]
    made = write()
    assert seen() == ["old", "old"]
    point = tables._point

    def fails(spark, name, physical):
        if name == names[2] and physical is not None:
            raise RuntimeError("catalog is gone")
        return point(spark, name, physical)

    monkeypatch.setattr(tables, "_point", fails)
    with pytest.raises(RuntimeError, match="catalog is gone"):
        tables.publish(spark, made)
    assert seen() == ["old", "old"]
    monkeypatch.undo()
    tables.publish(spark, made)
    assert seen() == ["new"] * 3
    again = write()
    tables.discard(spark, again)
    assert seen() == ["new"] * 3 and not any(spark.catalog.tableExists(t) for t in again.values())


def test_stored_types_are_kept(spark, namespace):
    name = f"{namespace}.t"
    tables.upsert(spark, frame(spark, [(1, "a", 1)]), name, ["id"])
    stored = tables.read_table(spark, name).schema
    tables.upsert(spark, frame(spark, [(2, "b", 7)], "id int, part string, v bigint"), name, ["id"])
    tables.overwrite_table(spark, frame(spark, [("3", "c", "8")], "id string, part string, v string"), name)
    assert tables.read_table(spark, name).schema == stored and rows(tables.read_table(spark, name)) == [(3, "c", 8)]
    for lossy, kind in [(("4", "d", "x"), "string"), ((4, "d", 1 << 40), "bigint"), ((4, "d", 1.5), "double")]:
        data = frame(spark, [lossy], f"id {'string' if kind == 'string' else 'bigint'}, part string, v {kind}")
        with pytest.raises(Exception, match="cannot hold"):
            tables.upsert(spark, data, name, ["id"])
    assert rows(tables.read_table(spark, name)) == [(3, "c", 8)]


def part_files(spark, name):
    return set(spark.table(name).inputFiles())


def test_an_upsert_of_few_keys_leaves_other_partitions_alone(spark, namespace):
    name = f"{namespace}.t"
    tables.upsert(spark, frame(spark, [(i, "a", i) for i in range(200)]), name, ["id"], parts=16)
    before, table = part_files(spark, name), tables.stored_table(spark, name)
    tables.upsert(spark, frame(spark, [(5, "new", 50), (999, "new", 1)]), name, ["id"])
    after = part_files(spark, name)
    assert 14 <= len(before & after) < len(before) and tables.stored_table(spark, name) == table
    assert rows(tables.read_table(spark, name).where("part = 'new'")) == [(5, "new", 50), (999, "new", 1)]
    assert tables.read_table(spark, name).count() == 201
    tables.upsert(spark, frame(spark, []), name, ["id"])
    assert part_files(spark, name) == after
    tables.drop_table(spark, name)
    assert stored(spark, namespace) == []


def test_a_grown_table_gets_more_partitions(spark, namespace, monkeypatch):
    """By its files' bytes, so that a table begun with a few rows is not rewritten whole for ever."""
    monkeypatch.setattr(tables, "PART_BYTES", 20_000)
    monkeypatch.setattr(tables.buckets_for, "__defaults__", (20_000,))
    name, count = f"{namespace}.t", lambda: len({f.rpartition("/")[0] for f in part_files(spark, name)})
    grown = lambda a, b: spark.range(a, b).selectExpr("id", "sha2(string(id), 256) AS part", "int(id) AS v")
    tables.upsert(spark, grown(0, 50), name, ["id"])
    assert count() == 1
    for a in range(0, 8000, 2000):
        tables.upsert(spark, grown(a, a + 2000), name, ["id"])
    many = count()
    assert many > 8
    tables.upsert(spark, grown(8000, 8001), name, ["id"])
    assert tables.read_table(spark, name).count() == 8001 and count() >= many


@pytest.mark.parametrize("ready", [True, False])
def test_an_upsert_that_died_is_finished_or_forgotten(spark, namespace, monkeypatch, ready):
    """Once its rows are staged the next write completes it; before that it has not happened."""
    name = f"{namespace}.t"
    tables.upsert(spark, frame(spark, [(i, "a", i) for i in range(40)]), name, ["id"], parts=4)
    finish, calls = tables.finish, []

    def dies(spark, name):
        calls.append(name)
        if len(calls) == 2:
            if not ready:
                fs, marker = tables.file_system(spark, f"{tables._staged(spark, tables.stored_table(spark, name))}/ready")
                fs.delete(marker, False)
            raise RuntimeError("died")
        finish(spark, name)

    monkeypatch.setattr(tables, "finish", dies)
    with pytest.raises(RuntimeError, match="died"):
        tables.upsert(spark, frame(spark, [(3, "new", 3), (99, "new", 9)]), name, ["id"])
    monkeypatch.undo()
    assert tables.read_table(spark, name).where("part = 'new'").count() == 0
    tables.upsert(spark, frame(spark, [(7, "late", 7)]), name, ["id"])
    want = [(7, "late", 7)] + ([(3, "new", 3), (99, "new", 9)] if ready else [])
    assert rows(tables.read_table(spark, name).where("part <> 'a'")) == sorted(want)
    assert tables.read_table(spark, name).count() == 40 + ready


def test_the_sources_plan_runs_once(spark, namespace):
    name, seen = f"{namespace}.t", spark.sparkContext.accumulator(0)
    tables.upsert(spark, frame(spark, [(i, "a", i) for i in range(40)]), name, ["id"], parts=4)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    source = spark.range(20, 60, numPartitions=2).selectExpr("id", "'b' AS part", "int(id) AS v").mapInPandas(counted, SCHEMA)
    tables.upsert(spark, source, name, ["id"])
    assert seen.value == 40 and tables.read_table(spark, name).count() == 60


def test_parts_follow_the_bytes():
    assert [tables.buckets_for(n) for n in (0, 1, 256 << 20, (256 << 20) + 1, 1 << 40)] == [1, 1, 1, 2, 4096]


def test_a_failed_write_leaves_the_old_rows(spark, namespace):
    name = f"{namespace}.t"
    tables.overwrite_table(spark, frame(spark, [(1, "a", 1)]), name)
    broken = frame(spark, [(2, "b", 2)]).withColumn("v", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        tables.overwrite_table(spark, broken, name)
    assert rows(tables.read_table(spark, name)) == [(1, "a", 1)]
    tables.overwrite_table(spark, frame(spark, [(3, "c", 3)]), name)
    assert rows(tables.read_table(spark, name)) == [(3, "c", 3)]


def test_schema_guard_names_both_sides(spark, namespace):
    name = f"{namespace}.t"
    tables.ensure_table(spark, name, frame(spark, []).schema)
    assert tables.read_table(spark, name).count() == 0
    other = frame(spark, [("x", 1)], "part string, id bigint")
    with pytest.raises(tables.SchemaMismatchError) as error:
        tables.overwrite_table(spark, other, name)
    assert "column v is missing" in str(error.value)
    with pytest.raises(tables.SchemaMismatchError, match="column part is number 1 instead of 2"):
        tables.overwrite_table(spark, frame(spark, [], "part string, id bigint, v int"), name)
    with pytest.raises(tables.SchemaMismatchError, match="column w is not in the table"):
        tables.overwrite_table(spark, frame(spark, [], "id bigint, part string, v int, w int"), name)
    wider = frame(spark, [], "id bigint, part string, v bigint")
    tables.assert_schema_matches(spark, name, wider)
    with pytest.raises(ValueError, match="column v is bigint instead of int"):
        tables.assert_schema_matches(spark, name, wider, check_types=True)


def test_ensure_table_keeps_an_existing_one(spark, namespace):
    name = f"{namespace}.t"
    tables.overwrite_table(spark, frame(spark, [(1, "a", 1)]), name)
    tables.ensure_table(spark, name, frame(spark, []).schema)
    assert tables.read_table(spark, name).count() == 1


def test_partitioned_table_prunes(spark, namespace):
    name = f"{namespace}.t"
    tables.overwrite_table(
        spark, frame(spark, [(1, "a", 1), (2, "b", 2)]).select("id", "v", "part"), name, partition_by=["part"]
    )
    one = tables.read_table(spark, name).filter("part = 'a'")
    assert rows(one) == [(1, 1, "a")]
    assert "PartitionFilters: [isnotnull(part" in plan(one)


def test_bulk_load_appends(spark, namespace, tmp_path):
    name = f"{namespace}.t"
    tables.overwrite_table(spark, frame(spark, [(1, "a", 1)]), name)
    landing.write_parquet(frame(spark, [(2, "b", 2)]), f"{tmp_path}/seed")
    tables.bulk_load(spark, f"{tmp_path}/seed", name)
    assert rows(tables.read_table(spark, name)) == [(1, "a", 1), (2, "b", 2)]
    keyed = f"{namespace}.k"
    tables.upsert(spark, frame(spark, [(1, "a", 1)]), keyed, ["id"], parts=4)
    tables.bulk_load(spark, f"{tmp_path}/seed", keyed)
    tables.upsert(spark, frame(spark, [(2, "c", 3)]), keyed, ["id"])
    assert rows(tables.read_table(spark, keyed)) == [(1, "a", 1), (2, "c", 3)]


def test_upsert_updates_inserts_and_is_idempotent(spark, namespace):
    name = f"{namespace}.t"
    tables.upsert(spark, frame(spark, [(1, "a", 1), (2, "b", 2)]), name, ["id"])
    change = frame(spark, [(2, "B", 20), (3, "c", 3)])
    for _ in range(2):
        tables.upsert(spark, change, name, ["id"])
        assert rows(tables.read_table(spark, name)) == [(1, "a", 1), (2, "B", 20), (3, "c", 3)]


def test_upsert_by_composite_key(spark, namespace):
    name = f"{namespace}.t"
    tables.upsert(spark, frame(spark, [(1, "a", 1), (1, "b", 2)]), name, ["id", "part"])
    tables.upsert(spark, frame(spark, [(1, "b", 9)]), name, ["id", "part"])
    assert rows(tables.read_table(spark, name)) == [(1, "a", 1), (1, "b", 9)]


@pytest.mark.parametrize("data, message", [([(None, "a", 1)], "NULL key"), ([(1, "a", 1), (1, "b", 2)], "repeats a key")])
def test_upsert_rejects_bad_source_keys(spark, namespace, data, message):
    with pytest.raises(Exception, match=message):
        tables.upsert(spark, frame(spark, data), f"{namespace}.t", ["id"])


def test_every_match_is_updated_whatever_the_source_size(spark, no_broadcast):
    """Repeated and NULL target keys, with and without a broadcast."""
    target = frame(spark, [(i % 40, "old", i) for i in range(50)] + [(None, "kept", 0), (None, "kept", 0)])
    source = spark.range(30, 70).selectExpr("id", "'new' AS part", "cast(NULL AS int) AS v")
    shuffled = rows(tables.merge_rows(target, source, ["id"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    broadcast = tables.merge_rows(target, source, ["id"])
    assert "BroadcastHashJoin" in plan(broadcast) and rows(broadcast) == shuffled
    assert len(shuffled) == 52 + 30 and shuffled.count((None, "kept", 0)) == 2
    few = frame(spark, [(1, "new", 0)])
    twice = frame(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 3)])
    assert rows(tables.merge_rows(twice, few, ["id"])) == [(1, "new", 0), (1, "new", 0), (2, "c", 3)]


def test_a_clustered_target_is_not_shuffled(spark, namespace, no_broadcast):
    name = f"{namespace}.t"
    data = frame(spark, [(i, "x", i) for i in range(100)])
    tables.upsert(spark, data, name, ["id"], buckets=8)
    merged = tables.merge_rows(tables.read_table(spark, name), data.limit(50), ["id"])
    lines = plan(merged).split("\n")
    scans = [i for i, line in enumerate(lines) if "FileScan" in line]
    assert len(scans) == 2
    for i in scans:
        above = next(j for j in range(i, -1, -1) if "Join" in lines[j])
        assert not any("Exchange" in line for line in lines[above:i] if line.index(line.lstrip(" :+-")) <= lines[i].index("FileScan") and "Sort" not in line) or "Exchange" not in lines[i - 1]
    tables.upsert(spark, data, name, ["id"], buckets=8)
    assert tables.read_table(spark, name).count() == 100


def test_names_must_be_qualified(spark):
    with pytest.raises(ValueError, match="qualified"):
        tables.overwrite_table(spark, frame(spark, []), "t")


def test_share_is_live_and_can_be_revoked(spark, namespace):
    consumer = f"{namespace}_c"
    name = f"{namespace}.vendas"
    tables.overwrite_table(spark, frame(spark, [(1, "a", 1)]), name)
    assert share.publish(spark, namespace, consumer) == ["vendas"]
    read = lambda: rows(spark.table(f"{consumer}.vendas").agg(F.count("*"), F.max("v")))
    assert read() == [(1, 1)]
    tables.upsert(spark, frame(spark, [(2, "b", 7)]), name, ["id"])
    assert read() == [(2, 7)]
    share.revoke(spark, consumer, ["vendas"])
    assert not spark.catalog.tableExists(f"{consumer}.vendas")
    assert spark.catalog.tableExists(name)


def test_share_again_after_a_new_column(spark, namespace):
    consumer = f"{namespace}_c"
    spark.sql(f"CREATE TABLE {namespace}.p (a int) USING parquet")
    share.publish(spark, namespace, consumer, ["p"])
    spark.sql(f"ALTER TABLE {namespace}.p ADD COLUMN b int")
    assert spark.table(f"{consumer}.p").columns == ["a"]
    share.publish(spark, namespace, consumer, ["p"])
    assert spark.table(f"{consumer}.p").columns == ["a", "b"]


def test_table_selection_patterns():
    names = ["db.public.orders", "db.public.order_items", "db.audit.log", "other.public.orders"]
    assert landing.select_tables(names) == names
    assert landing.select_tables(names, ["db.public.*"]) == names[:2]
    assert landing.select_tables(names, ["%.orders"]) == [names[0], names[3]]
    assert landing.select_tables(names, ["db.*"], ["*.audit.%"]) == names[:2]
    assert landing.select_tables(names, ["db.public.order"]) == []


def test_full_load_lands_gzip_by_schema_and_table(spark, tmp_path):
    landed = landing.full_load(
        lambda name: frame(spark, [(1, name, 1)]), ["db.public.a", "db.audit.b"], f"{tmp_path}/raw/", ["db.public.%"]
    )
    assert landed == {"db.public.a": f"{tmp_path}/raw/public/a"}
    assert list((tmp_path / "raw" / "public" / "a").glob("*.gz.parquet"))
    assert rows(landing.read_landing(spark, landed["db.public.a"])) == [(1, "db.public.a", 1)]


def test_a_full_load_and_its_changes_replay_as_one_log(spark, tmp_path):
    landed = landing.full_load(lambda name: frame(spark, [(1, "a", 1), (2, "b", 2)]), ["db.public.a"], f"{tmp_path}/raw", committed_ms=100)
    copy = landing.read_landing(spark, landed["db.public.a"])
    later = spark.createDataFrame([(1, "a", 9, "u", 150), (2, "b", 2, "d", 160), (2, "b", 7, "u", 50)], copy.schema)
    state = cdc.state_from_log(copy.unionByName(later), ["id"])
    assert rows(state) == [(1, "a", 9, "u", 150)]


class Recorder:
    """Stands in for Spark's merge and write builders and notes what is called."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args):
            self.calls.append((name, *[str(a) for a in args]))
            return self

        return call


def test_three_part_names_use_the_formats_own_commands(spark, monkeypatch):
    """No such format is installed here, so only the commands chosen can be checked."""
    for name in ("ensure_namespace", "ensure_table", "assert_schema_matches"):
        monkeypatch.setattr(tables, name, lambda *args, **kwargs: None)
    df = frame(spark, [(1, "a", 1)])
    done = Recorder()
    begin = lambda step: lambda self, *args: getattr(done, step)(*args)
    monkeypatch.setattr(type(df), "writeTo", begin("writeTo"))
    monkeypatch.setattr(type(df), "mergeInto", begin("mergeInto"))
    assert tables.overwrite_table(spark, df, "lake.ns.t") == "lake.ns.t"
    assert [c[0] for c in done.calls] == ["writeTo", "overwrite"]
    done.calls.clear()
    tables.upsert(spark, df, "lake.ns.t", ["id", "part"])
    assert [c[0] for c in done.calls] == [
        "mergeInto",
        "whenMatched",
        "updateAll",
        "whenNotMatched",
        "insertAll",
        "merge",
    ]
    condition = done.calls[0][2]
    assert "source.id" in condition and "lake.ns.t.part" in condition and "AND" in condition.upper()


def test_drop_removes_all_that_is_stored(spark, namespace):
    name = f"{namespace}.t"
    for i in range(3):
        tables.overwrite_table(spark, frame(spark, [(i, "a", i)]), name)
    tables.drop_table(spark, name)
    assert spark.sql(f"SHOW TABLES IN {namespace}").filter("NOT isTemporary").count() == 0
    tables.overwrite_table(spark, frame(spark, [(9, "a", 9)]), name)
    assert rows(tables.read_table(spark, name)) == [(9, "a", 9)]


def test_rows_written_as_they_come_are_dealt_by_the_next_upsert(spark, namespace, monkeypatch):
    name = f"{namespace}.t"
    first = frame(spark, [(i, "a", i) for i in range(20)]).repartition(3)
    physical = tables.upsert(spark, first, name, ["id"], unique=True, deal=False)
    assert [r[0] for r in spark.table(physical).select(tables.PART).distinct().collect()] == [0]
    assert len(spark.table(physical).inputFiles()) == 3 and tables.read_table(spark, name).count() == 20
    monkeypatch.setattr(tables, "buckets_for", lambda size: 4)
    physical = tables.upsert(spark, frame(spark, [(3, "b", 0), (20, "b", 1)]), name, ["id"], deal=False)
    assert spark.table(physical).select(tables.PART).distinct().count() > 1
    kept = [(i, "a", i) for i in range(20) if i != 3]
    assert rows(tables.read_table(spark, name)) == rows(frame(spark, [*kept, (3, "b", 0), (20, "b", 1)]))


def test_whatever_is_stored_is_compressed_by_the_same_codec(spark, namespace):
    name = f"{namespace}.t"
    tables.upsert(spark, spark.range(20).selectExpr("id AS k", "1 AS v"), name, ["k"], parts=2)
    tables.upsert(spark, spark.range(5).selectExpr("id AS k", "2 AS v"), name, ["k"])
    files = spark.table(tables.stored_table(spark, name)).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert spark.table(name).where("v = 2").count() == 5
