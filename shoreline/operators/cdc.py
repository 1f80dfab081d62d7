"""Change envelopes to event logs and to current state.

An envelope is ``before`` and ``after`` row images, the operation ``op`` (c, u, d, or r for a
snapshot row) and ``ts_ms``. Every function but the last three is a projection or filter, so it
works the same on a stream and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shoreline.functions import timestamps

# The fields of a web event's row image, the personal ones left out of the event
# log, and those the current-state table keeps.
IMAGE_FIELDS = (
    "event_id", "event_timestamp", "event_type", "page_url", "page_url_path", "referer_url",
    "referer_url_scheme", "referer_url_port", "referer_medium", "utm_medium", "utm_source",
    "utm_content", "utm_campaign", "click_id", "geo_latitude", "geo_longitude", "geo_country",
    "geo_timezone", "geo_region_name", "ip_address", "browser_name", "browser_user_agent",
    "browser_language", "os", "os_name", "os_timezone", "device_type", "device_is_mobile",
    "user_custom_id", "user_domain_id",
)
PERSONAL_FIELDS = (
    "ip_address", "browser_name", "browser_user_agent", "browser_language", "os", "os_name",
    "device_type", "device_is_mobile", "user_custom_id",
)
STATE_FIELDS = (
    "event_id", "event_timestamp", "event_type", "page_url", "page_url_path", "referer_url",
    "referer_medium", "utm_medium", "utm_source", "utm_campaign", "geo_country", "browser_name",
    "os_name", "device_type", "device_is_mobile", "user_custom_id", "user_domain_id",
)

IMAGE = T.StructType(
    [
        T.StructField(f, T.BooleanType() if f == "device_is_mobile" else T.StringType())
        for f in IMAGE_FIELDS
    ]
)
ENVELOPE = T.StructType(
    [
        T.StructField("before", IMAGE),
        T.StructField("after", IMAGE),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)


def strip_confluent_header(value: Column) -> Column:
    """The Avro body of a registry-framed message: skip 1 magic byte and a 4-byte schema id."""
    return F.substring(value, F.lit(6), F.length(value) - 5)


# Where a message stood in the topic: what orders two changes of one millisecond.
ARRIVAL = ("partition", "offset")


def decode_avro(df: DataFrame, schema_json: str, value_col: str = "value") -> DataFrame:
    """Registry-framed Avro messages to envelope columns and ``ARRIVAL``. Needs Spark's avro module."""
    from pyspark.sql.avro.functions import from_avro

    body = strip_confluent_header(F.col(value_col))
    arrival = [c for c in ARRIVAL if c in df.columns]
    return df.select(from_avro(body, schema_json).alias("data"), *arrival).select("data.*", *arrival)


def flatten_envelope(df: DataFrame, timestamp_col: str | None = "event_timestamp") -> DataFrame:
    """One flat row per change: ``before`` for a delete, else ``after``, with ``op, ts_ms`` and, if
    there, ``ARRIVAL``.

    ``timestamp_col`` is parsed with the strict pattern; other text becomes NULL. The image is
    chosen field by field rather than as a whole, so a field dropped later is never read from
    columnar files at all.
    """
    deleted = F.col("op") == "d"
    chosen = {
        name: F.when(deleted, F.col(f"before.{name}")).otherwise(F.col(f"after.{name}"))
        for name in df.schema["after"].dataType.names
    }
    if timestamp_col is not None:
        chosen[timestamp_col] = timestamps.strict(chosen[timestamp_col])
    arrival = [c for c in ARRIVAL if c in df.columns]
    return df.select(*[value.alias(name) for name, value in chosen.items()], "op", "ts_ms", *arrival)


def drop_columns(df: DataFrame, columns: Sequence[str] = PERSONAL_FIELDS) -> DataFrame:
    return df.drop(*columns)


def project_after(
    df: DataFrame,
    fields: Sequence[str] = STATE_FIELDS,
    key: str = "event_id",
    timestamp_col: str | None = "event_timestamp",
) -> DataFrame:
    """The chosen ``after`` fields plus ``_op, _ts_ms`` of every keyed change but deletes, and
    ``ARRIVAL`` if there."""
    live = df.filter(F.col(f"after.{key}").isNotNull() & (F.col("op") != "d"))

    def value(name: str) -> Column:
        column = F.col(f"after.{name}")
        return timestamps.best_effort(column) if name == timestamp_col else column

    return live.select(
        *[value(f).alias(f) for f in fields],
        F.col("op").alias("_op"),
        F.col("ts_ms").alias("_ts_ms"),
        *[c for c in ARRIVAL if c in df.columns],
    )


def signed_images(df: DataFrame, sign: str = "sign") -> DataFrame:
    """What each change takes away (``before``, sign -1) and adds (``after``, sign +1), as rows.

    Counts and sums over these follow updates and deletes, not only inserts.
    """
    sides = F.array(
        F.struct(F.lit(-1).alias(sign), F.col("before").alias("row")),
        F.struct(F.lit(1).alias(sign), F.col("after").alias("row")),
    )
    rows = df.select(F.inline(sides)).filter(F.col("row").isNotNull())
    return rows.select("row.*", sign)


def version_order(
    columns: Sequence[str], version: Sequence[str], op_col: str | None = None
) -> list[Column]:
    """What makes one change newer than another: version, then arrival, then being a delete.

    The offset decides between changes of one millisecond: all changes of a key come through one
    partition, in order. Where offsets are missing, a delete comes last, since a key's row is not
    changed once it is gone; other ties are settled by the remaining columns.
    """
    arrival = [c for c in ("offset",) if c in columns and c not in version]
    op = op_col or next((c for c in ("op", "_op") if c in columns), None)
    deleted = [F.col(op).eqNullSafe("d").alias("__deleted")] if op in columns else []
    return [*(F.col(c) for c in (*version, *arrival)), *deleted]


def latest_by_version(
    df: DataFrame,
    keys: Sequence[str],
    version: Sequence[str] = ("_ts_ms",),
    op_col: str | None = None,
) -> DataFrame:
    """The newest row per key, see ``version_order``."""
    order = version_order(df.columns, version, op_col)
    rest = [c for c in df.columns if c not in version and c != "offset"]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__best"))
    return best.select(*[F.col("__best").getField(c).alias(c) for c in df.columns])


def state_from_log(
    log: DataFrame,
    keys: Sequence[str],
    version: Sequence[str] = ("ts_ms",),
    op_col: str = "op",
) -> DataFrame:
    """Current rows from an event log: the last change per key, unless it is a delete."""
    last = latest_by_version(log, keys, version, op_col)
    return last.filter(~F.col(op_col).eqNullSafe("d"))


def snapshot_as_changes(rows: DataFrame, ts_ms: int) -> DataFrame:
    """A full table copy as flat change rows (``op = 'r'``), to be followed by its changes."""
    return rows.withColumns({"op": F.lit("r"), "ts_ms": F.lit(ts_ms).cast("bigint")})


def chunk_as_changes(rows: DataFrame, low: Column | int, position: str = "offset") -> DataFrame:
    """Rows copied from a table that goes on changing, as flat change rows.

    ``low`` is the log's position noted before the copy of these rows began; each chunk of a table
    may have its own. A row then shows all changes up to there, and perhaps later ones, which the
    log brings again.
    """
    mark = F.lit(low) if isinstance(low, int) else low
    return rows.withColumns({"op": F.lit("r"), position: mark.cast("bigint")})


def state_from_copy(
    copied: DataFrame, log: DataFrame, keys: Sequence[str], position: str = "offset"
) -> DataFrame:
    """Current rows from a table copied in chunks and the log of its changes meanwhile.

    ``copied`` are chunks made by ``chunk_as_changes``, and the log holds everything since the
    least of their marks. A change up to a row's mark is in that row already and loses to it; a later
    one replaces it, whether or not the copy had seen it. So the copy needs no lock and no
    transaction over the whole table, and chunks may be copied in any order, or again.
    """
    return state_from_log(copied.unionByName(log), keys, (position,), "op")
