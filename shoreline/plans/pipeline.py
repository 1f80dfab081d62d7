"""The batch job graph: staging, dimensions, gate, facts, gate."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from shoreline.operators import contracts, quality, star
from shoreline.operators.counts import Counts
from shoreline.operators.dedup import keep_latest, keep_latest_where_repeated, near_latest, repeated_keys
from shoreline.session import shared_folder
from shoreline.sources import landing, tables

STAGING = "stg_sales"
MOST_BROADCAST = 1_000_000  # hashes of 8 bytes


def stage(
    spark: SparkSession,
    raw: DataFrame,
    name: str,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    normalizers: Mapping[str, contracts.Normalizer] | None = None,
    buckets: int = 0,
    counts: Counts | None = None,
) -> str:
    """Conform raw rows to the sales contract, keep one per key and upsert them.

    The keys are looked at first, by their hashes alone: where few repeat, all other rows go to the
    table as they are, and where many do, the rows that others of their key surely outrank go first.
    So ``raw`` is read more than once and must give the same rows each time.
    ``counts`` learns the rows that came in, in that first look, and those that were kept, while
    they are written.
    """
    counts = counts or Counts()
    looked_at = contracts.conform(counts.passing(raw, "raw"), contracts.SALES, normalizers)
    path = shared_folder(spark, "repeated")
    repeated_keys(looked_at, keys).write.parquet(path)
    repeated = spark.read.schema("_key long").parquet(path)
    rows = contracts.conform(raw, contracts.SALES, normalizers)
    if repeated.count() <= MOST_BROADCAST:
        rows = keep_latest_where_repeated(rows, keys, order_by, repeated)
    else:
        rows = keep_latest(near_latest(rows, keys, order_by), keys, order_by)
    rows = counts.passing(rows, STAGING)
    return tables.upsert(spark, rows, name, keys, unique=True, buckets=buckets, deal=False)


def _write_all(
    spark: SparkSession,
    namespace: str,
    builds: Mapping[str, Callable[[], DataFrame]],
    clustering: Mapping[str, Sequence[str]],
    buckets: int,
    published: bool,
    counts: Counts,
) -> dict[str, str]:
    """Build and write several tables at the same time; the first failure is raised.

    Returns what each table is stored as, which is what its name shows if it was ``published``.
    """

    def write(name: str) -> str:
        cluster_by = clustering.get(name, ()) if buckets else ()
        rows = counts.passing(builds[name](), name)
        return tables.overwrite_table(
            spark, rows, f"{namespace}.{name}", cluster_by=cluster_by, buckets=buckets, published=published
        )

    with ThreadPoolExecutor(len(builds)) as pool:
        target = inheritable_thread_target(spark)(write)
        return dict(zip(builds, pool.map(target, builds)))


def gate_dims(spark: SparkSession, namespace: str) -> list[tuple]:
    """The dimensions' gate as a job of its own, over the stored tables."""
    stored = {n: tables.read_table(spark, f"{namespace}.{n}") for n in quality.DIMENSION_RULES}
    return quality.gate(stored, quality.DIMENSION_RULES)


def gate_facts(spark: SparkSession, namespace: str) -> list[tuple]:
    """The facts' gate as a job of its own, over the stored tables."""
    stored = {n: tables.read_table(spark, f"{namespace}.{n}") for n in quality.FACT_RULES}
    return quality.gate(stored, quality.FACT_RULES)


def run_star_schema(
    spark: SparkSession,
    raw: DataFrame | str,
    namespace: str,
    keys: Sequence[str] = ("product_id",),
    order_by: Sequence[str] = (),
    strict_keys: bool = False,
    buckets: int = 0,
    publish: str = "before_gate",
    counts: Counts | None = None,
) -> dict[str, DataFrame]:
    """Run the whole graph and return its six tables by name.

    A failed gate raises and nothing after it runs. With ``publish="before_gate"``, as in the job
    graph this follows, a table is already replaced when its gate looks at it. With
    ``publish="after_gate"`` dimensions and facts are written beside the old ones, both gates look
    at these rows, and only then do all five names switch; if a gate fails, readers go on seeing the
    old tables and what was written is dropped. The staging table has no gate and is upserted in
    either case.

    With ``buckets`` staging and dimensions are stored clustered by their own keys, which do not
    repeat and so fill the buckets evenly. The next upsert and the fact joins on those keys then
    read them in place, for one more shuffle when they are written. ``counts`` learns the rows that
    went into every table without any further job.
    """
    if publish not in ("before_gate", "after_gate"):
        raise ValueError("publish is 'before_gate' or 'after_gate'")
    at_once, counts = publish == "before_gate", counts or Counts()
    source = landing.read_landing(spark, raw) if isinstance(raw, str) else raw
    name = f"{namespace}.{STAGING}"
    stage(spark, source, name, keys, order_by, buckets=buckets, counts=counts)
    stg = tables.read_table(spark, name)
    written: dict[str, str] = {}

    def write(builds: Mapping[str, Callable[[], DataFrame]], clustering: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
        many = buckets if clustering else 0
        stored = _write_all(spark, namespace, builds, clustering, many, at_once, counts)
        written.update({f"{namespace}.{n}": physical for n, physical in stored.items()})
        return {n: tables.read_table(spark, f"{namespace}.{n}" if at_once else stored[n]) for n in stored}

    try:
        dims = write(
            {
                "dim_product": lambda: star.dim_product(stg),
                "dim_user": lambda: star.dim_user(stg),
                "dim_rating": lambda: star.dim_rating(stg),
            },
            {"dim_product": ["product_id"], "dim_user": ["user_id"], "dim_rating": list(keys)},
        )
        quality.gate(dims, quality.DIMENSION_RULES)
        facts = write(
            {
                "fact_product_rating": lambda: star.fact_product_rating(
                    stg, dims["dim_product"], dims["dim_rating"]
                ),
                "fact_sales_category": lambda: star.fact_sales_category(
                    stg, dims["dim_product"], dims["dim_user"], strict_keys
                ),
            },
            {},
        )
        quality.gate(facts, quality.FACT_RULES)
    except Exception:
        if not at_once:
            tables.discard(spark, written)
        raise
    if not at_once:
        tables.publish(spark, written)
    return {STAGING: stg, **{n: tables.read_table(spark, f"{namespace}.{n}") for n in [*dims, *facts]}}
