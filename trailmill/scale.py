"""Building blocks that keep every task bounded when one key holds much of the data.

Three shapes recur in the operators:

* a small table joined to a large one: ``bounded_side`` counts it first and
  broadcasts only under a row limit;
* an order-dependent value inside a session (next click, position): sessions are
  cut into spans of positions, so a window never sees more than one span;
* a running total over a sorted table: ``running_totals`` range-partitions the
  rows and adds the totals of the slices before.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
SPAN = 65_536
TASKS_A_CORE = 4


def checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session; a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    wanted = spark.conf.get("spark.checkpoint.dir", None)
    if not wanted:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        wanted = tempfile.mkdtemp(prefix="trailmill-")
    context.setCheckpointDir(wanted)
    return wanted


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``materialise`` with the row count, taken while the rows are written."""
    return watched(df, F.count(F.lit(1)))


def watched(df: DataFrame, measure: Column) -> tuple[DataFrame, int]:
    """``materialise`` with one whole-number aggregate taken on the way."""
    checkpoint_dir(df.sparkSession)
    watch = Observation()
    written = df.observe(watch, measure.alias("measure")).checkpoint(eager=True)
    return written, watch.get["measure"] or 0


def spread(df: DataFrame, rows: int) -> int:
    """Number of partitions with about ``rows`` rows of a written ``df`` each, and no fewer than half of one per core.

    For work that is heavy per row, or needs memory per row: adaptive execution goes by bytes, and merges partitions that are
    small in bytes; a given number of partitions is kept.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(df.count() / rows), (cores + 1) // 2)


def scan_tasks(spark: SparkSession) -> int:
    """Number of partitions for scans that are heavy per row, several per core so that the last ones to end are short.

    As in ``spread``, but without a count: no fewer than the session's number of shuffle partitions, which goes with the data.
    """
    return max(TASKS_A_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def beside(spark: SparkSession, work: Callable) -> Iterator[Future]:
    """Run ``work`` in a thread of its own: its jobs and those of the block share the cores, neither waits for the other.

    The outcome is ``result()`` of what is given. Leaving the block waits for the work. Pass frames that are written already.
    """
    checkpoint_dir(spark)
    with ThreadPoolExecutor(1) as thread:
        yield thread.submit(inheritable_thread_target(spark)(work))


def has_at_most(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def is_small(rows: int) -> bool:
    return rows <= BROADCAST_ROWS


def bounded_side(df: DataFrame, max_rows: int | None = None, small: bool | None = None) -> DataFrame:
    """Materialise a join side and mark it for broadcast only if it is small.

    A larger side is returned plain: it then reaches the join through its own
    exchange, which is the shape adaptive execution can split on a hot key. A loop
    that keeps the row count may pass the outcome of its first check as ``small``.
    """
    if small is not None:
        return hinted(materialise(df), small)
    side, rows = counted(df)
    return hinted(side, is_small(rows) if max_rows is None else rows <= max_rows)


def hinted(side: DataFrame, small: bool) -> DataFrame:
    """Broadcast a small side; leave a large one plain.

    Where a later aggregate uses the partitioning of the join again, adaptive execution splits a hot
    partition only with ``spark.sql.adaptive.forceOptimizeSkewedJoin``, which is for the caller to set.
    """
    return F.broadcast(side) if small else side


def span_of(position: str | Column, span: int = SPAN) -> Column:
    """Number of the span a 1-based position falls in, from 0."""
    column = F.col(position) if isinstance(position, str) else position
    return F.floor((column - 1) / F.lit(span)).cast("long")


def dense_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    out: str = "position",
) -> DataFrame:
    """1-based position of a row inside its key.

    ``bucket`` must rise with ``order`` (a minute, a day, a span of positions).
    Rows are numbered inside (key, bucket); the running count of earlier buckets is
    computed on one row per bucket and joined back on (key, bucket).
    """
    keyed = df.withColumn("_bucket", bucket)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        keyed.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (
        keyed.withColumn("_row", F.row_number().over(inside))
        .join(base, [*keys, "_bucket"])
        .withColumn(out, (F.col("_base") + F.col("_row")).cast("long"))
        .drop("_bucket", "_row", "_base")
    )


def with_halo(
    df: DataFrame, position: str, before: int = 0, after: int = 0, span: int = SPAN
) -> DataFrame:
    """Give each span a copy of its neighbours' edge rows.

    Adds ``_span`` (the span that reads the row) and ``_own`` (false on copies). A
    window over (key, ``_span``) then sees ``before`` earlier and ``after`` later
    rows across the border, and only rows with ``_own`` are kept afterwards.
    """
    if max(before, after) > span:
        raise ValueError("the halo must fit in one span")
    own = span_of(position, span)
    offset = F.pmod(F.col(position) - 1, F.lit(span))
    readers = [own]
    if after:
        readers.append(F.when((own > 0) & (offset < after), own - 1))
    if before:
        readers.append(F.when(offset >= span - before, own + 1))
    return (
        df.withColumn("_home", own)
        .withColumn("_span", F.explode(F.array_compact(F.array(*readers))))
        .withColumn("_own", F.col("_span") == F.col("_home"))
        .drop("_home")
    )


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    columns: dict[str, str],
    ahead: int = 1,
    span: int = SPAN,
) -> DataFrame:
    """Value ``ahead`` rows later in the key; ``position`` must have no gaps."""
    w = Window.partitionBy(*keys, "_span").orderBy(position)
    wide = with_halo(df, position, after=ahead, span=span)
    for out, source in columns.items():
        wide = wide.withColumn(out, F.lead(source, ahead).over(w))
    return wide.filter("_own").drop("_span", "_own")


def running_totals(
    df: DataFrame,
    order: Sequence[str | Column],
    sums: dict[str, Column | str],
    group: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running sums in a global (or per-group) sort order.

    Rows are range-partitioned on group and order, so a group of any size spreads
    over many slices. The order must be unique inside a group.
    """
    keys = [k if isinstance(k, Column) else F.col(k) for k in order]
    staged = df
    for out, source in sums.items():
        staged = staged.withColumn(out, source if isinstance(source, Column) else F.col(source))
    sliced = materialise(
        staged.repartitionByRange(*[F.col(g) for g in group], *keys).withColumn(
            "_slice", F.spark_partition_id()
        )
    )
    anchor = list(group) or [F.lit(0)]
    earlier = Window.partitionBy(*anchor).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy(*group, "_slice").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    offsets = totals.select(
        *group,
        "_slice",
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in sums],
    )
    inside = (
        Window.partitionBy(*group, "_slice")
        .orderBy(*keys)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = sliced.select(
        "*", *[F.sum(c).over(inside).alias(f"_l_{c}") for c in sums]
    ).join(offsets, [*group, "_slice"])
    for c in sums:
        joined = joined.withColumn(c, F.col(f"_o_{c}") + F.col(f"_l_{c}"))
    return joined.drop("_slice", *[f"{p}{c}" for c in sums for p in ("_o_", "_l_")])


def exact_percentiles(
    df: DataFrame, value: str, probabilities: dict[str, float], group: Sequence[str] = ()
) -> DataFrame:
    """Exact interpolated percentiles, one row per group.

    Equal values are counted before anything is sorted, so the sort moves distinct
    values only, and no task holds a whole group.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = running_totals(counts, ["_v"], {"_upto": "_n"}, group)
    sizes = ranked.groupBy(*group).agg(F.max("_upto").alias("_size"))
    if group:
        ranked = ranked.join(bounded_side(sizes), list(group))
    else:
        ranked = ranked.withColumn("_size", F.lit(sizes.first()["_size"] or 0))
    picks, out = [], []
    for name, p in probabilities.items():
        target = F.lit(p) * (F.col("_size") - 1)
        for side, index in (("lo", F.floor(target)), ("hi", F.ceil(target))):
            here = (F.col("_upto") > index) & (F.col("_upto") - F.col("_n") <= index)
            picks.append(F.max(F.when(here, F.col("_v"))).alias(f"_{side}_{name}"))
        picks.append(F.max(target - F.floor(target)).alias(f"_f_{name}"))
        out.append(
            (F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_f_{name}"))
            .alias(name)
        )
    return ranked.groupBy(*group).agg(*picks).select(*group, *out)
