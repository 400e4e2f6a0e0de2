"""Order-dependent operators that never put one group into one task.

A window over ``partitionBy(run)`` sends a whole run to one task, and an unpartitioned
window sends everything. The operators here split each group into blocks, work inside
the blocks, and carry a small per-block summary across them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.keys import bucket_of, order_key

UNBOUNDED = Window.unboundedPreceding


def bucket_prefix(totals: DataFrame, value: str, group: tuple[str, ...] = ()) -> DataFrame:
    """Sum of ``value`` over all earlier buckets of the group, as column ``before``.

    ``totals`` has one row per (group, bucket). Two levels: buckets inside their leading
    two digits, then the 256 leading parts, each adding its sum to the later ones.
    """
    head = F.substring("bucket", 1, 2)
    rows = totals.withColumn("_head", F.conv(head, 16, 10).cast("int"))
    inside = Window.partitionBy(*group, "_head").orderBy("bucket").rowsBetween(UNBOUNDED, -1)
    heads = (
        rows.groupBy(*group, "_head")
        .agg(F.sum(value).alias("_sum"))
        .filter("_head < 255")
        .select(*group, F.explode(F.sequence(F.col("_head") + 1, F.lit(255))).alias("_head"), "_sum")
        .groupBy(*group, "_head")
        .agg(F.sum("_sum").alias("_base"))
    )
    return (
        rows.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(heads, [*group, "_head"], "left")
        .withColumn("before", F.col("_in") + F.coalesce(F.col("_base"), F.lit(0)))
        .drop("_head", "_in", "_base")
    )


def seeded(df: DataFrame, key: list[str], seed) -> DataFrame:
    """Add the seeded order and its bucket."""
    return df.withColumn("order_key", order_key(seed, *[F.col(k) for k in key])).withColumn(
        "bucket", bucket_of(F.col("order_key"))
    )


def seeded_position(df: DataFrame, key: list[str], seed, group: tuple[str, ...] = ()) -> DataFrame:
    """Zero-based position of each row in the seeded shuffle of its group (``position``).

    Rows are numbered inside hash buckets; the bucket counts give each bucket its start.
    """
    keyed = seeded(df, key, seed)
    counts = keyed.groupBy(*group, "bucket").agg(F.count(F.lit(1)).alias("_n"))
    starts = bucket_prefix(counts, "_n", group).drop("_n")
    inside = Window.partitionBy(*group, "bucket").orderBy("order_key")
    return (
        keyed.withColumn("_row", F.row_number().over(inside))
        .join(starts, [*group, "bucket"])
        .withColumn("position", (F.col("before") + F.col("_row") - 1).cast("bigint"))
        .drop("_row", "before")
    )


def _bucket_holding(counts: Column, position: Column) -> Column:
    """Walk the bucket counts (at most 65,536) to the one that holds the position.

    Gives ``(bucket, want)``: the bucket and the one-based rank wanted inside it.
    """
    start = F.struct(
        F.lit(0).cast("bigint").alias("before"),
        F.lit(None).cast("string").alias("bucket"),
        F.lit(None).cast("bigint").alias("want"),
    )

    def step(acc: Column, entry: Column) -> Column:
        rest = (position - acc["before"]).cast("bigint")
        here = acc["bucket"].isNull() & (rest < entry["n"])
        return F.struct(
            (acc["before"] + entry["n"]).alias("before"),
            F.when(here, entry["bucket"]).otherwise(acc["bucket"]).alias("bucket"),
            F.when(here, rest + 1).otherwise(acc["want"]).alias("want"),
        )

    return F.aggregate(counts, start, step)


def key_at(keyed: DataFrame, wanted) -> DataFrame:
    """One row: the ``order_key`` at a zero-based position (null if past the end).

    ``wanted`` maps the row count to the position. One pass counts rows per bucket, which
    locates the bucket that holds the position; a second pass ranks that bucket alone.
    """
    counts = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    entries = counts.agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("all"))
    total = F.aggregate("all", F.lit(0).cast("bigint"), lambda acc, e: acc + e["n"])
    target = entries.select("all", wanted(total).alias("_at")).select(
        F.inline(F.array(_bucket_holding(F.col("all"), F.col("_at")))).alias("_before", "bucket", "_want")
    )
    # The target is one row, so it is always small enough to broadcast.
    inside = keyed.select("bucket", "order_key").join(F.broadcast(target), "bucket")
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("order_key"))
    return inside.withColumn("_row", rank).filter("_row = _want").agg(
        F.max("order_key").alias("order_key")
    )


def _summary(kind: str, value: Column, order: Column) -> Column:
    if kind == "last":
        return F.max_by(value, F.when(value.isNotNull(), order))
    return {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}[kind](value)


def _running(kind: str, value: Column) -> Column:
    if kind == "last":
        return F.last(value, ignorenulls=True)
    return {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}[kind](value)


def _combine(kind: str, carried: Column, inside: Column) -> Column:
    if kind in ("sum", "count"):
        both = F.coalesce(carried, F.lit(0)) + F.coalesce(inside, F.lit(0))
        return F.when(carried.isNotNull() | inside.isNotNull(), both)
    if kind == "last":
        return F.coalesce(inside, carried)
    return (F.least if kind == "min" else F.greatest)(carried, inside)


def running(
    df: DataFrame,
    group: list[str],
    order: str,
    measures: dict[str, tuple[str, Column]],
    width: int = 100_000,
    inclusive: bool = True,
    block: Column | None = None,
) -> DataFrame:
    """Running sum / min / max / count / last-non-null per group, in blocks of the order.

    ``measures`` maps an output name to (kind, expression). A block spans ``width``
    values of the integer order column (or is given); its summary row is carried to the
    later blocks, so a group of any size spreads over many tasks.
    """
    block = F.floor(F.col(order) / width) if block is None else block
    rows = df.withColumn("_block", block)
    totals = rows.groupBy(*group, "_block").agg(
        *[_summary(k, e, F.col(order)).alias(f"_t_{n}") for n, (k, e) in measures.items()]
    )
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(UNBOUNDED, -1)
    merge = {n: "sum" if k == "count" else k for n, (k, _) in measures.items()}
    carried = totals.select(
        *group,
        "_block",
        *[_running(merge[n], F.col(f"_t_{n}")).over(earlier).alias(f"_c_{n}") for n in measures],
    )
    inside = (
        Window.partitionBy(*group, "_block")
        .orderBy(order)
        .rowsBetween(UNBOUNDED, 0 if inclusive else -1)
    )
    out = rows
    for name, (kind, expression) in measures.items():
        out = out.withColumn(f"_i_{name}", _running(kind, expression).over(inside))
    out = out.join(carried, [*group, "_block"])
    for name, (kind, _) in measures.items():
        both = _combine(kind, F.col(f"_c_{name}"), F.col(f"_i_{name}"))
        out = out.withColumn(name, both).drop(f"_c_{name}", f"_i_{name}")
    return out.drop("_block")


def numbered(df: DataFrame, group: list[str], order: str, width: int = 100_000) -> DataFrame:
    """One-based row number per group (``row``), by the block method."""
    return running(df, group, order, {"row": ("count", F.lit(1))}, width)


def with_lookback(df: DataFrame, group: list[str], rows_back: int, width: int = 100_000) -> DataFrame:
    """Blocks of ``row`` numbers, each with the ``rows_back`` rows before it (``_halo``).

    A row near the end of a block is sent to the next block too, so a frame that looks
    back at most ``rows_back`` rows can run inside (group, ``_block``) alone.
    """
    width = max(width, rows_back + 1)
    home = F.floor((F.col("row") - 1) / width)
    reach = F.floor((F.col("row") - 1 + rows_back) / width)
    return (
        df.withColumn("_home", home)
        .withColumn("_block", F.explode(F.sequence(home, reach)))
        .withColumn("_halo", F.col("_block") != F.col("_home"))
        .drop("_home")
    )
