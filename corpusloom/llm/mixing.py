"""Mixing sources to target weights by Pareto order sampling.

Every source has a target of words. Each document first gets the whole copies that are
certain, ``floor(target / source size)``; what then lacks is a fixed size of words that is
filled with documents in Pareto order: the random odds ``u / (1 - u)`` over the odds of the
document's inclusion probability, smallest first. The probability is proportional to the
document's weight, up to 1: documents that reach it are certain and come first, and the
others share what these leave, until no more become certain. Without a weight column all
weights are 1, and the probability is the source's rest over its size. The order is cut where the running size comes nearest the rest, so a source misses its
target by at most half of one document. ``u`` is a hash of seed, id and text: reruns agree,
and no partitioning changes a choice.

No source is ever in one task: totals are aggregated before they are shuffled, the cut is
found from sums per (source, slice of the order), and only the slice that holds the cut is
ordered by row.

Defined results: a null or blank text has size 0 and no copies; a null source is a source,
the last one; rows equal in id and text share their u and are taken together; a source of
size 0 has target 0; a document whose weight is null, NaN or not positive gets whole copies only,
and a source whose weighted documents are fewer words than its rest takes them all; empty tables give empty results. Other columns are kept, whatever
their names; the answer's column gets underscores in front where its name is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.keys import uniform
from corpusloom.llm.arrow import free_name
from corpusloom.session import stage

SEED = 20
SLICES = 4096  # of the order, per source
WEIGHTS = (5, 2, 1)
MOST = 3  # copies of a document, and multiple of its size that a source may reach


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     ")
    return F.size(F.array_remove(F.split(spaced, " "), "")).cast("bigint")


def ranked(sources: DataFrame) -> DataFrame:
    """Number the sources from 0 by code point, null last, as ``place``.

    Two levels, so that many sources never meet in one task: sorted inside the part that
    the leading two bytes name, after the rows of all earlier parts.
    """
    part = F.coalesce(F.substring(F.hex(F.col("source").cast("binary")), 1, 4), F.lit("~"))
    rows = sources.withColumn("part", part)
    counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # at most 65,793 rows
    before = counts.select(
        F.col("part").alias("p"),
        (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_last("source")))
    return (
        rows.withColumn("row", inside)
        .join(before, F.col("part") == F.col("p"))
        .withColumn("place", F.col("before") + F.col("row") - 1)
        .drop("part", "p", "row", "before")
    )


def with_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Target of each source (``source``, ``source_size``): shares by weight of the whole size.

    A target stops at ``most`` times its source; the excess goes to the others by weight,
    again and again. One number, the words per unit of weight, is all that the rounds pass on.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = stage(ranked(sources).withColumn("weight", weight.cast("bigint")), "sources")
    cap = F.col("source_size") * most
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level = capped = None
    while True:
        full = F.lit(False) if level is None else cap <= F.col("weight") * F.lit(level)
        n, spent, open_weight = rows.agg(
            F.sum(F.when(full, 1).otherwise(0)),
            F.sum(F.when(full, cap).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))),
        ).first()
        if n == capped or not open_weight:
            break
        capped, level = n, (total - spent) / open_weight
    share = cap.cast("double") if level is None else F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    return rows.withColumn("target", share)


def _odds(p: Column) -> Column:
    return F.coalesce(F.try_divide(p, F.lit(1.0) - p), F.lit(float("inf")))


def _inclusion(level: Column, weight: Column) -> Column:
    return F.least(F.lit(1.0), level * weight)


def _pareto(u: Column, inclusion: Column) -> Column:
    """The place in Pareto order: odds of u over the odds of inclusion; none without a chance."""
    return F.try_divide(_odds(u), _odds(inclusion))


def _slice(order: Column) -> Column:
    return F.least(F.floor(order / (order + 1) * SLICES), F.lit(SLICES - 1)).cast("int")


def _levels(drawn: DataFrame) -> DataFrame:
    """Inclusion probability per unit of weight, ``s, level``, from source, rest, size and weight.

    Each round adds up the certain documents and the weights of the others per source; the
    certain ones only become more, so it ends. One row per source is all that a round passes on.
    """
    levels, certain = None, -1
    while True:
        if levels is None:
            met = drawn.withColumn("level", F.lit(0.0))
        else:
            met = drawn.join(levels, F.col("source").eqNullSafe(F.col("s"))).drop("s")
        full = F.col("level") * F.col("weight") >= 1
        sums = met.groupBy("source", "rest").agg(
            F.sum(F.when(full, F.col("size")).otherwise(0)).alias("spent"),
            F.sum(F.when(full, 0.0).otherwise(F.col("size") * F.col("weight"))).alias("open"),
            F.sum(F.when(full, 1).otherwise(0)).alias("n"),
        )
        level = F.when(F.col("open") > 0, (F.col("rest") - F.col("spent")) / F.col("open")).otherwise(F.lit(float("inf")))
        found = stage(sums.select(F.col("source").alias("s"), level.alias("level"), "n"), "levels")
        n = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        levels = found.drop("n")
        if n == certain:
            return levels
        certain = n


def planned(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, weighted: bool = False) -> DataFrame:
    """One row per source from ``rows`` (source, size, u, weight): what the mix takes of it.

    ``whole`` copies of each document, and one more of those that come before ``cut`` in
    slices of the Pareto order, or in that slice up to ``upto``; ``level`` is the probability
    of this one more per unit of weight.
    """
    targets = with_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    whole = F.least(F.floor(F.try_divide("target", "source_size")), F.lit(most))
    per = targets.select("source", "source_size", "target", F.coalesce(whole, F.lit(0)).alias("whole"))
    per = per.withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    wanted = per.filter("rest > 0").select(F.col("source").alias("s"), "rest", "source_size")
    drawn = (
        rows.filter("size > 0 AND weight > 0")
        .join(wanted, F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
    )
    if weighted:
        levels = _levels(drawn)
    else:
        levels = per.select(F.col("source").alias("s"), F.try_divide("rest", "source_size").alias("level"))
    per = stage(per.join(levels, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "levels")
    level = per.select(F.col("source").alias("s"), "level")
    drawn = (
        drawn.join(level, F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("order", _pareto(F.col("u"), _inclusion(F.col("level"), F.col("weight"))))
        .withColumn("slice", _slice(F.col("order")))
    )
    sums = drawn.groupBy("source", "rest", "slice").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        sums.withColumn("upto", F.sum("words").over(running))  # at most SLICES rows a source
        .filter(F.col("upto") >= F.col("rest"))
        .groupBy("source")
        .agg(F.min_by(F.struct("slice", (F.col("upto") - F.col("words")).alias("before")), "slice").alias("at"))
        .select(F.col("source").alias("s"), F.col("at.slice").alias("cut"), F.col("at.before").alias("before"))
    )
    cuts = stage(cuts, "cuts")
    line = Window.partitionBy("source").orderBy("order").rangeBetween(Window.unboundedPreceding, 0)
    inside = (
        drawn.join(cuts, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("cut")))
        .groupBy("source", "rest", "before", "order")  # equal rows share an order
        .agg(F.sum("size").alias("size"))
        .withColumn("run", F.col("before") + F.sum("size").over(line))
    )
    # Sizes are positive: each document brings the run nearer the rest until one does not.
    nearer = F.abs(F.col("run") - F.col("rest")) < F.abs(F.col("run") - F.col("size") - F.col("rest"))
    last = inside.filter(nearer).groupBy("source").agg(F.max("order").alias("upto")).withColumnRenamed("source", "t")
    return (
        per.join(cuts.drop("before"), F.col("source").eqNullSafe(F.col("s")), "left")
        .drop("s")
        .withColumn("cut", F.coalesce("cut", F.lit(SLICES)))  # fewer words than the rest: all of them
        .join(last, F.col("source").eqNullSafe(F.col("t")), "left")
        .drop("t")
    )


def _row_key(doc_id: str, text: str, seed) -> Column:
    return uniform(seed, F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))


def with_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    weight: str | None = None,
    drop: tuple[str, ...] = (),
    name: str = "mix",
) -> DataFrame:
    """``docs`` and a struct column: size, source_size, target, copies.

    ``weight`` names a column to which the chance of a document inside its source is proportional.

    Two passes over the texts: one for the sizes, one for the answer, both without a
    shuffle of texts.
    """
    u, size = free_name(docs, "__u"), free_name(docs, "__size")
    sized = docs.withColumns({size: word_count(F.col(text)), u: _row_key(doc_id, text, seed)})
    share = F.lit(1.0) if weight is None else F.coalesce(F.nanvl(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))
    narrow = sized.select(F.col(source).alias("source"), F.col(size).alias("size"), F.col(u).alias("u"), share.alias("weight"))
    plan = stage(planned(stage(narrow, "sizes"), weights, most, weight is not None), "mix")
    # One row per source: the planner broadcasts it by its measured size, else AQE splits a hot one.
    per = plan.select(F.struct("*").alias(free_name(sized, "__per")))
    row = F.col(per.columns[0])
    met = sized.join(per, F.col(source).eqNullSafe(row["source"]))
    order = _pareto(F.col(u), _inclusion(row["level"], share))
    at = _slice(order)
    extra = (F.col(size) > 0) & (share > 0) & (row["rest"] > 0) & (
        (at < row["cut"]) | ((at == row["cut"]) & (order <= row["upto"]))
    )
    copies = (row["whole"] + F.when(F.coalesce(extra, F.lit(False)), 1).otherwise(0)).cast("bigint")
    answer = F.struct(
        F.col(size).alias("size"),
        row["source_size"].alias("source_size"),
        row["target"].alias("target"),
        F.when(F.col(size) > 0, copies).otherwise(F.lit(0).cast("bigint")).alias("copies"),
    )
    return met.select(*[c for c in docs.columns if c not in drop], answer.alias(free_name(docs, name)))


def mixed(docs: DataFrame, copies: str = "copies", **options) -> DataFrame:
    """The documents that the mix takes, with their columns and how often each is taken."""
    name = free_name(docs, "mix")
    taken = with_copies(docs, **options)
    return taken.filter(F.col(name)["copies"] > 0).select(
        *docs.columns, F.col(name)["copies"].alias(free_name(docs, copies))
    )
