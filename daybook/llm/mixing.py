"""Mixing sources to target weights by Pareto order sampling.

Targets. Sources share the total size by weight; no target passes ``max_copies`` times its source's size, and what a
capped source leaves goes to the others by weight (water filling: one running sum over sources, which are few).

Sampling. A source whose target is r times its size takes each document floor(r) times for certain. The rest is a sample
of fixed size, measured in words, with unequal inclusion probabilities p: r's fraction f, times a preference for longer
texts that keeps the expected words at f. Documents are ranked by odds(u) / odds(p), where u is a hash of the id and
``seed``, and the smallest ranks are taken until the words left for the source are reached (to the nearest document).

The rank that closes the sample is found without sorting a source: words are summed in 256 rank classes, then in 256
classes of the one that closes, then row by row in the one left. A hot source costs the same few rows as any other.

Null text has size 0. Null sources are a source of their own, last in order. A row with a null id is sampled like any
other. Rows that repeat an id are ranked alike, and taken each. Ties in rank go by id. Long texts are only counted. Empty
tables give no rows. Columns with other names pass through ``mixed``. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.common import WHITE_SPACE, free_name, let, staged

CLASSES = 256


def n_words(text: Column) -> Column:
    """Words of the text: pieces between white space, less the empty one before leading white space and after."""
    t = F.coalesce(text, F.lit(""))
    return F.size(F.filter(F.split(t, WHITE_SPACE), lambda w: w != "")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """(source, source_size, longer, target) from rows of (source, size).

    ``longer`` is the words' mean of log(2 + size), from whole numbers, so that it is the same in every run.
    """
    by_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.sum(F.floor(F.col("size") * F.log(F.col("size") + 2.0) * 1000).cast("decimal(38,0)")).alias("log_size"),
    )
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weighted = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * max_copies
    order = W.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    after = order.rowsBetween(0, W.unboundedFollowing)
    level = (F.sum("source_size").over(W.partitionBy(F.lit(1))) - F.coalesce(F.sum(cap).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))) / F.sum("weight").over(after)
    levels = weighted.withColumn("level", level).withColumn("place", F.row_number().over(order))
    # The first source that its cap does not hold back sets the level for all from there on.
    free = F.min_by(F.when(cap >= F.col("level") * F.col("weight"), F.col("level")), F.when(cap >= F.col("level") * F.col("weight"), F.col("place")))
    final = levels.withColumn("final", free.over(W.partitionBy(F.lit(1))))
    return final.select(
        "source",
        "source_size",
        F.coalesce(F.try_divide(F.col("log_size").cast("double") / 1000.0, F.col("source_size").cast("double")), F.lit(1.0)).cast("double").alias("longer"),
        F.least(cap.cast("double"), F.coalesce(F.col("final") * F.col("weight"), cap.cast("double"))).alias("target"),
    )


def _odds(p: Column) -> Column:
    return p / (1 - p)


def _class_that_closes(rows: DataFrame, cls: str) -> DataFrame:
    """Per source the class in which the running words reach what is ``left``, and what is left there."""
    upto = W.partitionBy("s").orderBy(cls).rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = rows.groupBy("s", cls).agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    running = sums.withColumn("upto", F.sum("words").over(upto))
    return running.filter(F.col("upto") >= F.col("left")).groupBy("s").agg(
        F.min(F.struct(F.col(cls).alias("cls"), (F.col("left") - F.col("upto") + F.col("words")).alias("left"))).alias("x")
    ).select("s", F.col("x.cls").alias(f"{cls}_closes"), F.col("x.left").alias(f"{cls}_left"))


def _ranks(id_: Column, size: Column, of, seed: int) -> dict[str, Column]:
    """A row's whole copies, the words ``left`` to sample in its source, its rank q and the classes of that.

    ``of`` gives a column of the row's source in ``targets`` by name.
    """
    ratio = F.coalesce(F.try_divide(of("target"), of("source_size").cast("double")), F.lit(1.0))
    whole = F.floor(ratio + 1e-9)
    part = F.greatest(ratio - whole, F.lit(0.0))
    u = (F.shiftrightunsigned(F.xxhash64(id_, F.lit(seed)), 11) + 0.5) / float(1 << 53)
    p = F.least(F.greatest(part * F.log(size + 2.0) / of("longer"), F.lit(1e-9)), F.lit(1 - 1e-9))
    rank = _odds(u) / _odds(p)
    q = F.when(F.lit(True), rank / (1 + rank))
    return {
        "whole": whole.cast("long"), "left": part * of("source_size"), "q": q,
        "c1": F.floor(q * CLASSES).cast("int"), "c2": F.floor(q * CLASSES * CLASSES).cast("long"),
    }


def _times(id_: Column, ranks: dict[str, Column], of) -> Column:
    """How often the mix takes a row; ``of`` gives a column of the row's source in ``_closed`` by name."""
    at = of("c2_closes")
    last = F.struct(ranks["q"].alias("q"), id_.alias("id")) <= of("edge")
    taken = (ranks["left"] > 0) & (at.isNull() | (ranks["c2"] < at) | ((ranks["c2"] == at) & last))
    return ranks["whole"] + F.coalesce(taken, F.lit(False)).cast("long")


def _closed(sizes: DataFrame, seed: int, weights: tuple[int, ...], max_copies: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (id, source, size) with their ranks, the rows of ``targets``, and where the sample of each source closes."""
    sizes = staged(sizes, "op4-sizes")
    found = staged(targets(sizes, weights, max_copies), "op4-targets")
    rows = sizes.join(found, sizes["source"].eqNullSafe(found["source"])).drop(found["source"])
    ranks = _ranks(F.col("id"), F.col("size"), F.col, seed)
    rows = staged(
        rows.select("id", "source", "size", "source_size", "target", _source("source").alias("s"), *[c.alias(n) for n, c in ranks.items()]),
        "op4-ranked",
    )
    sampled = rows.filter("left > 0")
    one = staged(_class_that_closes(sampled, "c1"), "op4-close")
    in_one = sampled.join(one, "s").filter("c1 = c1_closes").withColumn("left", F.col("c1_left"))
    two = staged(_class_that_closes(in_one, "c2"), "op4-close")
    near = W.partitionBy("s").orderBy("q", "id").rowsBetween(W.unboundedPreceding, W.currentRow)
    last = in_one.join(two, "s").filter("c2 = c2_closes").withColumn("upto", F.sum("size").over(near))
    # The document that closes is taken if that brings the source nearer to its target.
    edge = staged(
        last.filter(F.col("upto") - F.col("size") / 2 <= F.col("c2_left")).groupBy("s").agg(F.max(F.struct("q", "id")).alias("edge")),
        "op4-close",
    )
    return rows, found, two.join(edge, "s", "left").select("s", F.col("c2_closes"), "edge")


def _source(name: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(name), F.lit("")), F.col(name).isNull())


def copies(sizes: DataFrame, seed: int = 1, weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """Rows of (id, source, size) with source_size, target and ``copies``, how often the mix takes the row."""
    rows, _, closes = _closed(sizes, seed, weights, max_copies)
    ranks = {n: F.col(n) for n in ("whole", "left", "q", "c2")}
    return rows.join(closes, "s", "left").select(
        "id", "source", "size", "source_size", "target", _times(F.col("id"), ranks, F.col).alias("copies")
    )


def mixed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 1,
    weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3,
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them; a source without words stays as it is.

    A row is known by its id, source and text. Rows that agree in all three are taken alike; others have a rank, and
    copies, of their own.
    """
    of, n = free_name(docs, "of"), free_name(docs, "copies")
    key, text, source = (F.col(f"`{c}`") for c in (key, text, source))
    own = F.xxhash64(key, key.isNull(), source, source.isNull(), text, text.isNull())
    _, found, closes = _closed(docs.select(own.alias("id"), source.alias("source"), n_words(text).alias("size")), seed, weights, max_copies)
    # What decides about a row are its source's few figures: these go to the texts, which stay where they are.
    plan = staged(found.withColumn("s", _source("source")).join(closes, "s", "left").select(F.struct("*").alias(of)), "op4-plan")
    field = lambda name: F.col(of)[name]
    times = let(n_words(text), lambda size: _times(own, _ranks(own, size, field, seed), field))
    joined = docs.join(plan, source.eqNullSafe(field("source"))).withColumn(n, times).drop(of)
    return joined.filter(F.col(n) > 0).withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))).drop(n)
