"""Mixing sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, target words over
words at hand. The expected copies are prefix-summed over the source's documents,
one random offset per source is added, and a document is emitted once for each
integer that its stretch of the sum crosses. Documents are walked by size, so the
words taken differ from the target by less than the source's largest document.

The prefix sum is a range partitioning by (source, size, tie), a running sum inside
each part and the totals of the parts before: a source holding most rows spreads over
all parts. All of it is whole-number arithmetic (decimals of 38 digits), so reruns,
other partitionings and lost executors give the same copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, packed, stage, unpacked, unstage

BIG = "decimal(38,0)"
UNIT = 1 << 24          # steps of the random offset


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; NULL has none. Each word becomes one letter and
    white space goes, so no list of words is built for a long text."""
    marks = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.translate(marks, " \t\n\x0b\f\r", "")), F.lit(0)).cast("long")


def _spread(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` written in range partitions of ``order``, with the partition's number in
    ``part``; partitions with smaller numbers hold smaller rows."""
    return stage(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), label)


def _before(df: DataFrame, keys: list[str], value: Column, order: list[Column]) -> DataFrame:
    """``df`` of :func:`_spread` plus ``before``: the sum of ``value`` over the rows
    of the same ``keys`` that come before in ``order``. Windows hold one part's rows of a
    key, or one row per part of a key."""
    total = df.groupBy("part", *keys).agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    if not keys:        # one row per part, so as many rows as there are partitions
        w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(BIG)
    total = total.select(F.col("part").alias("_part"), *[F.col(k).alias(f"_{k}") for k in keys],
                         F.coalesce(F.sum("_sum").over(w), zero).alias("_base"))
    inner = Window.partitionBy("part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    on = F.col("part") == F.col("_part")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return (df.withColumn("_in", F.coalesce(F.sum(value).over(inner), zero)).join(total, on)
            .withColumn("before", (F.col("_base") + F.col("_in")).cast(BIG))
            .drop("_part", "_base", "_in", *[f"_{k}" for k in keys]))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Per source of ``sizes(source, size)``: ``source, source_size, target, up, down``.

    Sources by code point, NULL last, get ``weights`` in turn and share the words of all
    documents; a target stops at ``most`` times its source's words, and what is over
    is shared again by weight until no target is above. ``up / down`` is the exact number
    of copies a document of the source expects (0 without words). Staged; the caller
    unstages."""
    order = [F.col("source").asc_nulls_last()]
    plain = _spread(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), order, "sources")
    at = _before(plain, [], F.lit(1).cast(BIG), order).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("before") % len(weights) + 1).cast("int")).cast(BIG))
    ranked = stage(at.select("source", F.col("source_size").cast(BIG).alias("size"), "weight"), "ranked")
    unstage(plain)
    total = int(ranked.agg(F.sum("size")).first()[0] or 0)
    big = lambda n: F.lit(str(n)).cast(BIG)
    cap = F.col("size") * most
    capped, rest, weight = F.lit(False), total, None
    while True:     # the level only rises, so each round caps more sources or is the last
        held, w = ranked.agg(F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight")))).first()
        now = (total - int(held or 0), int(w or 0))
        if now == (rest, weight):
            break
        rest, weight = now
        capped = cap * big(weight) <= big(rest) * F.col("weight")
        if not weight:
            capped = F.lit(True)
    free = big(rest) * F.col("weight")
    out = ranked.select(
        "source", F.col("size").cast("long").alias("source_size"),
        F.when(capped, cap.cast("double")).otherwise(free.cast("double") / float(weight or 1)).alias("target"),
        F.when(F.col("size") == 0, big(0)).when(capped, big(most)).otherwise(free).cast(BIG).alias("up"),
        F.when((F.col("size") == 0) | capped, big(1)).otherwise(F.col("size") * big(weight)).cast(BIG).alias("down"))
    out = stage(out, "targets")
    unstage(ranked)
    return out


def _plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, keep: list[str], weights, most: int, seed: int) -> DataFrame:
    rows = docs.select(packed(docs, keep), col(id_col).alias("doc_id"), col(source_col).alias("source"),
                       word_count(col(text_col)).alias("size"))
    tie = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    # rows with equal ids and sizes are told apart by their place in the table, which
    # only decides between equal rows and lets a range split them
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("tie"), F.col("place")]
    rows = _spread(rows.withColumn("tie", tie).withColumn("place", F.monotonically_increasing_id()), order, "sizes")
    goal = targets(rows.select("source", "size"), weights, most)
    head = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))), 1, 6), 16, 10)
    goal = goal.select(F.col("source").alias("_source"), "source_size", "target", (F.col("up") * UNIT).cast(BIG).alias("_step"),
                       (F.col("down") * UNIT).cast(BIG).alias("_one"), (head.cast(BIG) * F.col("down")).cast(BIG).alias("_offset"))
    rows = rows.join(goal, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    at = _before(rows, ["source"], F.col("_step"), order[1:]).withColumn("_at", (F.col("before") + F.col("_offset")).cast(BIG))
    crossed = F.expr("cast((_at + _step) as decimal(38,0)) div _one") - F.expr("_at div _one")
    return (at.withColumn("copies", crossed)
            .select("row", "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 12) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` for every row of ``docs``:
    its words, its source's words and target, the words taken from it (``copies * size``,
    ``copies`` at most ``most``).

    NULL text and text without words have size 0 and nothing to take; NULL source is a
    source (the last); NULL ids are allowed; of rows with equal id, source and size it
    does not matter which is taken. A source without words has target 0; an empty table
    gives an empty one. Other columns of ``docs`` are not read."""
    return _plan(docs, id_col, text_col, source_col, [], weights, most, seed).drop("row")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 12) -> DataFrame:
    """The mixed corpus: rows of ``docs``, all columns kept, each as often as
    :func:`plan` takes it. A text without words is kept as often as its source's others."""
    at = _plan(docs, id_col, text_col, source_col, docs.columns, weights, most, seed)
    at = at.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return at.select(*unpacked(docs.columns))
