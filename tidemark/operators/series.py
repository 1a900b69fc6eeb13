"""Per-entity row windows that stay parallel when one entity is huge.

``Window.partitionBy(entity)`` sends an entity's whole history to one task, so
a symbol holding a third of all rows becomes a third of the job in one task.
Every per-entity frame in this library looks back a bounded number of rows
(at most 336: the weekly return), so we cut each entity's history into chunks
of ``chunk_rows`` consecutive rows and copy the ``lookback`` rows before each
chunk into it (a halo). Windows then run over ``(entity, chunk)``, and only a
chunk's own rows are kept. Results equal the single-partition window exactly.

Positions come from a small table: row counts per ``(entity, time bucket)``
(a partial aggregate, so the scan ships counts, not rows), turned into
running offsets by a window over that small table. A bucket goes whole to the
chunk its first row falls in; a chunk therefore holds about ``chunk_rows``
rows plus one bucket. The halo copy factor is ``1 + lookback / chunk_rows``.

The count table grows with entities x buckets, so it is broadcast only after
its size is checked; beyond the bound the join is a shuffle join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

DEFAULT_CHUNK_ROWS = 1 << 16
DEFAULT_LOOKBACK = 336
BROADCAST_ROW_LIMIT = 2_000_000


def materialize(df: DataFrame) -> DataFrame:
    """Write a (small) derived table to the shared checkpoint folder once, so
    a size check and the join that follows do not compute it twice, and so a
    lost executor does not send the job back to the full scan behind it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, enabled: bool = True) -> DataFrame:
    """Pipeline stage boundary: write the frame once to the shared checkpoint
    folder and continue from there. Later size checks, scalar subqueries and
    joins then read the written rows instead of re-running the stage's whole
    lineage, and a lost executor costs one stage, not the job."""
    return materialize(df) if enabled else df


def sized_join(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Join with ``small`` broadcast only when its row count is checked to be
    under ``max_rows``; otherwise a plain (shuffle) join that AQE can still
    split for skew. Pass a materialized ``small`` (see ``materialize``)."""
    n = small.count()
    side = F.broadcast(small) if n <= max_rows else small
    return big.join(side, on, how)


def _bucket_offsets(df: DataFrame, entity: str, bucket_col: str, chunk_rows: int,
                    lookback: int, lookahead: int = 0) -> DataFrame:
    counts = df.groupBy(entity, bucket_col).agg(F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(entity).orderBy(F.asc_nulls_last(bucket_col))
         .rowsBetween(Window.unboundedPreceding, -1))
    before = F.coalesce(F.sum("_n").over(w), F.lit(0))
    total = F.sum("_n").over(Window.partitionBy(entity))
    return (counts.withColumn("_before", before)
            .select(entity, bucket_col, "_before", total.alias("_total"), "_n",
                    F.floor(F.col("_before") / chunk_rows).alias("_home"),
                    F.floor(F.greatest(F.col("_before") - lookahead, F.lit(0)) / chunk_rows).alias("_first"),
                    F.floor((F.col("_before") + F.col("_n") - 1 + lookback) / chunk_rows).alias("_last")))


def chunked(df: DataFrame, entity: str = "symbol", time: str = "snapshot_time",
            chunk_rows: int = DEFAULT_CHUNK_ROWS, lookback: int = DEFAULT_LOOKBACK,
            bucket: str = "day", lookahead: int = 0) -> DataFrame:
    """Add ``_chunk``, ``_home``, ``_bkt``, ``_before``, ``_total`` to every row,
    copying halo rows.

    A row appears once with ``_home = true`` in its own chunk and, when it is
    among the ``lookback`` rows before a later chunk, again with ``_home =
    false`` in that chunk. ``_before`` is the number of the entity's rows in
    earlier time buckets, ``_total`` the entity's row count.
    """
    if chunk_rows <= 0 or lookback < 0:
        raise ValueError("chunk_rows must be positive and lookback non-negative")
    keyed = df.withColumn("_bkt", F.date_trunc(bucket, F.col(time)))
    offsets = _bucket_offsets(keyed, entity, "_bkt", chunk_rows, lookback, lookahead)
    offsets = materialize(offsets.withColumnRenamed(entity, "_ent").withColumnRenamed("_bkt", "_obkt"))
    if lookahead > 0:
        # a chunk's home rows end inside its last bucket, which may run past the
        # nominal chunk end by up to one bucket: reach back that much further
        widest = offsets.agg(F.max("_n")).head()[0] or 0
        back = -(-widest // chunk_rows)
        offsets = offsets.withColumn("_first", F.greatest(F.col("_first") - back, F.lit(0)))
    offsets = offsets.drop("_n")
    cond = keyed[entity].eqNullSafe(offsets["_ent"]) & keyed["_bkt"].eqNullSafe(offsets["_obkt"])
    joined = sized_join(keyed, offsets, cond).drop("_ent", "_obkt")
    return (joined.withColumn("_chunk", F.explode(F.sequence(F.col("_first"), F.col("_last"))))
            .withColumn("_home", F.col("_chunk") == F.col("_home"))
            .drop("_first", "_last"))


def entity_window(entity: str, time: str, tiebreak: Sequence[str] = ()) -> Window:
    """Order spec for windows over the chunked frame."""
    order = [F.asc_nulls_last(time)] + [F.asc_nulls_last(c) for c in tiebreak]
    return Window.partitionBy(entity, "_chunk").orderBy(*order)


def ordinal(entity: str, time: str, tiebreak: Sequence[str] = ()) -> Column:
    """0-based position of a row in its entity's whole time order.

    Computed inside the ``(entity, chunk)`` clustering (a bucket never spans
    two chunks), so it adds a sort, not a shuffle."""
    order = [F.asc_nulls_last(time)] + [F.asc_nulls_last(c) for c in tiebreak]
    w = Window.partitionBy(entity, "_chunk", "_bkt").orderBy(*order)
    return F.col("_before") + F.row_number().over(w) - 1


def with_entity_windows(df: DataFrame, build: Callable[[DataFrame, Window], DataFrame],
                        entity: str = "symbol", time: str = "snapshot_time",
                        tiebreak: Sequence[str] = (), chunk_rows: int = DEFAULT_CHUNK_ROWS,
                        lookback: int = DEFAULT_LOOKBACK, bucket: str = "day",
                        lookahead: int = 0) -> DataFrame:
    """Run ``build(frame, window)`` over chunked entity histories.

    ``build`` adds columns using ``window`` (row frames looking back at most
    ``lookback`` rows and ahead at most ``lookahead``); it may also use
    ``ordinal(...)`` and the ``_total`` column. The result keeps each input
    row exactly once.
    """
    frame = chunked(df, entity, time, chunk_rows, lookback, bucket, lookahead)
    out = build(frame, entity_window(entity, time, tiebreak))
    return out.filter(F.col("_home")).drop("_home", "_chunk", "_bkt", "_before", "_total")


def group_rank(df: DataFrame, group: str, order_col: str, descending: bool = True,
               name: str = "rank", target_rows: int = 2_000_000, max_buckets: int = 1024,
               accuracy: int = 10_000, partitions: int | None = None,
               tiebreak: Sequence[str] = ()) -> DataFrame:
    """SQL ``RANK()`` of ``order_col`` within ``group``, splitting hot groups.

    Group sizes are checked first (a partial-aggregate count). When every
    group fits ``target_rows``, this is one window per group. Otherwise each
    oversized group is cut into value ranges at approximate quantiles (a small
    materialized table, so the cut is a fixed function of the value and equal
    values share a range); ranks are taken per (group, range) and shifted by
    the number of the group's rows in higher ranges. The rank stays exact:
    approximation only moves where the cuts fall. NULL values get a NULL rank
    (pandas semantics)."""
    key = [F.desc_nulls_last(order_col) if descending else F.asc_nulls_last(order_col)]
    key += [F.asc_nulls_last(c) for c in tiebreak]
    v = F.col(order_col)
    sizes = materialize(df.groupBy(group).agg(F.count(F.lit(1)).alias("_gn")))
    largest = sizes.agg(F.max("_gn")).head()[0] or 0
    n_buckets = min(max_buckets, -(-largest // target_rows))
    if n_buckets <= 1:
        r = F.rank().over(Window.partitionBy(group).orderBy(*key))
        return df.withColumn(name, F.when(v.isNotNull(), r))
    probs = [k / n_buckets for k in range(1, n_buckets)]
    hot = sizes.filter(F.col("_gn") > target_rows).select(group)
    cuts = materialize(df.join(F.broadcast(hot) if hot.count() <= BROADCAST_ROW_LIMIT else hot, group, "left_semi")
                       .groupBy(group)
                       .agg(F.array_distinct(F.percentile_approx(order_col, probs, accuracy)).alias("_cuts")))
    x = sized_join(df, cuts, group, "left")
    if descending:
        bucket = F.size(F.filter(F.col("_cuts"), lambda c: c > v))
    else:
        bucket = F.size(F.filter(F.col("_cuts"), lambda c: c < v))
    x = x.withColumn("_rb", F.when(F.col("_cuts").isNull() | v.isNull(), F.lit(0)).otherwise(bucket)).drop("_cuts")
    local = x.withColumn("_lr", F.rank().over(Window.partitionBy(group, "_rb").orderBy(*key)))
    counts = x.groupBy(group, "_rb").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(group).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).drop("_cnt")
    out = local.join(offsets, [group, "_rb"], "left")
    return out.withColumn(name, F.when(v.isNotNull(), F.col("_off") + F.col("_lr"))).drop("_rb", "_lr", "_off")
