"""Distributed ordering primitives: global positions and exact quantiles.

A window with ``orderBy`` and no ``partitionBy`` moves every row into one
task.  Both operators here avoid that: rows are range-partitioned on the
order key, each range is numbered locally, and the per-range counts (one
row per range, a bounded table) give each range its starting offset.
This is the DataFrame form of counting per partition, then prefix-summing.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrolmart.session import checkpoint_root


def _by_range(df: DataFrame, n: int | None, key: list) -> DataFrame:
    """Range-partitioned by ``key``: n ranges, else ``spark.sql.shuffle.partitions``.

    The setting is sized for the cluster and the input (``cluster_conf``).
    """
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *key)


def _fix_ranges(df: DataFrame) -> DataFrame:
    """Materialize range-partitioned rows so every reader sees the same ranges.

    Range bounds are sampled from the input; two plans reading the same
    lineage could sample differently.  A reliable checkpoint in the shared
    ``spark.checkpoint.dir`` fixes ranges and local order once and survives
    executor loss.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


_LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def with_position(
    df: DataFrame, order: list[Column], name: str = "pos", n_ranges: int | None = None
) -> DataFrame:
    """Add a 1-based bigint position in the total order ``order``.

    Rows that tie on ``order`` get consecutive positions in arbitrary order.
    A hash of the whole row and, for equal rows, the number of the copy are
    appended to the range key, so a hot run of equal keys or equal rows
    spreads over several ranges; both depend on the data alone, so a task
    that runs again repeats them.  Cost: one grouping by row (map-side
    combined), one range shuffle with a local sort, one checkpoint write, and
    a broadcast of one offset row per range.  No single-task window over rows.
    """
    return _numbered(_ranged(df, order, n_ranges), name)


def _ranged(df: DataFrame, order: list[Column], n_ranges: int | None, inside=None) -> DataFrame:
    """The rows in fixed, sorted ranges of ``order``, with ``_id``; ``inside`` works on each sorted range."""
    columns = df.columns
    # One struct as the key: dozens of keys overflow the size of a generated method.
    copies = (
        df.groupBy(F.struct(*columns).alias("_row"))
        .agg(F.count(F.lit(1)).alias("_copies"))
        .select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")).alias("_copy"))
        .select("_row.*", "_copy")
    )
    key = [*order, F.xxhash64(*[F.col(c) for c in columns]), F.col("_copy")]
    rows = _by_range(copies, n_ranges, key).sortWithinPartitions(*key).drop("_copy")
    if inside is not None:
        rows = inside(rows)
    return _fix_ranges(rows.withColumn("_id", F.monotonically_increasing_id()))


def _numbered(ranged: DataFrame, name: str, carried: str | None = None, into: str | None = None) -> DataFrame:
    """Positions of ranged rows; ``into`` of a range's first row becomes ``carried`` of the row before it."""
    rng = F.shiftright("_id", _LOCAL_BITS)
    local = F.col("_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    by_range = Window.orderBy("_rng")
    ends = [F.count(F.lit(1)).alias("_cnt")]
    if carried:
        ends.append(F.max_by(F.struct(F.col(carried).alias("v")), "_id").alias("_last"))
    # One row per range: bounded by the number of ranges, safe to broadcast.
    offsets = ranged.groupBy(rng.alias("_rng")).agg(*ends)
    offsets = offsets.select(
        "_rng",
        F.coalesce(
            F.sum("_cnt").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
        *([F.lag("_last").over(by_range).getField("v").alias("_halo")] if carried else []),
    )
    out = ranged.withColumn("_rng", rng).join(F.broadcast(offsets), "_rng")
    out = out.withColumn(name, (local + F.col("_off") + F.lit(1)).cast("bigint"))
    if carried:
        out = out.withColumn(into, F.when(local == 0, F.col("_halo")).otherwise(F.col(into))).drop("_halo")
    return out.drop("_rng", "_off", "_id")


def with_previous(
    df: DataFrame, order: list[Column], value: str, into: str, name: str = "pos", n_ranges: int | None = None
) -> DataFrame:
    """``with_position``, and in ``into`` the ``value`` of the row before in that order (NULL for the first).

    Each sorted range shifts its own values on the way to the checkpoint; the
    last value of a range goes to the first row of the next with the
    ranges' offsets.  No join of the rows with themselves.
    """
    out = T.StructType([*df.schema.fields, T.StructField(into, df.schema[value].dataType, True)])
    at = df.columns.index(value)

    def shifted(batches):
        last = None
        for b in batches:
            if b.num_rows:
                own = b.column(at)
                moved = pa.concat_arrays([pa.array([last], own.type), own.slice(0, b.num_rows - 1)])
                last = own[b.num_rows - 1].as_py()
                yield pa.RecordBatch.from_arrays([*b.columns, moved], [*b.schema.names, into])

    ranged = _ranged(df, order, n_ranges, lambda rows: rows.mapInArrow(shifted, out))
    return _numbered(ranged, name, value, into)


def _running_counts(batches):
    """Per (key, value, count) row of a sorted range: the key's running count, and the range."""
    rng, last, total = TaskContext.get().partitionId(), None, 0
    for pdf in batches:
        if not len(pdf):
            continue
        keys = pdf["k"].astype(object).where(pdf["k"].notna(), None)
        run = (keys != keys.shift()).cumsum()  # keys are sorted: runs of equal ones
        cum = pdf["c"].groupby(run).cumsum()
        if keys.iloc[0] == last:
            cum = cum.where(run != run.iloc[0], cum + total)
        last, total = keys.iloc[-1], int(cum.iloc[-1])
        yield pdf.assign(cum=cum, rng=rng)


def value_counts(long: DataFrame, key: str, value: str, n_ranges: int | None = None) -> DataFrame:
    """(k, v, c, cum, rng): distinct non-NULL (key, value) pairs in ranges of (key, value).

    ``c`` counts the pair's rows (a map-side partial aggregate, so a value
    held by a third of all rows is one row) and ``cum`` runs over the key's
    pairs of the range, in value order.  Written once: every statistic of the
    column is then a pass over the pairs.
    """
    counted = (
        long.where(F.col(value).isNotNull())
        .groupBy(F.col(key).cast("string").alias("k"), F.col(value).cast("double").alias("v"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    order = [F.col("k"), F.col("v")]
    return _fix_ranges(
        _by_range(counted, n_ranges, order)
        .sortWithinPartitions(*order)
        .mapInPandas(_running_counts, "k string, v double, c long, cum long, rng int")
    )


def exact_quantiles(
    long: DataFrame, key: str, value: str, probs: tuple[float, ...], n_ranges: int | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, per ``key``, NULLs ignored.

    ``long`` has one row per observation: (key, value).  Returns one row per
    key with columns ``q_<i>`` for each probability (i = 0, 1, ...).
    """
    return quantiles_of(value_counts(long, key, value, n_ranges), probs).withColumnRenamed("k", key)


def quantiles_of(pairs: DataFrame, probs: tuple[float, ...]) -> DataFrame:
    """Quantiles per ``k`` of ``value_counts``.

    The running counts plus per-range offsets are cumulative counts; the
    observation at 0-based rank r is the pair whose cumulative interval
    [cum - c, cum) holds r.
    """
    per_range = pairs.groupBy("k", "rng").agg(F.sum("c").alias("_t"))
    offsets = per_range.withColumn(
        "_off",
        F.coalesce(
            F.sum("_t").over(
                Window.partitionBy("k").orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    ).select("k", "rng", "_off")
    totals = per_range.groupBy("k").agg(F.sum("_t").alias("_n"))

    # Target ranks: for probability p, h = (n - 1) * p; interpolate between
    # ranks floor(h) and ceil(h).  One row per (key, prob, side).
    sides = [
        F.struct(F.lit(i).alias("_qi"), h.alias("_h"), F.lit(side).alias("_side"), r.alias("_r"))
        for i, p in enumerate(probs)
        for h in [(F.col("_n") - 1) * F.lit(p)]
        for side, r in enumerate((F.floor(h), F.ceil(h)))
    ]
    targets = totals.select("k", F.explode(F.array(*sides)).alias("_s")).select("k", "_s.*")

    cum = pairs.join(offsets, ["k", "rng"]).select(
        "k", "v", (F.col("cum") + F.col("_off")).alias("_cum"), "c"
    )
    hit = cum.join(
        targets.withColumnRenamed("k", "_k"),
        (F.col("k") == F.col("_k"))
        & (F.col("_r") >= F.col("_cum") - F.col("c"))
        & (F.col("_r") < F.col("_cum")),
    )
    picked = hit.groupBy("k", "_qi", "_h").agg(
        F.max(F.when(F.col("_side") == 0, F.col("v"))).alias("_lo"),
        F.max(F.when(F.col("_side") == 1, F.col("v"))).alias("_hi"),
    )
    q = picked.select(
        "k",
        "_qi",
        (
            F.col("_lo") + (F.col("_h") - F.floor("_h")) * (F.col("_hi") - F.col("_lo"))
        ).alias("_q"),
    )
    return q.groupBy("k").pivot("_qi", list(range(len(probs)))).agg(F.first("_q")).select(
        "k", *[F.col(str(i)).alias(f"q_{i}") for i in range(len(probs))]
    )
