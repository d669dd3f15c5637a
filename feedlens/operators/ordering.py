"""Order-dependent helpers that stay distributed.

A window with ``orderBy`` and no ``partitionBy`` runs in a single task. Where a
global running total is needed (rank sums in Mann-Whitney), the rows are cut
into value ranges instead: each range gets its local running total in its own
task, and a table with one offset per range (its size is the range count, a
parameter) is broadcast back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Default number of value ranges: a comparison tree of depth 6 in generated code.
# Any number gives the same result; it sets the number of tasks.
RANGES = 64


def _range_index(col: Column, cuts: list[float]) -> Column:
    """Index of the range holding col: the number of cuts <= col (a balanced
    comparison tree, so it stays a plain codegen expression)."""
    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(col < F.lit(cuts[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))
    return build(0, len(cuts))


def materialize(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` to the session's checkpoint folder (shared storage on
    a cluster) for operators that read their input twice: the upstream plan
    runs once, and the lineage is cut. Use on aggregated, small inputs."""
    from feedlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _cuts(df: DataFrame, order_col: str, ranges: int, relative_error: float) -> list[float]:
    if ranges < 2:
        return []
    qs = df.approxQuantile(order_col, [i / ranges for i in range(1, ranges)], relative_error)
    return sorted(set(q for q in qs if q is not None))


def row_index(df: DataFrame, group_col: str, order_col: str, out_col: str, ranges: int = RANGES,
              relative_error: float = 0.001) -> DataFrame:
    """Add ``out_col``: 0, 1, 2 ... by the numeric ``order_col`` (unique in a
    group) within each group, without bringing a group into one task. The
    input is read twice; pass a materialized table. The offsets table has one
    row per group and range."""
    ranged = df.withColumn("_range", _range_index(F.col(order_col), _cuts(df, order_col, ranges, relative_error)))
    local = ranged.withColumn("_local", F.row_number().over(
        Window.partitionBy(group_col, "_range").orderBy(order_col)) - 1)
    before = (Window.partitionBy(group_col).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (ranged.groupBy(group_col, "_range").agg(F.count(F.lit(1)).alias("_n"))
               .select(group_col, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    return (local.join(F.broadcast(offsets), [group_col, "_range"])
            .withColumn(out_col, F.col("_local") + F.col("_off")).drop("_range", "_local", "_off"))


def running_total(df: DataFrame, order_col: str, sum_col: str, out_col: str,
                  ranges: int | None = RANGES, relative_error: float = 0.001,
                  checkpoint: bool = True) -> DataFrame:
    """Add ``out_col`` = sum of ``sum_col`` over all rows whose ``order_col`` is
    <= this row's (ties are included together, so the result is deterministic).

    Range cuts come from ``approxQuantile`` (a small driver-side list of at most
    ``ranges - 1`` numbers); any cuts give the same exact result, they only
    decide the balance between tasks. The input is read twice (cuts, then the
    sums), so it is checkpointed first unless ``checkpoint`` is False.
    """
    if checkpoint:
        df = materialize(df)
    cuts = _cuts(df, order_col, ranges or RANGES, relative_error)
    ranged = df.withColumn("_range", _range_index(F.col(order_col), cuts))
    local_w = (Window.partitionBy("_range").orderBy(order_col)
               .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumn("_local", F.sum(sum_col).over(local_w))
    # One row per range: bounded by the `ranges` parameter.
    offsets = (ranged.groupBy("_range").agg(F.sum(sum_col).alias("_tot"))
               .withColumn("_off", F.coalesce(
                   F.sum("_tot").over(Window.orderBy("_range")
                                      .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .select("_range", "_off"))
    return (local.join(F.broadcast(offsets), "_range")
            .withColumn(out_col, F.col("_local") + F.col("_off"))
            .drop("_range", "_local", "_off"))
