"""Running totals and exact quantiles over an order, without a single-task sort.

``Window.orderBy`` without a partition key sends everything to one task, and partitioning by a
value bucket moves a hot bucket to one task. Here the rows, already reduced to one per distinct
value, are range-partitioned by a sampled order, which balances the slices whatever the
distribution; totals per slice are cumulated (one row per slice), and the cumulated total is
added to a window that never leaves its slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ontime.session import materialize


def running_totals(
    rows: DataFrame, measures: list[str], order: list[Column], by: list[str] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add ``running_<m>`` (this row included) and ``total_<m>`` for every measure.

    ``rows`` must hold one row per position of ``order`` inside each non-null ``by`` group.
    The range-partitioned rows are stored with their slice number: it has to be the same in both
    branches, on retries too.
    """
    by = by or []
    keys = [*[F.col(name) for name in by], *order]
    ranged = rows.repartitionByRange(*([slices] if slices else []), *keys)
    sliced = materialize(ranged.withColumn("_slice", F.spark_partition_id()))
    per_slice = sliced.groupBy(*by, "_slice").agg(*[F.sum(m).alias(m) for m in measures])
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*by)
    starts = per_slice.select(
        *by,
        "_slice",
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_before_{m}") for m in measures],
        *[F.sum(m).over(everything).alias(f"total_{m}") for m in measures],
    )
    inside = (
        Window.partitionBy(*by, "_slice").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = sliced.join(starts, [*by, "_slice"])
    return placed.select(
        *rows.columns,
        *[(F.sum(m).over(inside) + F.col(f"_before_{m}")).alias(f"running_{m}") for m in measures],
        *[f"total_{m}" for m in measures],
    )


def value_counts(data: DataFrame, columns: list[str]) -> DataFrame:
    """Occurrences of each non-null value of several numeric columns: ``(variable, value, n)``.

    One scan; partial aggregation merges equal values before the shuffle.
    """
    numeric = data.select(*[F.col(name).cast("double").alias(name) for name in columns])
    return (
        numeric.unpivot([], list(columns), "variable", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("variable", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def exact_quantiles(
    counts: DataFrame, quantiles: dict[str, float], value: str = "value", weight: str = "n",
    by: list[str] | None = None, interpolate: bool = False,
) -> DataFrame:
    """Exact quantiles of a weighted value table, one row per ``by`` group.

    ``counts`` holds one row per (group, value). Without interpolation the result is the smallest
    value whose cumulated weight reaches the requested share; with it, the usual linear one
    between the two neighbouring elements (the median of an even count is their mean).
    """
    by = by or []
    ranked = running_totals(counts, [weight], [F.col(value)], by)
    last, total = F.col(f"running_{weight}"), F.col(f"total_{weight}")
    first = last - F.col(weight)

    def element(rank: Column) -> Column:
        return F.max(F.when((first < rank) & (rank <= last), F.col(value)))

    picked, finals = [], []
    for name, share in quantiles.items():
        low_value = F.col(f"_low_{name}")
        if not interpolate:
            rank = F.greatest(F.ceil(total * F.lit(share)), F.lit(1))
            picked.append(element(rank).alias(f"_low_{name}"))
            finals.append(low_value.alias(name))
            continue
        position = (total - 1) * F.lit(share)
        picked += [
            element(F.floor(position) + 1).alias(f"_low_{name}"),
            element(F.ceil(position) + 1).alias(f"_high_{name}"),
            F.max(position - F.floor(position)).alias(f"_part_{name}"),
        ]
        step = (F.col(f"_high_{name}") - low_value) * F.col(f"_part_{name}")
        finals.append((low_value + step).alias(name))
    grouped = ranked.groupBy(*by).agg(*picked)
    return grouped.select(*by, *finals)
