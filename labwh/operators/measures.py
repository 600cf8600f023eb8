"""Conditional counts, bands, shares, totals beside rows, label lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labwh.functions.numbers import proportion
from labwh.operators.common import fresh_name, require


def count_if(cond: Column) -> Column:
    """Rows that meet the condition; 0, not NULL, when none does."""
    return F.count(F.when(cond, 1))


def sum_if(cond: Column, measure: Column | str) -> Column:
    """Sum over rows that meet the condition; 0, not NULL, when none does."""
    m = F.col(measure) if isinstance(measure, str) else measure
    return F.coalesce(F.sum(F.when(cond, m)), F.lit(0))


def conditional_measures(
    df: DataFrame, by: Sequence[str], measures: Mapping[str, tuple[Column, Column | str | None]]
) -> DataFrame:
    """Per group one column per (condition, measure); measure None counts rows."""
    require(df, by)
    return df.groupBy(*by).agg(*measure_columns(measures))


def measure_columns(
    measures: Mapping[str, tuple[Column, Column | str | None]],
) -> list[Column]:
    return [
        (count_if(cond) if m is None else sum_if(cond, m)).alias(name)
        for name, (cond, m) in measures.items()
    ]


def band_columns(value: Column | str, edges: Sequence[float], prefix: str) -> dict[str, Column]:
    """Counts in half-open bands [lo, hi); the last band is open above. Values below the
    first edge, and NULL, are counted nowhere."""
    v = F.col(value) if isinstance(value, str) else value
    out = {}
    for i, lo in enumerate(edges):
        if i + 1 < len(edges):
            hi = edges[i + 1]
            out[f"{prefix}_{lo}_{hi}"] = count_if((v >= lo) & (v < hi))
        else:
            out[f"{prefix}_{lo}_up"] = count_if(v >= lo)
    return out


def split_amounts(
    amount: Column | str, kind: Column | str, names: Mapping[object, str]
) -> list[Column]:
    """One amount column per owner kind."""
    k = F.col(kind) if isinstance(kind, str) else kind
    return [sum_if(k == value, amount).alias(name) for value, name in names.items()]


def with_shares(
    df: DataFrame, parts: Mapping[str, str], total: str, as_text: bool = False
) -> DataFrame:
    """Adds ``{output: part column}`` shares of ``total`` in percent."""
    require(df, [*parts.values(), total])
    return df.withColumns({out: proportion(c, total, as_text) for out, c in parts.items()})


def attach_totals(df: DataFrame, *totals: DataFrame) -> DataFrame:
    """Every row of ``df`` gets the columns of one-row frames.

    Each frame is a scalar subquery: Spark runs it once and puts its single row into the
    plan as a constant, so there is neither a join nor a window over the whole input. A
    frame with more than one row fails at run time.
    """
    for t in totals:
        box = fresh_name(df, "totals")
        row = t.select(F.struct(*t.columns)).scalar()
        fields = [F.col(f"{box}.{c}").alias(c) for c in t.columns]
        df = df.withColumn(box, row).select(*df.columns, *fields)
    return df


def one_row(spark_df: DataFrame, *totals: DataFrame) -> DataFrame:
    """Global aggregates of several frames side by side in one row."""
    return attach_totals(spark_df, *totals)


def running_total(
    df: DataFrame, order: Sequence[str], value: str, name: str, by: Sequence[str] = ()
) -> DataFrame:
    """Cumulative sum in period order. ``df`` holds one row per period (and ``by`` key), so
    a window task gets as many rows as there are periods."""
    require(df, [*order, value, *by])
    w = Window.partitionBy(*by).orderBy(*order)
    w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(w))


def unpivot_metrics(
    df: DataFrame, ids: Sequence[str], metrics: Mapping[object, str], kind: str, value: str
) -> DataFrame:
    """Wide to long: one row per (ids, metric code)."""
    require(df, [*ids, *metrics.values()])
    codes = F.create_map(*[x for code, c in metrics.items() for x in (F.lit(c), F.lit(code))])
    name = fresh_name(df, "metric")
    long = df.unpivot(list(ids), list(metrics.values()), name, value)
    return long.select(*ids, codes[F.col(name)].alias(kind), value)


def label_list(
    labels: Mapping[str, tuple[Column, Column | str]], sep: str = ","
) -> list[Column]:
    """Aggregates ``{output: (condition, label)}``: the distinct labels that meet the
    condition, sorted and joined. NULL labels are skipped; no match gives ''.

    Partial aggregation keeps one copy per distinct label, so the size of a result cell is
    set by the number of distinct labels, not by the number of rows.
    """
    out = []
    for name, (cond, label) in labels.items():
        c = F.col(label) if isinstance(label, str) else label
        found = F.sort_array(F.collect_set(F.when(cond, c)))
        out.append(F.array_join(found, sep).alias(name))
    return out
