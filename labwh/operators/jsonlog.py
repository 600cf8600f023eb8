"""Fields out of JSON payload text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.operators.common import fresh_name, require


def payload(text: Column, unescape: bool = False) -> Column:
    """Drops leading ``[`` so that the first element of an array is read; with ``unescape``
    also removes backslashes."""
    out = F.regexp_replace(text, r"^\s*\[+", "")
    return F.regexp_replace(out, r"\\", "") if unescape else out


def json_field(text: Column, paths: Sequence[str]) -> Column:
    """First non-NULL path; malformed text gives NULL."""
    return F.coalesce(*[F.get_json_object(text, p) for p in paths])


def parsed(text: Column, unescape: bool = False) -> Column:
    """The payload as a variant: an object, or the first element of an array (of arrays); with ``unescape``
    backslashes are removed first. Malformed text gives NULL."""
    whole = F.try_parse_json(F.regexp_replace(text, r"\\", "") if unescape else text)
    # Bound once, as the value is looked at from three sides.
    first = F.transform(
        F.array(whole),
        lambda v: F.coalesce(F.try_variant_get(v, "$[0][0]", "variant"), F.try_variant_get(v, "$[0]", "variant"), v),
    )
    return F.get(first, F.lit(0))


def variant_field(value: Column, paths: Sequence[str]) -> Column:
    """First non-NULL path of a variant, as text."""
    return F.coalesce(*[F.try_variant_get(value, p, "string") for p in paths])


def extract_json(
    df: DataFrame, col: str, fields: Mapping[str, Sequence[str]], unescape: bool = False
) -> DataFrame:
    """Adds one column per field, each read by its first path that gives a value. The text is parsed once per
    row, into a variant that all paths read; malformed text gives NULL in all fields."""
    require(df, [col])
    value = fresh_name(df, "value")
    rows = df.withColumn(value, parsed(F.col(col), unescape))
    return rows.withColumns({n: variant_field(F.col(value), paths) for n, paths in fields.items()}).drop(value)


def counts_by_field(
    df: DataFrame, fields: Mapping[str, object], kind: str, key: str, count: str
) -> DataFrame:
    """Row counts per value of each listed column, stacked with the column's code in ``kind``.
    Each row goes out once per column; one aggregation counts them all. NULL is a value."""
    require(df, list(fields))
    pairs = F.array(*[
        F.struct(F.lit(code).alias("kind"), F.col(c).alias("key")) for c, code in fields.items()
    ])
    long = df.select(F.explode(pairs).alias("p"))
    return long.groupBy(F.col("p.kind").alias(kind), F.col("p.key").alias(key)).agg(
        F.count("*").alias(count)
    )
