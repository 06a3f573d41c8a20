"""Running sums over a total order of any length, by cells of leading bits.

A window without partitions would pull all rows into one task. Here a number is
turned into a 64-bit key that sorts as the number does; its leading 16 bits name a
large cell and its leading 32 bits a small one. Cell totals are summed up first
(65,536 large cells at most, and as many small ones in each), and a row adds what
lies before it in its small cell. Cells depend on the value alone, so nothing is
sampled. The rows are written once as a table of the shared folder, because three
sums read them and their input may be costly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.operators.small import join_groups
from ebbtide.session import staged

_MANTISSA = 1 << 52


def with_order_key(df: DataFrame, value: str, name: str = "_key") -> DataFrame:
    """Add a long that sorts as the double ``value`` does: sign, exponent, mantissa.

    Powers of two and divisions by them are exact, and the exponent taken from the
    logarithm is put right by comparing; 0 and -0 are alike, NaN comes last. The
    steps are columns of their own, which keeps the generated code small.
    """
    x, size, e, part = (F.col(f"{name}_{c}") for c in ("x", "size", "e", "part"))
    two, least = F.lit(2.0), F.lit(-1022.0)
    steps = {
        "x": F.col(value).cast("double"),
        # What has no exponent is put in its place at the end.
        "size": F.when((x != 0) & (F.abs(x) < float("inf")), F.abs(x)).otherwise(F.lit(1.0)),
        "near": F.greatest(F.floor(F.log2(size)).cast("double"), least),
        "e": F.greatest(F.col(f"{name}_near") + (F.pow(two, F.col(f"{name}_near") + 1) <= size).cast("int") - (F.pow(two, F.col(f"{name}_near")) > size).cast("int"), least),
        "part": size / F.pow(two, e),
        # Below the smallest normal number the exponent's place holds 0.
        "bits": F.when(part < 1, (part * _MANTISSA).cast("long")).otherwise(((part - 1) * _MANTISSA).cast("long") + (e + 1023).cast("long") * _MANTISSA),
    }
    out = df
    for step, column in steps.items():
        out = out.withColumn(f"{name}_{step}", column)
    bits = F.when(x == 0, F.lit(0).cast("long")).when(F.abs(x) == float("inf"), F.lit(2047 * _MANTISSA)).otherwise(F.col(f"{name}_bits"))
    signed = F.when(F.isnan(x), F.lit((1 << 63) - 1)).when(x < 0, -bits).otherwise(bits)
    return out.withColumn(name, signed).drop(*[f"{name}_{step}" for step in steps])


def running_sums(
    df: DataFrame,
    order: str,
    counts: Sequence[str],
    within: Sequence[str] = (),
    descending: bool = False,
    following: bool = False,
) -> DataFrame:
    """Add ``<c>_upto`` for every count, its sum over this and all earlier rows,
    and ``<c>_total``, its sum over all rows; ``following`` also adds
    ``<c>_next``, the count of the next row, NULL for the last.

    ``order`` is numeric, without NULLs, and must be unique within ``within``
    (combine equal values first), so that no value can be heavy. With ``within``
    the sums start anew for each combination of those columns. The rows move once,
    to their small cells.
    """
    keyed = with_order_key(df, order)
    keyed = keyed.withColumn("_key", F.bitwise_not("_key")) if descending else keyed
    rows = keyed.withColumns({"_large": F.shiftright("_key", 48), "_small": F.shiftright("_key", 32)})
    rows = staged(rows, "ordered")
    head = F.min(F.struct("_key", *counts)).alias("_head")
    sums = [F.sum(c).alias(f"_{c}") for c in counts]
    small = rows.groupBy(*within, "_large", "_small").agg(*sums, head)
    large = small.groupBy(*within, "_large").agg(*[F.sum(f"_{c}").alias(f"_{c}") for c in counts], F.min("_head").alias("_head"))

    def before(cells: DataFrame, keys: Sequence[str], cell: str, *more: Column) -> DataFrame:
        upto = Window.partitionBy(*keys).orderBy(cell)
        return cells.select(
            *keys,
            cell,
            *[(F.sum(f"_{c}").over(upto) - F.col(f"_{c}")).alias(f"{cell}_{c}") for c in counts],
            F.lead("_head").over(upto).alias(f"{cell}_head"),
            *more,
        )

    whole = [F.sum(f"_{c}").over(Window.partitionBy(*within)).alias(f"{c}_total") for c in counts]
    outer = before(large, within, "_large", *whole)
    inner = before(small, [*within, "_large"], "_small")
    cells = join_groups(inner, outer, within, plain=["_large"])
    inside = Window.partitionBy(*within, "_large", "_small").orderBy("_key")
    summed = rows.withColumns({f"{c}_upto": F.sum(c).over(inside) for c in counts})
    if following:
        summed = summed.withColumn("_row_head", F.lead(F.struct("_key", *counts)).over(inside))
    out = join_groups(summed, cells, within, plain=["_large", "_small"])
    out = out.withColumns({f"{c}_upto": F.col(f"{c}_upto") + F.col(f"_small_{c}") + F.col(f"_large_{c}") for c in counts})
    if following:
        after = F.coalesce("_row_head", "_small_head", "_large_head")
        out = out.withColumns({f"{c}_next": after[c] for c in counts})
    added = [f"{c}_{end}" for c in counts for end in ("upto", "total", *(["next"] if following else []))]
    return out.select(*df.columns, *added)
