"""Row-order operators that stay balanced when one group is huge.

A ``Window.partitionBy(g)`` puts a whole group into one task. The helpers
here split a group into slices first and stitch the slices together with a
small per-slice table, so a group holding a third of all rows is spread over
many tasks:

* ``row_numbers``  - dense 1..n numbering per group (W5),
* ``forward_fill`` - last non-null value so far, per group (W1),
* ``look_ahead``   - value of the next 1..k rows, per group (W2, W3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_ROWS = 100_000


def _rank_in(sorted_keys: str, key: Column) -> Column:
    """How many of the sorted keys are at most ``key`` (binary search)."""
    n = F.coalesce(F.size(sorted_keys), F.lit(0))
    none = F.struct(F.lit(0).alias("lo"), n.alias("hi"))

    def step(at, _):
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        below = F.get(sorted_keys, mid) <= key
        return (F.when(at["lo"] >= at["hi"], at)
                .when(below, F.struct((mid + 1).alias("lo"), at["hi"].alias("hi")))
                .otherwise(F.struct(at["lo"].alias("lo"), mid.alias("hi"))))

    steps = F.sequence(F.lit(1), F.ceil(F.log2(n + 1)).cast("int"))
    return F.when(n > 0, F.aggregate(steps, none, step)["lo"]).otherwise(F.lit(0))


def row_numbers(df: DataFrame, part: list[str], order: list[str], name: str = "ROW_NO",
                slice_rows: int = SLICE_ROWS, bounds_of: DataFrame | None = None) -> DataFrame:
    """1..n per ``part`` in ``order`` (which must be unique within ``part``).

    About one row in ``slice_rows``, picked by a hash of its keys, bounds a
    slice of its group; a row's slice is the number of bounds not above it, so
    it is a function of the row and the data alone: nothing runs while the plan
    is built, and a recomputed task finds the same slices. Slices number their
    own rows; the counts of the slices before are added. Groups without a bound
    (nearly all of fewer rows than ``slice_rows``) are one slice and take no
    part in the counts. ``bounds_of``: a table with the same keys that is cheaper
    to compute (the rows before a join, say) and holds the bounds as well.
    """
    keys = [f"_k{i}" for i in range(len(part))]
    bound = (df if bounds_of is None else bounds_of).where(F.pmod(F.xxhash64(*part, *order), F.lit(slice_rows)) == 0)
    bounds = bound.groupBy(*[F.col(c).alias(k) for c, k in zip(part, keys)]).agg(
        F.array_sort(F.collect_set(F.struct(*order))).alias("_b"))
    # null-safe on the group keys: rows without a key are a group of their own
    same = F.lit(True)
    for c, k in zip(part, keys):
        same = same & F.col(c).eqNullSafe(F.col(k))

    def sliced(how):
        return df.join(bounds, same, how).withColumn("_sl", _rank_in("_b", F.struct(*order)))

    local = sliced("left").drop("_b", *keys).withColumn(
        "_local", F.row_number().over(Window.partitionBy("_sl", *part).orderBy(*order)))
    before = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced("inner").groupBy(*keys, F.col("_sl").alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.withColumn("_off", F.sum("_n").over(before)).where(F.col("_off") > 0).drop("_n")
    out = local.join(offsets, _same_slice(part), "left").drop("_s", *keys)
    return out.withColumn(name, (F.col("_local") + F.coalesce("_off", F.lit(0))).cast("int")).drop("_sl", "_local", "_off")


def _same_slice(keys: list[str]) -> Column:
    """Null-safe equality of (keys, _sl) with a slice table's (_k0.., _s)."""
    same = F.col("_sl").eqNullSafe(F.col("_s"))
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return same


def sliced(df: DataFrame, part: list[str], order: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The rows shuffled by (group, slice of ``slice_rows`` order values): the
    group's columns packed in ``_key`` (a struct, so null equals null), the slice
    in ``_sl``. Helpers on sliced rows (``fill_sliced``, ``look_ahead_sliced``)
    leave them where they are: per-slice tables come to the rows. Those tables
    start from the same shuffle and carry every column, so that Spark finds the
    two equal."""
    rows = df.select(F.struct(*part).alias("_key"), F.floor(F.col(order) / F.lit(slice_rows)).alias("_sl"),
                     *[F.col(f"`{c}`") for c in df.columns if c not in part])
    return rows.repartition("_key", "_sl")


def unsliced(data: DataFrame, columns: list[str]) -> DataFrame:
    """Sliced rows with the group's columns back in their places among ``columns``."""
    return data.select(*[F.col(f"`{c}`") if c in data.columns else F.col("_key")[c].alias(c) for c in columns])


def forward_fill(df: DataFrame, part: str | list[str], order: str, cols: list[str],
                 slice_rows: int = SLICE_ROWS) -> DataFrame:
    """pandas ``ffill`` per group: null takes the last non-null value before it.

    Rows are cut into slices of ``slice_rows`` consecutive order values. Each
    slice fills itself (window keyed by (group, slice)); the last value of every
    slice forms a one-row-per-slice table, whose running last value is carried
    into the next slices. The input is read and shuffled once.
    """
    keys = [part] if isinstance(part, str) else list(part)
    return unsliced(fill_sliced(sliced(df, keys, order, slice_rows), order, cols), df.columns)


def fill_sliced(data: DataFrame, order: str, cols: list[str]) -> DataFrame:
    """``forward_fill`` of rows that ``sliced`` made."""
    inside = Window.partitionBy("_key", "_sl").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = data.withColumns({f"_f_{c}": F.last(c, ignorenulls=True).over(inside) for c in cols})
    row = F.struct(*[F.col(f"`{c}`") for c in data.columns])
    tails = data.groupBy("_key", "_sl").agg(*[
        F.max_by(row, F.when(F.col(f"`{c}`").isNotNull(), F.col(order)))[c].alias(f"_t_{c}") for c in cols])
    prev = Window.partitionBy("_key").orderBy("_sl").rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select("_key", "_sl", *[F.last(f"_t_{c}", ignorenulls=True).over(prev).alias(f"_c_{c}") for c in cols])
    # only slices that actually receive a value are joined back: one-slice
    # groups (the usual case) drop out, and the join side stays small
    has_carry = F.lit(False)
    for c in cols:
        has_carry = has_carry | F.col(f"_c_{c}").isNotNull()
    out = filled.join(carry.where(has_carry), ["_key", "_sl"], "left")
    return out.withColumns({c: F.coalesce(F.col(f"_f_{c}"), F.col(f"_c_{c}")) for c in cols}).select(
        *[F.col(f"`{c}`") for c in data.columns])


def look_ahead(df: DataFrame, part: str | list[str], row_no: str, value: Column | str, steps: int,
               prefix: str = "NEXT", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``<prefix>1..<prefix>k`` = value of the row 1..k places further on.

    Rows are ordered by ``row_no`` within ``part`` (gaps allowed; rows that
    share a number all stay, in any order among themselves). They are cut into
    slices of ``slice_rows`` consecutive numbers; a window keyed by (part,
    slice) answers every row but the last k of a slice, and those take the
    first k values of the following slices from a one-row-per-slice table. The
    input is read and shuffled once.
    """
    keys = [part] if isinstance(part, str) else list(part)
    data = df.withColumn("_v", F.struct((F.col(value) if isinstance(value, str) else value).alias("v")))
    data = look_ahead_sliced(sliced(data, keys, row_no, slice_rows), row_no, F.col("_v")["v"], steps, prefix)
    return unsliced(data, [*df.columns, *[f"{prefix}{k}" for k in range(1, steps + 1)]])


def look_ahead_sliced(data: DataFrame, row_no: str, value: Column | str, steps: int, prefix: str = "NEXT") -> DataFrame:
    """``look_ahead`` of rows that ``sliced`` made."""
    columns = [F.col(f"`{c}`") for c in data.columns]
    row = F.struct(*columns, F.struct((F.col(value) if isinstance(value, str) else value).alias("v")).alias("_w"))
    order = Window.partitionBy("_key", "_sl").orderBy(row_no)
    # a lead that is null lies beyond the slice (a null value is a struct that holds null)
    leads = [f"_l{k}" for k in range(1, steps + 1)]
    inside = data.withColumns({name: F.lead(row["_w"], k).over(order) for k, name in enumerate(leads, 1)})
    heads = data.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= steps).groupBy("_key", "_sl").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rn", row.alias("r")))), lambda x: x["r"]["_w"]).alias("_h"))
    after = Window.partitionBy("_key").orderBy("_sl").rowsBetween(1, steps)
    carry = heads.select("_key", "_sl", F.slice(F.flatten(F.collect_list("_h").over(after)), 1, steps).alias("_c"))
    # one-slice groups (the usual case) take nothing over
    out = inside.join(carry.where(F.size("_c") > 0), ["_key", "_sl"], "left")
    left = sum((F.col(name).isNotNull().cast("int") for name in leads), F.lit(0))  # rows left in the slice, k at most
    return out.withColumn("_left", left).select(*columns, *[
        F.when(F.col(name).isNotNull(), F.col(name)["v"])
        .otherwise(F.get("_c", F.lit(k - 1) - F.col("_left"))["v"]).alias(f"{prefix}{k}")
        for k, name in enumerate(leads, 1)])
