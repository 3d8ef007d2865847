"""Ordered computations over groups of any size.

A plain ``Window.partitionBy(zone)`` sends a whole zone to one task. Here a zone is cut into consecutive slices of its
leading order column; windows run inside a slice, and what a slice needs from the rows before (or after) it travels as
one small summary row per slice. The slice width comes from one aggregated probe of the busiest slice, so small data
ends up with a single slice per key (the plain window) and a hot key is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "__slice"
POSITION = "__position"
ROWS_PER_SLICE = 1_000_000
DAY_SECONDS = 86_400


def order_number(df: DataFrame, name: str) -> Column:
    """The leading order column as a whole number that never decreases along the order."""
    kind = dict(df.dtypes)[name]
    if kind == "timestamp_ntz":
        return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    if kind == "timestamp":
        return F.unix_seconds(F.col(name))
    if kind == "date":
        return F.datediff(F.col(name), F.lit("1970-01-01").cast("date")).cast("long") * DAY_SECONDS
    return F.floor(F.col(name)).cast("long")


def newest(values: Column, depth: int) -> Column:
    """Last ``depth`` entries of an array, or all of a shorter one."""
    return F.slice(values, F.greatest(F.size(values) - depth, F.lit(0)) + 1, F.lit(depth))


def slice_width(df: DataFrame, keys: list[str], lead: str, rows_per_slice: int = ROWS_PER_SLICE) -> int:
    """Width that keeps the busiest slice near ``rows_per_slice``; one job that returns a single number."""
    bucket = F.floor(order_number(df, lead) / DAY_SECONDS)
    busiest = (
        df.groupBy(*keys, bucket.alias(SLICE)).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    ) or 1
    return max(1, DAY_SECONDS * rows_per_slice // busiest)


class Slices:
    """``df`` cut into slices per ``keys`` along ``order`` (leading column first, then tie-breaks)."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], width: int | None = None):
        self.keys, self.order = list(keys), list(order)
        self.width = width or slice_width(df, self.keys, self.order[0])
        number = order_number(df, self.order[0])
        at = F.floor(number / F.lit(self.width)).cast("long")
        # rows without a leading value come first and are ordered by the next column alone, so that one cuts them
        first = F.lit(-(1 << 62))
        if len(self.order) > 1 and dict(df.dtypes)[self.order[1]] in ("bigint", "int"):
            first = first + F.coalesce(F.floor(F.col(self.order[1]) / ROWS_PER_SLICE).cast("long"), F.lit(-(1 << 60)))
        self.df = df.withColumn(SLICE, F.coalesce(at, first))
        self.group = [*self.keys, SLICE]
        self.rank = F.struct(*self.order)

    @property
    def local(self):
        return Window.partitionBy(*self.group).orderBy(*self.order)

    @property
    def across(self):
        """Over the slice summaries of one key: as many rows as there are slices, never as many as there are rows."""
        return Window.partitionBy(*self.keys).orderBy(SLICE)

    @property
    def local_back(self):
        """Latest row first: looking ahead is looking back in this order, which Spark evaluates in one sweep."""
        return Window.partitionBy(*self.group).orderBy(*[F.col(c).desc() for c in self.order])

    @property
    def across_back(self):
        return Window.partitionBy(*self.keys).orderBy(F.col(SLICE).desc())

    def summary(self, **measures: Column) -> DataFrame:
        return self.df.groupBy(*self.group).agg(*[c.alias(n) for n, c in measures.items()])

    def attach(self, summary: DataFrame) -> DataFrame:
        """Equi-join on the partitioning the local windows already use. Rows with a null key find no summary."""
        return self.df.join(summary, self.group, "left")

    def tails(self, values: dict[str, Column], depth: int) -> DataFrame:
        """For each slice the last ``depth`` rows before it, oldest first, as array ``carry``."""
        narrow = self.df.select(*self.group, *[c for c in self.order if c not in self.group], *[c.alias(n) for n, c in values.items()])
        entry = F.struct(*self.order, *[F.col(n).alias(f"v_{n}") for n in values])
        last = (
            narrow.withColumn("__back", F.row_number().over(self.local_back))
            .filter(F.col("__back") <= depth)
            .groupBy(*self.group)
            .agg(F.sort_array(F.collect_list(entry)).alias("tail"))
        )
        earlier = F.collect_list("tail").over(self.across.rowsBetween(-depth, -1))
        gathered = last.select(*self.group, earlier.alias("carry"))
        return gathered.withColumn("carry", newest(F.flatten("carry"), depth))

    def lags(self, columns: dict[str, tuple[Column, int]]) -> DataFrame:
        """Add one column per entry: name -> (value, offset). Null key gives null."""
        values = {n: c for n, (c, _) in columns.items()}
        depth = max(k for _, k in columns.values())
        joined = self.attach(self.tails(values, depth))
        joined = joined.withColumn(POSITION, F.row_number().over(self.local))
        added = {}
        for name, (value, k) in columns.items():
            at = F.size("carry") - (F.lit(k) - F.col(POSITION))
            carried = F.when(at >= 1, F.try_element_at(F.col("carry"), at)[f"v_{name}"])
            added[name] = F.when(F.col(POSITION) > k, F.lag(value, k).over(self.local)).otherwise(carried)
        out = joined.withColumns({n: self._keyed(c) for n, c in added.items()})
        return out.drop(SLICE, POSITION, "carry")

    def previous_rows(self, value: Column, depth: int, into: str) -> DataFrame:
        """Array ``into`` of the ``depth`` values before each row, oldest first; shorter at the start of a key."""
        joined = self.attach(self.tails({"value": value}, depth))
        joined = joined.withColumn(POSITION, F.row_number().over(self.local))
        here = F.collect_list(F.struct(value.alias("v"))).over(self.local.rowsBetween(-depth, -1))
        carried = F.transform(F.coalesce("carry", F.expr("array()")), lambda e: F.struct(e["v_value"].alias("v")))
        joined = joined.withColumn("__here", here)
        both = F.when(F.col(POSITION) > depth, F.col("__here")).otherwise(newest(F.concat(carried, "__here"), depth))
        out = joined.withColumn(into, self._keyed(F.transform(both, lambda e: e["v"])))
        return out.drop(SLICE, POSITION, "carry", "__here")

    def fill(self, columns: list[str], forward: bool = True) -> DataFrame:
        """Last (or next) non-null value of each column within its key, the row itself included."""
        pick = F.max_by if forward else F.min_by
        summary = self.summary(**{f"__{c}": pick(F.col(c), F.when(F.col(c).isNotNull(), self.rank)) for c in columns})
        across, local = (self.across, self.local) if forward else (self.across_back, self.local_back)
        frame, inside = across.rowsBetween(Window.unboundedPreceding, -1), local.rowsBetween(Window.unboundedPreceding, 0)
        summary = summary.select(*self.group, *[F.last(f"__{c}", ignorenulls=True).over(frame).alias(f"__{c}") for c in columns])
        joined = self.attach(summary)
        filled = {c: self._keyed(F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"__{c}"))) for c in columns}
        return joined.withColumns(filled).drop(SLICE, *[f"__{c}" for c in columns])

    def numbered(self, into: str, total: str | None = None) -> DataFrame:
        """1-based position of every row within its key and, on request, the number of rows of the key."""
        counts = self.summary(__n=F.count(F.lit(1)))
        before = F.coalesce(F.sum("__n").over(self.across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        whole = F.sum("__n").over(Window.partitionBy(*self.keys))
        counts = counts.select(*self.group, before.alias("__before"), whole.alias("__whole"))
        joined = self.attach(counts)
        out = joined.withColumn(into, (F.col("__before") + F.row_number().over(self.local)).cast("long"))
        if total:
            out = out.withColumn(total, F.col("__whole").cast("long"))
        return out.drop(SLICE, "__before", "__whole")

    def _keyed(self, value: Column) -> Column:
        for key in self.keys:
            value = F.when(F.col(key).isNotNull(), value)
        return value
