"""Running values over long orders, slice by slice.

A book may hold a third of all events, so no window goes over a whole book. Its order is cut into slices of fixed width;
each gives its totals, a scan over the few totals of a book gives what came before each slice, and values run on from
there inside it. A slice is one task's work at most, whatever the book.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Width of a slice as a power of two: of row and sequence numbers, and of times in milliseconds (17 minutes).
NUMBERS, TIMES = 16, 20


@dataclass(frozen=True)
class Running:
    """A running sum, count, max, min or last (of what is not null) of a value, with the row itself or (before) up to the row before."""

    kind: str
    value: Column
    before: bool = False

    def over(self, window) -> Column:
        bounds = window.rowsBetween(W.unboundedPreceding, -1 if self.before else 0)
        return (F.last(self.value, ignorenulls=True) if self.kind == "last" else getattr(F, self.kind)(self.value)).over(bounds)

    def total(self, order: Column) -> Column:
        return F.max_by(self.value, F.when(self.value.isNotNull(), order)) if self.kind == "last" else getattr(F, self.kind)(self.value)

    def scanned(self, total: str, window) -> Column:
        """What the slices before a slice come to."""
        earlier = window.rowsBetween(W.unboundedPreceding, -1)
        kind = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}.get(self.kind)
        return (F.last(total, ignorenulls=True) if kind is None else kind(total)).over(earlier)

    def joined(self, here: Column, earlier: Column) -> Column:
        if self.kind in ("sum", "count"):
            return F.coalesce(earlier + here, here, earlier)
        return F.coalesce(here, earlier) if self.kind == "last" else {"max": F.greatest, "min": F.least}[self.kind](here, earlier)


def running(rows: DataFrame, keys: list[str], order: str, columns: dict[str, Running], ties: list[str] | None = None, bits: int | None = None) -> DataFrame:
    """rows with the running values of columns, per keys (never null) in the order of a bigint column, ties among equal ones.

    rows are read twice, so they should be written ones. One exchange by (keys, slice) serves the values, and one by keys
    the scan, which sees a row per slice.
    """
    each = [*keys, "__slice"]
    cut = rows.withColumn("__slice", F.shiftright(order, NUMBERS if bits is None else bits))
    w = W.partitionBy(*each).orderBy(order, *(ties or []))
    here = cut.withColumns({f"__h_{n}": c.over(w) for n, c in columns.items()})
    last = F.struct(order, *ties) if ties else F.col(order)  # a bare number, where it tells rows apart, is aggregated by hash
    totals = cut.groupBy(*each).agg(*(c.total(last).alias(n) for n, c in columns.items()))
    by_slice = W.partitionBy(*keys).orderBy("__slice")
    earlier = totals.select(*each, *(c.scanned(n, by_slice).alias(f"__e_{n}") for n, c in columns.items()))
    both = here.join(earlier, each)
    kinds = {n: here.schema[f"__h_{n}"].dataType for n in columns}
    return both.select(*rows.columns, *(c.joined(F.col(f"__h_{n}"), F.col(f"__e_{n}")).cast(kinds[n]).alias(n) for n, c in columns.items()))
