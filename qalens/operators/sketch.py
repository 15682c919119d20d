"""Top-k of grouped sums without shuffling a row for every key.

A count-min sketch (``DEPTH`` rows of ``WIDTH`` counters, each key adding its measure to one
counter a row) is an ordinary grouped sum: every task sends at most ``DEPTH x WIDTH`` partial
sums, however many keys it saw. For measures that are never negative a key's least counter
bounds its sum from above. The exact sums of the keys in the heaviest counters give a lower
bound for the k-th place; only keys whose bound reaches it can be among the first k, and only
their rows are grouped exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from qalens.operators._util import as_col

#: Rows and counters of the sketch: what a task sends, the driver collects and tasks get back
#: is bounded by these, whatever the data.
DEPTH, WIDTH = 2, 1 << 14
#: Counters per sought key that are opened first.
FIRST_GUESS = 4


@dataclass(frozen=True)
class Pruned:
    """``rows``: the fact rows that can matter; ``pruned``: whether any were left out, or why not."""

    rows: DataFrame
    pruned: bool
    reason: str


def _counter(key: Column, row: int, width: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(row)), F.lit(width)).cast("int")


def _reaching(rows: DataFrame, counters: dict[int, dict[int, int]], bound: int, depth: int, width: int) -> DataFrame:
    """The rows whose key may sum to ``bound`` or more: all its counters do."""
    for row in range(depth):
        heavy = [c for c, s in counters[row].items() if s >= bound]
        if len(heavy) == len(counters[row]):
            continue
        words = [0] * (width // 64)  # one bit a counter
        for c in heavy:
            words[c // 64] |= 1 << (c % 64)
        bits = F.array(*[F.lit(w - (1 << 64) if w >> 63 else w).cast("bigint") for w in words])
        counter = _counter(F.col("__key"), row, width)
        rows = rows.where(F.getbit(F.element_at(bits, F.shiftright(counter, 6) + 1), counter % 64) == 1)
    return rows


def prune_for_top_k(
    fact: DataFrame,
    key: str | Column,
    measure: str | Column,
    k: int,
    *,
    eligible: Callable[[DataFrame, str], DataFrame] | None = None,
    depth: int = DEPTH,
    width: int = WIDTH,
) -> Pruned:
    """The rows of ``fact`` whose key can be among the ``k`` largest sums of ``measure``.

    Grouping, joining and ranking these rows gives the same first k (ties with the k-th place
    included) as doing it with all of them. ``eligible(sums, key)`` drops the sums of keys that
    will not be ranked (such as those without a parent row); by default every key counts.

    All rows are kept, and ``reason`` says why, if the measure is not an exact number, holds
    negative values, or fewer than k keys have a sum. Two or three scans of the key and the
    measure run at once; what they send is described in the module.
    """
    rows = fact.withColumn("__key", as_col(key)).withColumn("__measure", as_col(measure))
    slim = rows.select("__key", "__measure")
    kind = slim.schema["__measure"].dataType
    if not isinstance(kind, (IntegralType, DecimalType)):
        return Pruned(fact, False, "the measure is not an exact number")
    cells = F.explode(F.array(*[F.struct(F.lit(r).alias("row"), _counter(F.col("__key"), r, width).alias("counter")) for r in range(depth)]))
    sketch = slim.where("__measure IS NOT NULL").select(cells.alias("c"), "__measure").groupBy("c.row", "c.counter")
    cell_sums = sketch.agg(F.sum("__measure").alias("s"), F.min("__measure").alias("least")).collect()
    if any(c.least < 0 for c in cell_sums):
        return Pruned(fact, False, "the measure has negative values")
    counters: dict[int, dict[int, int]] = {r: {} for r in range(depth)}
    for c in cell_sums:
        counters[c.row][c.counter] = c.s
    if not cell_sums:
        return Pruned(fact, False, "no key has a sum")

    def kth(bound) -> int | None:
        """The k-th largest exact sum among the keys whose counters reach the bound."""
        sums = _reaching(slim, counters, bound, depth, width).groupBy("__key").agg(F.sum("__measure").alias("__sum"))
        sums = eligible(sums, "__key") if eligible else sums
        top = sums.where("__sum IS NOT NULL").select("__sum").orderBy(F.col("__sum").desc()).limit(k).collect()
        return top[-1][0] if len(top) == k else None

    ordered = sorted(counters[0].values(), reverse=True)
    guess = ordered[min(FIRST_GUESS * k, len(ordered)) - 1]
    bound = kth(guess)
    if bound is None and guess > ordered[-1]:  # too few keys there: look at all
        bound = kth(ordered[-1])
    if bound is None:
        return Pruned(fact, False, f"fewer than {k} keys have a sum")
    kept = _reaching(rows, counters, bound, depth, width).select(*[F.col(f"`{c}`") for c in fact.columns])
    return Pruned(kept, True, f"keys whose bound reaches {bound}")
