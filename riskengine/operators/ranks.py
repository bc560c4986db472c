"""Cuts at given ranks of an order by several columns, found by counting instead of sorting.

One pass counts the rows and sketches the leading column. Two points of the sketch bracket a rank,
a second pass counts the rows below, on and between them, and only when few rows are left between
are these ordered. A value that many rows share is pinned, and the search goes on among its rows by
the next column. A wrong bracket costs another pass, never a wrong cut. Several ranks share the
first two passes.

The cut is the key of a row, so that a split is a plain range filter on the order columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Points of the sketch, and its accuracy: a bracket has a small part of the rows it was made for.
GRID = 1_000
ACCURACY = 20_000
# Rows that are ordered at once, a few bytes each.
SELECT_ROWS = 100_000

Rank = int | Callable[[int], int]


@dataclass
class _Search:
    """A rank among the rows of `scope`, whose first `len(pinned)` keys are settled."""

    rank: int
    scope: Column = field(default_factory=lambda: F.lit(True))
    pinned: list = field(default_factory=list)
    lo: object = None
    hi: object = None


class _Cutter:
    """`keys` are the order columns; a long one is taken as two halves, which a double holds exactly."""

    def __init__(self, df: DataFrame, order: tuple[str, ...]):
        self.keys: list[Column] = []
        self.absent: list[Column] = []
        for c in order:
            kind = df.schema[c].dataType
            whole = isinstance(kind, T.LongType)
            keys = [F.shiftright(c, 32), F.col(c).bitwiseAND(F.lit(2**32 - 1))] if whole else [F.col(c)]
            real = isinstance(kind, (T.DoubleType, T.FloatType))
            self.keys += keys
            self.absent += [F.col(c).isNull() | F.isnan(c) if real else F.col(c).isNull()] * len(keys)
        named = [F.when(~gone, k).alias(f"k{i}") for i, (k, gone) in enumerate(zip(self.keys, self.absent))]
        self.rows = df.select(*named)

    @staticmethod
    def value(i: int) -> Column:
        return F.col(f"k{i}")

    def survey(self, scope: Column, i: int):
        """Rows, rows with a value of key i, and the points of its sketch."""
        probs = ", ".join(repr(k / GRID) for k in range(GRID + 1))
        sketch = F.expr(f"percentile_approx(k{i}, array({probs}), {ACCURACY})")
        held = F.count(self.value(i)).alias("valid")
        return self.rows.where(scope).agg(F.count(F.lit(1)).alias("n"), held, sketch.alias("points")).first()

    @staticmethod
    def bracket(search: _Search, seen) -> None:
        at = int(search.rank / seen["valid"] * GRID)
        search.lo = seen["points"][at - 1] if at >= 2 else None
        search.hi = seen["points"][at + 2] if at + 2 < GRID else None

    def counts(self, searches: list[_Search]):
        """For each search the rows below its bracket, on its ends and between them, in one pass."""
        sums = []
        for k, s in enumerate(searches):
            v = self.value(len(s.pinned))
            below = F.lit(False) if s.lo is None else v < F.lit(s.lo)
            first = F.lit(False) if s.lo is None else v == F.lit(s.lo)
            last = F.lit(False) if s.hi is None or s.hi == s.lo else v == F.lit(s.hi)
            named = {"below": below, "first": first, "inside": self.between(s), "last": last}
            sums += [F.count_if(s.scope & cond).alias(f"{name}{k}") for name, cond in named.items()]
        found = self.rows.agg(*sums).first()
        return [[found[f"{name}{k}"] for name in ("below", "first", "inside", "last")] for k in range(len(searches))]

    def between(self, s: _Search) -> Column:
        v = self.value(len(s.pinned))
        parts = [v.isNotNull()]
        if s.lo is not None:
            parts.append(v > F.lit(s.lo))
        if s.hi is not None:
            parts.append(v < F.lit(s.hi))
        return reduce(Column.__and__, parts)

    def select(self, scope: Column, i: int, rank: int) -> list | None:
        """Keys i.. of the row at `rank` of a few rows; None where there are not so many."""
        keys = [self.value(j).asc_nulls_last() for j in range(i, len(self.keys))]
        row = self.rows.where(scope).orderBy(*keys).offset(rank).limit(1).collect()
        return list(row[0])[i:] if row else None

    def pin(self, s: _Search, value, rank: int, rows: int) -> list:
        """The rest of the search among `rows` rows that share `value` of the next key (None: no value)."""
        i = len(s.pinned)
        v = self.value(i)
        here = _Search(rank, s.scope & (v.isNull() if value is None else v == F.lit(value)), [*s.pinned, value])
        if rank == 0 or i + 1 == len(self.keys):
            return here.pinned
        if rows <= SELECT_ROWS:
            return here.pinned + self.select(here.scope, i + 1, rank)
        return self.go_on(here, self.survey(here.scope, i + 1))

    def go_on(self, s: _Search, seen) -> list:
        if s.rank >= seen["valid"]:
            return self.pin(s, None, s.rank - seen["valid"], seen["n"] - seen["valid"])
        self.bracket(s, seen)
        return self.settle(s, self.counts([s])[0])

    def settle(self, s: _Search, counted: list[int]) -> list:
        """Follow the bracket of a search whose rows are counted to its cut."""
        below, first, inside, last = counted
        left = s.rank - below
        if left < 0 or left >= first + inside + last:  # the sketch was off: open that end
            s.lo, s.hi = (None, s.lo) if left < 0 else (s.hi, None)
            return self.settle(s, self.counts([s])[0])
        if left < first:
            return self.pin(s, s.lo, left, first)
        if left >= first + inside:
            return self.pin(s, s.hi, left - first - inside, last)
        left -= first
        scope, i = s.scope & self.between(s), len(s.pinned)
        if inside <= SELECT_ROWS:
            return s.pinned + self.select(scope, i, left)
        return self.go_on(_Search(left, scope, s.pinned), self.survey(scope, i))

    def before(self, cut: list) -> Column:
        """Rows whose keys come before the cut; a shorter cut is compared by its own keys."""
        head: Column | None = None
        for i in reversed(range(len(cut))):
            key, absent = self.keys[i], self.absent[i]
            if cut[i] is None:
                less, same = ~absent, absent
            else:
                less, same = ~absent & F.coalesce(key < F.lit(cut[i]), F.lit(False)), F.coalesce(key == F.lit(cut[i]), F.lit(False))
            head = less if head is None else less | (same & head)
        return head


def before_ranks(df: DataFrame, ranks: list[Rank], order: tuple[str, ...] = ("Time", "txn_id")) -> list[Column]:
    """For each rank a row predicate that holds for exactly the first `rank` rows in the given order.

    A rank may be a function of the row count. The last order column must be unique. Missing values
    sort last.
    """
    cutter = _Cutter(df, order)
    seen = cutter.survey(F.lit(True), 0)
    out: dict[int, Column] = {}
    todo: dict[int, _Search] = {}
    for k, rank in enumerate(ranks):
        rank = rank(seen["n"]) if callable(rank) else rank
        if rank <= 0 or rank >= seen["n"]:
            out[k] = F.lit(rank > 0)
        elif rank >= seen["valid"]:
            out[k] = cutter.before(cutter.go_on(_Search(rank), seen))
        else:
            todo[k] = _Search(rank)
            cutter.bracket(todo[k], seen)
    if todo:
        for (k, s), counted in zip(todo.items(), cutter.counts(list(todo.values()))):
            out[k] = cutter.before(cutter.settle(s, counted))
    return [out[k] for k in range(len(ranks))]


def before_rank(df: DataFrame, rank: Rank, order: tuple[str, ...] = ("Time", "txn_id")) -> Column:
    """`before_ranks` for one rank."""
    return before_ranks(df, [rank], order)[0]


def before_small_rank(df: DataFrame, rank: int, order: tuple[str, ...]) -> Column | None:
    """`before_rank` where `rank` is small: one pass that orders so many rows; None if there are fewer."""
    cutter = _Cutter(df, order)
    cut = cutter.select(F.lit(True), 0, rank)
    return None if cut is None else cutter.before(cut)
