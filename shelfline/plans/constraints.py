"""Keys, references and row rules of many tables in one aggregation.

Every table is read once. One ``inline`` per table turns a row into what it says about keys: "I am key x of
this space" (slot 0), "I point to key x" (another slot), and into the row rules it breaks. What is said of a
key is counted per key, map-side first, so that a value held by a third of all rows leaves a task as one row. A key that is
pointed to and that nobody is, is an orphan; a key that two rows are, is a duplicate. All verdicts are sums over these
counted keys, so they merge like any partial aggregate. Keys travel in their own type, whole numbers as longs and
all others as strings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from shelfline.plans.ordering import reads_all
from shelfline.plans.reports import beside

_RULES = -1  # the space of row rules: their number is the key


@dataclass
class _Said:
    """What each row of a table says: the key in ``column`` (a number: that key) holds ``slot``."""

    space: int
    column: str | int
    slot: int
    amount: Column | None
    day: Column | None


@dataclass
class Constraints:
    """What is to be checked; :meth:`counted` gives one row with a column per check."""

    tables: Mapping[str, DataFrame]
    _said: dict[str, list[_Said]] = field(default_factory=dict)
    _summed: dict[int, str] = field(default_factory=dict)  # spaces whose amounts are taken, and what by
    _checks: list[tuple[str, str, Column, bool]] = field(default_factory=list)
    _spaces: dict[tuple[str, str], int] = field(default_factory=dict)
    _slots: dict[int, int] = field(default_factory=dict)
    _whole: dict[int, bool] = field(default_factory=dict)
    _rules: int = 0

    def _is_whole(self, table: str, column: str) -> bool:
        return isinstance(self.tables[table].schema[column].dataType, IntegralType)

    def _key(self, space: int, column: str) -> tuple[Column, Column]:
        if self._whole[space]:
            return F.col(column).cast("long"), F.lit(None).cast("string")
        return F.lit(None).cast("long"), F.col(column).cast("string")

    def _struct(self, said: _Said) -> Column:
        if isinstance(said.column, int):
            whole, text = F.lit(said.column).cast("long"), F.lit(None).cast("string")
        else:
            whole, text = self._key(said.space, said.column)
        return F.struct(
            F.lit(said.space).alias("space"), whole.alias("whole"), text.alias("text"), (F.lit(None).cast("date") if said.day is None else said.day).alias("day"),
            F.lit(said.slot).alias("slot"), (F.lit(0) if said.amount is None else F.coalesce(said.amount, F.lit(0))).cast("long").alias("amount"),
        )

    def say(self, table: str, space: int, column: str, slot: int, amount: Column | None = None, day: Column | None = None) -> None:
        """Each row of ``table`` says of the key in ``column`` that it holds ``slot``; amounts add up, days keep keys apart."""
        if amount is not None:
            if self._summed.setdefault(space, "keys") != "keys":
                raise ValueError("the amounts of these keys already count a row rule")
        self._said.setdefault(table, []).append(_Said(space, column, slot, amount, day))

    def space(self, table: str, column: str, children: Sequence[tuple[str, str]] = (), name: str = "key") -> int:
        """The keys of ``table.column``, which its rows are: whole numbers if the children's columns are so too.

        Keys that are checked to be unique are not said again to be pointed to, unless they travel in another type.
        """
        entity, whole = f"{table}.{column}", all(self._is_whole(t, c) for t, c in [(table, column), *children])
        known = (entity, name)
        if known not in self._spaces:
            unique = self._spaces.get((entity, "unique"))
            if unique is not None and self._whole[unique] == whole:
                self._spaces[known] = unique
            else:
                space = self._spaces[known] = len(self._slots)
                self._slots[space], self._whole[space] = 0, whole
                self.say(table, space, column, 0)
        return self._spaces[known]

    def slot(self, space: int) -> int:
        self._slots[space] += 1
        return self._slots[space]

    def check(self, check: str, entity: str, violations: Column, joined: bool = False) -> None:
        """``joined``: a sum over the keys of one space beside other columns, which :meth:`verdicts` is handed."""
        self._checks.append((check, entity, violations, joined))

    # --- the usual constraints ----------------------------------------------

    def unique(self, table: str, column: str) -> None:
        """Key values that repeat, and rows without one."""
        space = self.space(table, column, name="unique")
        mine = F.col("space") == space
        self.check("duplicate_key", f"{table}.{column}", F.count_if(mine & (F.col("n0") > 1)))
        self.check("null_key", f"{table}.{column}", F.sum(F.when(mine & no_key(), F.col("n0"))))

    def reference(self, child: str, child_column: str, parent: str, parent_column: str, children: Sequence[tuple[str, str]]) -> None:
        """Rows of ``child`` whose key no row of ``parent`` has; ``children``: all columns that point there."""
        space = self.space(parent, parent_column, children, name="parent")
        slot = self.slot(space)
        self.say(child, space, child_column, slot)
        orphan = (F.col("space") == space) & ~no_key() & (F.col("n0") == 0)
        self.check("foreign_key", f"{child}.{child_column} -> {parent}.{parent_column}", F.sum(F.when(orphan, F.col(f"n{slot}"))))

    def row_rule(self, check: str, entity: str, table: str, broken: Column) -> None:
        """Rows of ``table`` for which ``broken`` is true.

        They are the amounts of keys that the rows say anyway and that nobody adds up; where there are none left, the
        rule's own number is a key.
        """
        violations = F.coalesce(broken, F.lit(False)).cast("long")
        said = next((x for x in self._said.get(table, []) if x.space not in self._summed), None)
        if said is not None:
            said.amount, self._summed[said.space] = violations, "rule"
            self.check(check, entity, F.sum(F.when(F.col("space") == said.space, F.col("amount"))))
            return
        number, self._rules = self._rules, self._rules + 1
        self._said.setdefault(table, []).append(_Said(_RULES, number, 0, violations, None))
        self._summed[_RULES] = "rule"
        self.check(check, entity, F.sum(F.when((F.col("space") == _RULES) & (F.col("whole") == number), F.col("amount"))))

    # --- the work -----------------------------------------------------------

    def keys(self) -> DataFrame:
        """space, whole, text, day; n0, n1, ... rows that said each slot; amount: their sum. One row per key and day."""
        said = [self.tables[t].select(F.inline(F.array(*[self._struct(x) for x in own]))) for t, own in self._said.items()]
        slots = max([0, *self._slots.values()])
        counts = [F.count_if(F.col("slot") == j).alias(f"n{j}") for j in range(slots + 1)]
        return reduce(lambda a, b: a.unionByName(b), said).groupBy("space", "whole", "text", "day").agg(*counts, F.sum("amount").alias("amount"))

    def verdicts(self, keys: DataFrame | None = None, joined: DataFrame | None = None) -> DataFrame:
        """(check, entity, violations, passed) from the counted ``keys``, and from ``joined``, some of them with more columns."""
        keys = self.keys() if keys is None else keys

        def counted(of: DataFrame, kind: bool) -> DataFrame:
            every = F.coalesce(F.max(reads_all(keys)), F.lit(0))  # zero: both need all that is counted, so it is shuffled once
            return of.agg(*[(F.coalesce(c, F.lit(0)).cast("long") + every).alias(f"c{i}") for i, (_, _, c, k) in enumerate(self._checks) if k == kind])

        parts = [counted(keys, False)] + ([] if joined is None else [counted(joined, True)])
        found = [F.struct(F.lit(check).alias("check"), F.lit(entity).alias("entity"), F.col(f"c{i}").alias("violations")) for i, (check, entity, *_) in enumerate(self._checks)]
        return beside(*parts).select(F.inline(F.array(*found))).withColumn("passed", F.col("violations") == 0)

    @staticmethod
    def of_space(keys: DataFrame, space: int) -> DataFrame:
        """The counted keys of one space. The condition reads a count, so that it stays above the aggregation both uses share."""
        return keys.filter(F.when(F.col("n0") >= 0, F.col("space")) == space)


def no_key() -> Column:
    return F.col("whole").isNull() & F.col("text").isNull()
