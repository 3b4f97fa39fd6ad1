"""Aggregates of a stored table that are kept per slot of it, so that a change of a few slots costs the work of those slots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.sources.shared import settle
from tallyframe.sources.versioned import VersionedTable, within_spans

#: The column naming the slot of the source table that a partial aggregate is of.
PART = "part_slot"
_SOURCE = "source"


class Partials:
    """`compute` takes rows of the source with a PART column and returns aggregates per PART and whatever else; what it does
    must be mergeable, so that aggregating the partial rows of all slots gives what aggregating all rows would.

    A slot is computed from all its current rows, so rows that changed, came late or moved to another slot need no undoing.
    """

    def __init__(self, state: VersionedTable, source: VersionedTable, compute: Callable[[DataFrame], DataFrame]):
        self.state, self.source, self.compute = state, source, compute

    def stale(self, rebuild: bool = False) -> list[str]:
        """Slots of the source rewritten since the state was last brought up to date, and slots that are no more."""
        if rebuild or not self.state.exists():
            return sorted(set(self.source.slots()) | (set(self.state.slots()) if self.state.exists() else set()))
        gone = set(self.state.slots()) - set(self.source.slots())
        return sorted(gone.union(self.source.slots_since(self.state.applied(_SOURCE))))

    def computed(self, slots: list[str], version: int | None = None) -> DataFrame:
        """Partial aggregates of the named slots, from the files of these alone."""
        rows = self.source.read(slots, version)
        return self.compute(rows.withColumn(PART, self.source.slot_label()))

    def refresh(self, rebuild: bool = False) -> list[str]:
        """Bring the state up to date; returns the slots that were computed anew."""
        base, version = self.state.version(), self.source.version()
        slots = self.stale(rebuild)
        if slots or not base:
            self.state.replace_slots(self.computed(slots, version), slots, (_SOURCE, version), base)
        return slots

    def read(self) -> DataFrame:
        """The partial rows of all slots."""
        return self.state.read().drop(PART)


class RepeatedKeys:
    """The values of a column found in more than one row of a stored table, with how often (`times`).

    A value can only have become repeated, or have ceased to be, if a slot that changed holds or held it. So the values of those
    slots and the ones repeated before are looked up in the other slots, by the pages that may hold one, and counted anew.
    """

    def __init__(self, state: VersionedTable, source: VersionedTable, column: str):
        self.state, self.source, self.column = state, source, column

    def refresh(self, rebuild: bool = False) -> None:
        base, version, seen = self.state.version(), self.source.version(), self.state.applied(_SOURCE) if self.state.exists() else -1
        if seen == version and not rebuild:
            return
        if rebuild or not base:
            held = self.source.read(version=version).select(self.column)
        else:
            slots = self.source.slots_since(seen)
            here = self.source.read(slots, version).select(self.column)
            suspects = settle(here.unionAll(self.state.read(version=base).select(self.column)).distinct(), "suspects")
            others = self.source.read([s for s in self.source.slots() if s not in set(slots)], version).select(self.column)
            held = here.unionAll(within_spans(others, suspects, self.column).join(suspects, self.column, "left_semi"))
        counted = held.where(F.col(self.column).isNotNull()).groupBy(self.column).agg(F.count(F.lit(1)).alias("times"))
        self.state.replace(counted.where("times > 1"), (_SOURCE, version), base)

    def read(self) -> DataFrame:
        return self.state.read()


def grouped(df: DataFrame, *columns: str):
    """Grouped by the columns, and by PART where the rows have it."""
    return df.groupBy(*([PART] if PART in df.columns else []), *columns)


def with_part(df: DataFrame) -> list:
    """PART as a list to select, empty where the rows lack it."""
    return [F.col(PART)] if PART in df.columns else []
