"""What a refresh is about to change, stored before it changes anything.

A refresh replaces raw partitions first. From then on raw no longer tells which
months above it held the rows that went. So these months are an intent, stored
below the lake's location before raw changes and deleted when all layers agree.
A refresh that finds an intent takes over its months, which makes a rerun after a
death at any step equal to a refresh that was never interrupted.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from uuid import uuid4

from fareloom.contract import FLEET, MONTH, YEAR
from fareloom.sinks.tables import Lake, delete_folder, folders_below, is_complete

Month = tuple[str, int, int]  # fleet, year and month of pickup
SCHEMA = f"{FLEET} string, {YEAR} int, {MONTH} int"


@dataclass(frozen=True)
class Journal:
    """The intents of one lake. Writers of a lake take turns; readers need no part."""

    lake: Lake

    @property
    def root(self) -> str:
        return f"{self.lake.location.rstrip('/')}/refresh-intents"

    def _complete(self) -> list[str]:
        paths = [f"{self.root}/{name}" for name in folders_below(self.lake.spark, self.root)]
        return [path for path in paths if is_complete(self.lake.spark, path)]

    def pending(self) -> set[Month]:
        """Months that an interrupted refresh was to bring up to date."""
        paths = self._complete()
        if not paths:
            return set()
        rows = self.lake.spark.read.schema(SCHEMA).parquet(*paths).distinct().collect()
        return {tuple(row) for row in rows}

    def intend(self, months: Iterable[Month]) -> None:
        """Store the months before anything changes. An intent counts once it is complete."""
        frame = self.lake.spark.createDataFrame(sorted(months), SCHEMA)
        frame.coalesce(1).write.parquet(f"{self.root}/{uuid4().hex[:12]}")

    def done(self) -> None:
        """All layers agree: no intent is left."""
        delete_folder(self.lake.spark, self.root)
