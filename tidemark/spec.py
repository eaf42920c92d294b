"""Table description shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableSpec:
    """How a versioned table is keyed, ordered and laid out.

    primary_key    one or more columns identifying a record.
    version_order  newest-first ordering.  A plain name means ``DESC NULLS LAST``
                   (a null version is the oldest); pass a Column such as
                   ``F.asc_nulls_first("x")`` for anything else.  Add tie-break
                   columns so that the newest row is unique.
    partition_key  the single directory-partitioning column of both tables.
    load_ts_col    column that stores the load time of each row.
    """

    primary_key: tuple[str, ...]
    version_order: tuple[str | Column, ...]
    partition_key: str
    load_ts_col: str = "load_ts"
    # Optional Column -> Column function (e.g. functions.title_case) applied to
    # the partition column of every incoming row, history and delta alike, so
    # ``SAN JUAN`` and ``San Juan`` meet in one partition.  A merge also takes
    # the delta's keys out of partitions *current* stored under another
    # spelling before.  Off by default.
    partition_normalizer: object = field(default=None, compare=False)

    def __post_init__(self):
        if isinstance(self.primary_key, str):
            object.__setattr__(self, "primary_key", (self.primary_key,))
        if isinstance(self.version_order, (str, Column)):
            object.__setattr__(self, "version_order", (self.version_order,))
        object.__setattr__(self, "primary_key", tuple(self.primary_key))
        object.__setattr__(self, "version_order", tuple(self.version_order))
        if not self.primary_key:
            raise ValueError("primary_key needs at least one column")
        if not self.version_order:
            raise ValueError("version_order needs at least one column")

    def order_columns(self) -> list[Column]:
        """Newest-first sort expressions."""
        return [F.desc_nulls_last(c) if isinstance(c, str) else c for c in self.version_order]
