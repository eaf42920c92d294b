"""Version arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def next_version(version: Column | str) -> Column:
    """``coalesce(version, 0) + 1`` as an INT, evaluated in the JVM.

    Under ANSI mode an overflow at 2147483647 raises instead of wrapping.
    """
    v = F.col(version) if isinstance(version, str) else version
    return (F.coalesce(v.cast("int"), F.lit(0)) + F.lit(1)).cast("int")
