"""Title-casing of partition values, native and codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Runs of cased characters (Unicode Uppercase, Lowercase, title case), or of anything else.
_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"
_RUNS = rf"([{_CASED}]+|[^{_CASED}]+)"


def title_case(col: Column | str) -> Column:
    """Python ``str.title()`` semantics as a JVM expression.

    The value is cut into alternating runs of cased characters and everything
    else; every cased run gets a title-case first character and a lower-case
    rest.  Unlike ``initcap`` (which only starts words after a space), a letter
    after an apostrophe, hyphen, dot, digit or uncased letter is capitalised:
    ``o'fallon`` -> ``O'Fallon``.  A capital whose lower case is two characters
    (dotted I) stays as it is.
    """
    c = F.col(col) if isinstance(col, str) else col
    runs = F.regexp_extract_all(c, F.lit(_RUNS), 1)
    return F.array_join(F.transform(runs, _title_run), "")


def _title_run(run: Column) -> Column:
    first = F.left(run, F.lit(1))
    title = F.when(F.length(F.lower(first)) == 1, F.initcap(first)).otherwise(first)
    return F.concat(title, F.lower(F.substring(run, F.lit(2), F.length(run))))
