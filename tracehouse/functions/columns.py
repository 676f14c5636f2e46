"""Column references by exact name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A name such as ``99.5`` taken whole, not as a field of ``99``."""
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    return F.col(quoted(name))


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores behind it until no taken name equals it in any case."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted
