"""Columns by their literal names (model names hold dots, slashes and dashes)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """The column of exactly this name; dots and back-quotes in it are not a path."""
    return F.col("`" + name.replace("`", "``") + "`")
