"""File names and extensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def file_name(path: Column) -> Column:
    """Last segment of a path; slashes at the end do not count."""
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)


def extension_of_name(name: Column) -> Column:
    """From the first dot on, dot included; NULL for a name without a dot."""
    dot = F.instr(name, ".")
    return F.when(dot > 0, F.substring(name, dot, F.length(name)))


def extension(path: Column) -> Column:
    return extension_of_name(file_name(path))


def has_extension(name: Column, extensions: Sequence[str]) -> Column | None:
    """Condition for the listed extensions (exact case); None if all files count."""
    if not extensions:
        return None
    return extension_of_name(name).isin(*extensions)
