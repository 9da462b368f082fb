"""Whole-text expressions for the source-tree questions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Licence tag: the token after the SPDX keyword, without a leading
# parenthesis or a trailing comment marker.
SPDX_PATTERN = r"SPDX-License-Identifier:\s*\(?([^\s)*]+)"


def newline_count(c: Column) -> Column:
    """``wc -l``: number of newline characters in the whole text."""
    return (F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))).cast("bigint")


def spdx_tag(c: Column) -> Column:
    """First SPDX licence tag in the text, NULL when there is none."""
    return F.nullif(F.regexp_extract(c, SPDX_PATTERN, 1), F.lit(""))


def file_extension(path: Column) -> Column:
    """Text after the last dot of the file name, '' when none."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.when(name.contains("."), F.element_at(F.split(name, r"\."), -1)).otherwise(F.lit(""))
