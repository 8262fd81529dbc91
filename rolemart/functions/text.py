from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def part_of(col: Column, delimiter: str, index: int) -> Column:
    """1-based part of a delimited text; NULL (not empty text) where the part is missing."""
    return F.get(F.split(col, re.escape(delimiter)), F.lit(index - 1))


def digit_at(col: Column, position: int) -> Column:
    """The digit at a 1-based position of a coded number; NULL where there is none."""
    return F.substring(col.cast("string"), position, 1).try_cast("bigint")


def bucket_floor(col: Column, width: int) -> Column:
    """Lower bound of the fixed-width bucket, in whole numbers."""
    return F.call_function("div", col, F.lit(width)) * F.lit(width)


def bucket_label(floor: Column, width: int) -> Column:
    """``[lo,hi)`` text of a bucket."""
    return F.concat(F.lit("["), floor.cast("string"), F.lit(","), (floor + width).cast("string"), F.lit(")"))
