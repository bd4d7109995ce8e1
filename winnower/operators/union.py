"""Stack frames by column name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """All rows of all frames, duplicates kept. Names match without regard to case and numbers widen."""
    if not frames:
        raise ValueError("union_by_name needs at least one frame")
    return reduce(lambda top, below: top.unionByName(below, allowMissingColumns=allow_missing), frames)
