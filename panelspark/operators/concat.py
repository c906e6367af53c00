"""Vertical concatenation that never coerces."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in df.schema.fields]


def strict_concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, which must agree in column names, order and types.

    Checked here because ``unionByName`` would reconcile, say, int and string.
    """
    if not frames:
        raise ValueError("Nothing to concatenate")
    expected = _shape(frames[0])
    for number, frame in enumerate(frames[1:], start=2):
        if _shape(frame) != expected:
            raise ValueError(
                f"Cannot concatenate: part 1 has {expected}, part {number} has {_shape(frame)}"
            )
    return reduce(DataFrame.unionByName, frames)
