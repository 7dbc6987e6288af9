"""Letterbox geometry: fit a picture into a canvas, keep its aspect, centre it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, functions as F


class Letterbox(NamedTuple):
    new_width: Column
    new_height: Column
    left: Column
    top: Column


def canvas(size: int | tuple[int, int]) -> tuple[int, int]:
    """Canvas width and height; one number means a square."""
    wide, high = (size, size) if isinstance(size, int) else size
    if wide < 1 or high < 1:
        raise ValueError(f"canvas size must be positive: {size}")
    return wide, high


def letterbox(width: Column, height: Column, size: int | tuple[int, int]) -> Letterbox:
    """Scaled size (truncated) and offsets of the picture on a canvas of `size`."""
    wide, high = canvas(size)
    if isinstance(size, int):
        ratio = F.lit(float(size)) / F.greatest(width, height)
    else:
        ratio = F.least(F.lit(float(wide)) / width, F.lit(float(high)) / height)
    new_width, new_height = (width * ratio).cast("int"), (height * ratio).cast("int")
    return Letterbox(
        new_width,
        new_height,
        F.floor((F.lit(wide) - new_width) / 2).cast("int"),
        F.floor((F.lit(high) - new_height) / 2).cast("int"),
    )
