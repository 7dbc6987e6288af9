"""Per-row vector arithmetic on `ARRAY<DOUBLE>`."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EPSILON = 1e-6


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def rescale(vector: Column, factor: float) -> Column:
    """Every element times `factor`."""
    return F.transform(doubles(vector), lambda x: x * F.lit(float(factor)))


def mean(vector: Column) -> Column:
    return F.aggregate(doubles(vector), F.lit(0.0), lambda a, x: a + x) / F.size(vector)


def deviation(vector: Column, centre: Column) -> Column:
    """Population standard deviation around `centre`."""
    squares = F.aggregate(doubles(vector), F.lit(0.0), lambda a, x: a + (x - centre) * (x - centre))
    return F.sqrt(squares / F.size(vector))


def _once(value: Column, use) -> Column:
    """`use(value)` with `value` computed once per row, also where `use` needs it for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def samplewise(vector: Column, centre: bool = True, scale: bool = True) -> Column:
    """Centre and scale each vector by its own mean and deviation."""

    def standardised(s: Column) -> Column:
        values = s["v"]
        if centre:
            values = F.transform(values, lambda x: x - s["m"])
        if scale:
            # the deviation does not change when the vector is centred
            values = F.transform(values, lambda x: x / (s["sd"] + F.lit(EPSILON)))
        return values

    values = doubles(vector)
    with_mean = F.struct(values.alias("v"), mean(values).alias("m"))
    with_deviation = _once(
        with_mean, lambda s: F.struct(s["v"].alias("v"), s["m"].alias("m"), deviation(s["v"], s["m"]).alias("sd"))
    )
    return _once(with_deviation, standardised)


def featurewise(vector: Column, means: Column | None, deviations: Column | None) -> Column:
    """Centre and scale each position by the dataset's means and deviations."""
    values = doubles(vector)
    if means is not None:
        values = F.zip_with(values, means, lambda x, m: x - m)
    if deviations is not None:
        values = F.zip_with(values, deviations, lambda x, s: x / (s + F.lit(EPSILON)))
    return values
