"""The first n rows of an order, found by counting keys and not by sorting rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from listing_analytics.sources.tables import quoted

#: Keys drawn in a round, and keys that are sorted once no more are left.
DRAWN = 4096
#: How far from the expected place in the drawn keys the bounds lie, in standard deviations.
REACH = 4


def comparable(column: Column, kind: T.DataType) -> Column:
    """A key column in a form that survives the way to the driver and back with its order."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.StructType):
        # a null struct comes before one of nulls
        fields = [comparable(column.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def constant(value, kind: T.DataType) -> Column:
    """A collected value as a column of its type."""
    if value is not None and isinstance(kind, T.StructType):
        return F.struct(*[constant(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    if value is not None and isinstance(kind, T.BinaryType):
        return F.lit(bytes(value))
    return F.lit(value).cast(kind)


class FirstRows:
    """The cut after the first `n` rows of `df` in the order of `keys`, nulls first.

    Each round draws keys between the bounds, takes two of them that the n-th key most likely lies between, and counts the
    keys up to each; the bounds close in by a factor of about ten or more a round. Only key columns are read, and the
    driver sees `DRAWN` keys at a time. The last few are sorted.
    """

    def __init__(self, df: DataFrame, n: int, *keys: str):
        self.df, self.n = df, n
        parts = [comparable(F.col(quoted(k)), df.schema[k].dataType).alias(f"k{i}") for i, k in enumerate(keys)]
        # one key stays a plain column, so that a scan can be pruned by it
        self.key = parts[0] if len(parts) == 1 else F.struct(*parts)
        self.table = df.select(self.key.alias("key"))
        self.kind = self.table.schema["key"].dataType
        self.cut, self.ties, self.all = None, None, False

    def _compare(self, column: Column, value, strictly: bool) -> Column:
        """`column` is before `value`, or equal to it unless `strictly`; null is before everything."""
        if value is None:
            return F.lit(False) if strictly else column.isNull()
        bound = constant(value, self.kind)
        return column.isNull() | (column < bound if strictly else column <= bound)

    def find(self) -> FirstRows:
        """Set `cut`, and `ties`, the number of rows equal to it that still belong to the first n; or `all`."""
        key, left = F.col("key"), self.n
        total = self.table.count()
        if left >= total:
            self.all = True
            return self
        if left <= 0:
            return self
        inner, size, seed = F.lit(True), total, 1
        while size > DRAWN:
            rows = self.table.where(inner)
            drawn = [r.key for r in rows.sample(min(1.0, DRAWN / size), seed).orderBy("key").limit(2 * DRAWN).collect()]
            seed += 1
            if not drawn:
                continue
            place, spread = left / size * len(drawn), REACH * (len(drawn) * left / size * (1 - left / size)) ** 0.5 + 1
            low = drawn[max(0, min(len(drawn) - 1, int(place - spread)))]
            high = drawn[max(0, min(len(drawn) - 1, int(place + spread)))]
            tests = [self._compare(key, low, True), self._compare(key, low, False), self._compare(key, high, True), self._compare(key, high, False)]
            # below the lower key, up to it, below the higher key, up to it
            n1, n2, n3, n4 = rows.agg(*[F.coalesce(F.sum(F.when(t, 1).otherwise(0)), F.lit(0)) for t in tests]).head()
            if left <= n1:
                inner, size = inner & tests[0], n1
            elif left <= n2:
                self.cut, self.ties = (low,), left - n1
                return self._whole(n2 - n1)
            elif left <= n3:
                inner, left, size = inner & ~tests[1] & tests[2], left - n2, n3 - n2
            elif left <= n4:
                self.cut, self.ties = (high,), left - n3
                return self._whole(n4 - n3)
            else:
                inner, left, size = inner & ~tests[3], left - n4, size - n4
        rest = [r.key for r in self.table.where(inner).orderBy("key").limit(left).collect()]
        last = rest[-1]
        self.cut, self.ties = (last,), sum(k == last or repr(k) == repr(last) for k in rest)  # also NaN
        equal = self.table.where(self._compare(key, last, False) & ~self._compare(key, last, True)).limit(self.ties + 1).count()
        return self._whole(equal)

    def _whole(self, equal: int) -> FirstRows:
        """Where all rows equal to the cut belong to the first n, no tie has to be broken."""
        if equal == self.ties:
            self.ties = None
        return self

    def rows(self) -> DataFrame:
        """The first n rows, in no order, by a filter on `df`."""
        if self.all:
            return self.df
        if self.cut is None:
            return self.df.limit(0)
        before = self._compare(self.key, self.cut[0], True)
        up_to = self._compare(self.key, self.cut[0], False)
        if self.ties is None:
            return self.df.where(up_to)
        return self.df.where(before).unionByName(self.df.where(up_to & ~before).limit(self.ties))
