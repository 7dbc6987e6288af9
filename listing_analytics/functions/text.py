"""Text columns: stripping, delimited lists, missing values, booleans."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

# Cell texts a CSV load treats as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The white-space characters of Unicode, and the four information separators.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (`trim` alone removes blanks only)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def rstrip(text: Column) -> Column:
    """Remove white space of any kind at the end."""
    return F.rtrim(text, F.lit(WHITE_SPACE))


def split_values(text: Column, separator: str = ",") -> Column:
    """A delimited string as an array of stripped values."""
    return F.transform(F.split(text, re.escape(separator)), strip)


def any_value_in(text: Column, values: Iterable[str], separator: str = ",") -> Column:
    """True when at least one value of the delimited string is in `values`; missing text is false."""
    wanted = list(values)
    if not wanted:
        return F.lit(False)
    return F.coalesce(F.exists(split_values(text, separator), lambda v: v.isin(wanted)), F.lit(False))


def missing_to_null(text: Column, tokens: Iterable[str] = MISSING_TOKENS) -> Column:
    """Null for the texts that stand for a missing cell."""
    return F.when(~text.isin(list(tokens)), text)


def nullable_bool(text: Column, strict: bool = False) -> Column:
    """Boolean from text: any text that is not empty is true, empty or missing is null.

    `strict` parses the text instead, so that "False" becomes false.
    """
    if strict:
        return strip(text).try_cast("boolean")
    return F.when(F.coalesce(text, F.lit("")) != "", F.lit(True))


def params_text(params: Column, separator: str = ";") -> Column:
    """A map of strings as `key=value` parts in key order; blanks before a key, which mark nested values, do not order."""
    named = F.transform(F.map_entries(params), lambda e: F.struct(F.ltrim(e["key"]).alias("by"), e["key"], e["value"]))
    entries = F.array_sort(named)
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("None")))),
        separator,
    )


def nested_params_text(params: Column, key: str, separator: str = ";") -> Column:
    """A nested map as the ` key=...` part of its parent's text, joined by a doubled separator."""
    return F.concat(F.lit(f" {key}="), params_text(params, separator[0] * (len(separator) + 1)))


def nested_params(params: Mapping, separator: str = ";") -> dict[str, str]:
    """Parameters as a map of strings: a list or mapping becomes one text, and its key begins with a blank.

    The parts of a nested value are joined by one separator more than those around it.
    """
    inner = separator[0] * (len(separator) + 1)

    def as_text(value) -> str:
        if isinstance(value, Mapping):
            return inner.join(f"{k}={v}" for k, v in sorted(nested_params(value, inner).items(), key=lambda p: p[0].lstrip()))
        return inner.join(map(str, value))

    nested = (Mapping, list, tuple)
    return {f" {k}" if isinstance(v, nested) else str(k): as_text(v) if isinstance(v, nested) else str(v) for k, v in params.items()}


def invert_map(entries: Column) -> Column:
    """Keys and values exchanged; the values must be unique."""
    return F.map_from_arrays(F.map_values(entries), F.map_keys(entries))
