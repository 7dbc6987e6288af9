"""All registered queries and the SQL they are checked against."""

from listing_analytics.registry import (  # noqa: F401
    evaluating, filtering, joining, labelling, learning, picturing, profiling, reading, sampling, vectoring,
)
from listing_analytics.registry.base import ORACLES, QUERIES  # noqa: F401
