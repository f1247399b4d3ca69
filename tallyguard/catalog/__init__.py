"""Registered queries over the given tables, one or more per operator."""

from tallyguard.catalog import (aggregate_queries, column_queries, feature_queries,
                                sampling_queries, source_queries, text_queries)  # noqa: F401
from tallyguard.catalog.registry import ORACLES, QUERIES  # noqa: F401
