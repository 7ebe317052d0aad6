"""All topics in one place."""

from suite import (allocation_queries, geo_queries, index_queries, linkage_queries, residual_queries,
                   sensitivity_queries, source_queries)

TOPICS = (index_queries, allocation_queries, linkage_queries, source_queries, sensitivity_queries, geo_queries,
          residual_queries)


def queries() -> dict:
    return {k: v for t in TOPICS for k, v in t.QUERIES.items()}


def oracles() -> dict:
    return {k: v for t in TOPICS for k, v in t.ORACLES.items()}
