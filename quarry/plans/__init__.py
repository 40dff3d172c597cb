"""Registered queries over the driver's tables.

Each query is ``fn(spark, sf_dir) -> DataFrame`` plus, where SQL can express it, an equivalent SQL
text over the same tables (the correctness oracle).  Importing this package imports every plan
module, which fills ``REGISTRY``.
"""
from quarry.plans.registry import REGISTRY, oracle_sql, queries  # noqa: F401
from quarry.plans import (tabular, relational, graphs, communities, recommend,  # noqa: F401,E402
                          text, vectors, regression, files, streams, allocation)
