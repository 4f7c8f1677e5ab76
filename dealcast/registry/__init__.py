"""Registered queries (``QUERIES``) and their DuckDB twins (``SQL``).

Every query reads the driver's tables (or data Spark derives from them) in full.
"""

from dealcast.registry.base import QUERIES, SQL  # noqa: F401
from dealcast.registry import core, panel_queries, metric_queries, model_queries, neighbour_queries, io_queries, linear_queries, tree_queries  # noqa: F401,E402
