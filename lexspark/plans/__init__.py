"""The query catalogue: every operator over the test tables, with SQL for the same result."""

from . import adapter_queries, graph_queries, statute_queries, text_queries  # noqa: F401
from .base import ORACLES, QUERIES  # noqa: F401
