"""All registered queries."""

from . import daily_queries, extension_queries, hourly_queries, stream_queries, table_queries, text_queries  # noqa: F401
from .base import ORACLES, QUERIES  # noqa: F401
