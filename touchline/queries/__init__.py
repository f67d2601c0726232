"""All queries; importing the modules registers them."""

from touchline.queries import columns, models, people, relations, reports, rolling, seasons, sources
from touchline.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "columns", "models", "people", "relations", "reports", "rolling", "seasons", "sources"]
