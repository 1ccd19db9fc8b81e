"""Queries over the given tables, each next to the SQL that gives the same result."""

from chatmill.queries import conversations, documents, evaluation, files, profiles, scoring, trainlog  # noqa: F401
from chatmill.queries.registry import ORACLES, QUERIES  # noqa: F401
