"""Queries by operator, each beside its SQL."""

from . import corpus, relational, scalars  # noqa: F401
from .base import QUERIES, SQL  # noqa: F401
