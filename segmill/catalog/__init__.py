"""Registered checks: each operator over the given tables, with an SQL counterpart."""

from segmill.catalog import accounts, codes, filters, joins, segments, sources, texts
from segmill.catalog.base import REGISTRY

__all__ = ["REGISTRY", "accounts", "codes", "filters", "joins", "segments", "sources", "texts"]
