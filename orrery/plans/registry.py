"""All registered queries and their SQL."""

from __future__ import annotations

from . import expressions, filters, histograms, joins, maps, spectra
from .base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "expressions", "filters", "histograms", "joins", "maps", "spectra"]
