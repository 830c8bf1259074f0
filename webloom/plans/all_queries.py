"""Imports every query module so the registries are complete."""

from webloom.plans import oracle as _oracle
from webloom.plans import queries as _queries

QUERIES = _queries.QUERIES
ROWS_ONLY = _queries.ROWS_ONLY
ORACLE = _oracle.ORACLE
