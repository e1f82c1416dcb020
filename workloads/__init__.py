"""Queries over the test tables, each with the SQL that gives the same rows."""

from . import checks, documents, histories, models, versions

ALL = {**versions.QUERIES, **histories.QUERIES, **documents.QUERIES, **checks.QUERIES, **models.QUERIES}
