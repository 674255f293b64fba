"""Operators for training-data tables. Nothing outside this subpackage imports it."""

#: Modules with queries() and sql().
QUERY_MODULES = ("queries",)
