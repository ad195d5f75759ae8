"""Whole loads: operators, tables and order of work put together."""
