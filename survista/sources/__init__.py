"""Scans, inline code tables, views, sinks and test-table stand-ins."""

from .tables import (code_table, load, register_views, write_csv)  # noqa: F401
