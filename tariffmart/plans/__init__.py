"""Compositions: refresh, views, lookups, quality checks, audits."""
