"""Composed reports: measures, dashboard pages and the registered queries."""
