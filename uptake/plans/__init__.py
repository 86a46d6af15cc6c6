"""Marts, dashboard queries, assertions and extensions."""
