"""Registered queries with their check SQL."""
