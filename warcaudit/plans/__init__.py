"""Whole runs built from the operators, and the query registry."""
