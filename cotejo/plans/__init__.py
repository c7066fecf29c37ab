"""Whole jobs put together from the operators, stored statements, and the query catalogue."""
