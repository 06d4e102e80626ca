"""Compositions of operators: fusion, completion, scoring, the staged pipeline and the query catalog."""
