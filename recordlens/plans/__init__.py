"""Whole pipelines built from the operators, and the queries over the shared test tables."""
