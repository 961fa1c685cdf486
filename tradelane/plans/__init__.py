"""Analytical tables, queries and panel tables built from the operators."""
