"""Whole pipelines, business questions and the registered queries."""
