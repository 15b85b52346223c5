"""Operators for large training-data pipelines; `registry` lists their queries."""
