"""Reusable relational building blocks the jobs compose."""
