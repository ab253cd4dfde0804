"""Operators for preparing text corpora at scale, one module per operator.

Nothing outside this folder imports it, apart from the guarded lookup in
``__spark_entry__.py``.
"""
