"""Operators of a training-data pipeline (one module per operator).

Nothing outside this folder imports it; the driver-facing queries are in ``queries.py``.
"""
