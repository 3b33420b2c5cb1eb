"""Batch jobs (bronze, silver, gold) and the operator checks on driver tables.

Job functions come in two kinds: pure transforms (DataFrames in,
DataFrames out; used by tests and by ``queries``) and ``run_*`` functions
that read and write the tables named by a ``Layout``.
"""
