"""Operators for preparing training corpora at scale (one module each).

Nothing else in the library imports this subpackage. Python work runs in
Arrow batches inside Spark tasks; Spark does the partitioning, shuffling and
recovery. See the README's table of the ten operators.
"""
