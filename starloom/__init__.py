"""starloom: build a retail sales star on Spark and report over it.

Everything is a function from DataFrame to DataFrame. Catalyst picks the physical plan;
the few decisions it cannot take alone (dense keys, hot keys, what to write once and
re-read) sit in ``operators.keys``, ``operators.skew`` and ``staging``.
"""
