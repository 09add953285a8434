"""vireo: text-engagement analytics as Spark DataFrame operators.

Every public operator takes a DataFrame and returns a DataFrame built from
built-in Spark SQL expressions, so Catalyst sees the whole plan (pushdown,
pruning, codegen) and the work is distributed by Spark's own shuffles.
"""

__version__ = "0.1.0"
