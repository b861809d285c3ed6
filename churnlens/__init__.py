"""churnlens: customer-retention analytics as composable Spark DataFrame functions.

Layout
------
sources/    role tables (parquet, JDBC, CSV), report and model artifacts
functions/  scalar column expressions
operators/  relational, profiling, preparation, model and evaluation operators
plans/      the composed feature queries and the registry of named queries
"""

from churnlens.rules import Rules, DRIVER_RULES, reference_rules  # noqa: F401
