"""Document collections on Spark: read dumps, infer schemas, plan and build indexes, report."""

__version__ = "0.1.0"
