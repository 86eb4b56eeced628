"""Operators chained into table builds, and the workload on the driver tables."""
