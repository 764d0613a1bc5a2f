"""arrears: consumer-lending collections analytics on Spark.

Every public function takes and returns DataFrames; no step collects data to
the driver except bounded dimension tables (at most a handful of rows).
"""

__all__ = ["sources", "functions", "operators", "plans", "streaming", "session"]
