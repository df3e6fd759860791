"""tidewright: a Spark-native engine for code-review trajectories and their reports."""

__version__ = "0.1.0"
