"""keelson — tabular binary classification on Spark.

Reads raw tables, checks them against a schema contract, imputes and encodes
columns, splits reproducibly, searches models by cross-validation, evaluates,
scores in batch or as a stream, measures distribution drift and decides on
promotion and retraining. Every step is a DataFrame, Spark ML or Structured
Streaming job; nothing bulk passes through the driver.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
