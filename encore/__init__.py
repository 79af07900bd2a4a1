"""encore: Spark-native operators for implicit-feedback interaction data.

Batch and streaming ingest, contiguous ids, stable splits, per-user
histories, implicit ALS with model selection, top-K recommendation,
ranking metrics and distribution-drift checks, all as DataFrame operators.
"""

__version__ = "0.1.0"
