"""reelhouse: a Spark-native catalogue lakehouse.

Raw paged listings -> cleaned staging -> curated dimensions and bridges ->
a tested star schema, plus ranking queries, data-quality tests as DataFrame
operators and metric-series operators in batch and Structured Streaming.
"""

__all__ = ["session"]
