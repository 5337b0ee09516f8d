"""reelhouse: Spark-native media-engagement analytics.

Medallion batch layers, a SQL report pack, a one-pass data-quality framework,
a Structured Streaming event path and per-user recommendations -- all as
DataFrame / SQL plans.
"""

__version__ = "0.1.0"
