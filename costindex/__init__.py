"""costindex: a Spark-native cost-of-living pipeline.

Layers:
  sources    registry, loaders, run bookkeeping, state snapshots, fixtures
  functions  column expressions shared by every layer
  operators  reusable DataFrame operators (joins, quantiles, CDC, folds, reshape, checks)
  plans      the staging views, marts, score and reports composed from operators
  streaming  the incremental load expressed as a Structured Streaming job
"""

__version__ = "0.1.0"
