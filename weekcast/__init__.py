"""weekcast: weekly parts-demand analytics as lazy Spark DataFrame jobs.

Sub-packages
------------
functions  fixed vocabularies and Column builders (encodings, calendar, metrics, KS p-value)
sources    driver tables -> demand panel and SKU dimension; file sinks and the feature store
operators  DataFrame -> DataFrame operators (features, splits, baselines, metrics, drift, ...)
plans      compositions of operators (leaderboard, walk-forward CV, shock-to-action)
"""

__all__ = ["functions", "sources", "operators", "plans"]
