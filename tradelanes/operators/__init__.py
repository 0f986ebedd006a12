"""DataFrame-in, DataFrame-out operators: conform, keys, reshape,
enrich, measures, periods, ranking, anomaly, quality."""
