"""DataFrame -> DataFrame operators: parsing, relational, indexing, time series,
features, splits, mining, clustering, learning and evaluation."""
