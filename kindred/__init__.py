"""Content similarity on Spark: features, facet filters, four rankers, evaluation."""
