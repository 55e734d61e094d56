"""Visit-history analytics on Spark: features, predictions and rankings from visit records."""
