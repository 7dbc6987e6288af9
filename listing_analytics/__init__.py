"""Business-listing analytics on Spark: extract, label, sample, split, profile and evaluate."""
