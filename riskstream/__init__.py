"""Transaction-risk analytics on Spark: features, scoring, alerts and their reports."""
