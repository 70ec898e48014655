"""Model-quality analytics on Spark: features, metrics, run log, gate, drift, streams."""
