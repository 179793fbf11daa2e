"""Classification on Spark: encoding, splitting, training, metrics, registry, scoring."""
