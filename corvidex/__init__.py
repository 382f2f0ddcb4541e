"""corvidex: a Spark-native engine that turns document collections into ranked, measured answers."""
