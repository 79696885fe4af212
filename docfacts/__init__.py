"""docfacts: a Spark-native pipeline from unstructured reports to a table of facts."""
