"""Spark-native analytics over hierarchical place registries and corpora."""
