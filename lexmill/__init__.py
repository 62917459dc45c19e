"""lexmill: a PySpark-native engine that turns raw legal pages and large text corpora into clean tables."""
