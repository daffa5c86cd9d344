"""Spark-native analytics for daily text corpora and the signals derived from them."""
