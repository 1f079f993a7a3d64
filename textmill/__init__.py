"""Text-message analytics on Spark: clean, count, classify, feed back, retain."""
