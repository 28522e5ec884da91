"""Spark-native analytics for speech, video and text corpora."""
