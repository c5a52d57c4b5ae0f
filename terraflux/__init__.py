"""Spark-native climate and site-observation analytics."""
