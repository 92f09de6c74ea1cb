"""Spark-native toolkit for turning public-data files into an analysable warehouse."""
