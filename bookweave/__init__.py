"""Spark-native engine for analysing, refining and publishing digitised book corpora."""
