"""Spark-native preparation of instruction data and selection of trained models."""
