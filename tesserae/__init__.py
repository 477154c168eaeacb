"""Spark-native analytics over tables of labelled 3D scene data."""
