"""Spark-native toolkit for cleaning, labelling, joining and reporting on tables."""
