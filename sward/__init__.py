"""Spark-native building blocks for multi-target regression analytics over images and field metadata."""
