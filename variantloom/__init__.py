"""Spark-native analytics for wide single-cell tables: cells by features, labelled by variant, barcode and batch."""
