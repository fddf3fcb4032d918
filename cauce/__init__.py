"""Cauce: everyday warehouse, quality, feature and forecast work as Spark DataFrame functions."""
