"""Tiffin: delivery analytics, training and stream scoring written as Spark jobs."""
