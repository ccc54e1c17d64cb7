"""Dimension maintenance and layered batch loads, written as Spark DataFrame code."""
