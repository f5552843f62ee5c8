"""Reusable Spark operators for layered (raw -> cleaned -> star schema) data sets."""
