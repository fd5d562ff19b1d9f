"""Retail order analytics as composable Spark DataFrame operators."""
