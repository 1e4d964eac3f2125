"""Mergelens: code-review analytics as plain Spark DataFrame operators."""
