"""Composable DataFrame operators for Bronze / Silver / Gold analytics on Spark."""

__version__ = "0.1.0"
