"""Analytics for recorded radio I/Q captures, and for training text, on Spark."""
