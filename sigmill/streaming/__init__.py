"""Unbounded captures. `operators.captures.channel_moments` takes a stream of blocks as it is: its sums are built-in
aggregates, which Structured Streaming carries from batch to batch (output mode complete or update).
"""
