"""Streaming: intentionally empty.

The recommender this package rebuilds is a batch system — every job reads
whole tables and writes whole tables; it has no streaming source or sink,
watermark, window or stateful operator.  Nothing here is needed to run any
registered query.
"""
