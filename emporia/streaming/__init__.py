"""Structured Streaming versions of the pipelines.

Transforms are shared with batch.  What a stream cannot do directly
(row_number, cumulative windows over an exploded key, lag) happens in
``foreachBatch`` against a small store of per-key results.
"""
