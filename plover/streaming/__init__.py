"""Streaming: intentionally empty.

The workload this engine reproduces is batch only: there is no watermark,
window, state or late-data handling to rebuild. The one incremental notion,
"train on the latest run date only", is a batch filter
(:func:`plover.operators.splits.scope_train`). Nothing is invented here.
"""
