"""Structured Streaming forms of the ledger and clickstream operators.

- ``ledger.live_balances``: the "data updated in real time" allocation model:
  a running balance per customer kept in the state of a built-in streaming
  aggregate, emitted in update mode with the allocation (balance floored at 0).
- ``visits.visit_rollup``: per-visit counts closed by an event-time watermark
  (a visit is a user-day), then matched to campaigns by visit start time.

Sources read the same parquet inputs as the batch queries with
``readStream`` (file source); tests drive them with ``availableNow``.
"""
