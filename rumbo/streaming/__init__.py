"""Incremental runs.

The source rules are daily batch queries with no streaming semantics
(no watermark, window or state).  The one incremental idea in them is the
daily contract load, which only looks at contracts started since the
previous run; ``daily_contracts`` runs that load over newly arrived contract
files with Structured Streaming (``availableNow`` micro-batches).
"""
