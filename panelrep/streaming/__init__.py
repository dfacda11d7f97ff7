"""Streaming: incremental scenario ingest (see :mod:`panelrep.streaming.ingest`)."""
