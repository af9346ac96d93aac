"""Structured Streaming: incremental loads of landed price documents."""

from .price_stream import land_price_docs, stream_price_docs  # noqa: F401
