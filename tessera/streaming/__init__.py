"""Structured Streaming feeds (KYC and purchases)."""

from tessera.streaming import kyc_stream, purchase_stream

__all__ = ["kyc_stream", "purchase_stream"]
