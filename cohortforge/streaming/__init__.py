"""Structured Streaming form of the incremental hash-bin split."""

from cohortforge.streaming.bin_split import batch_writer, start_bin_split, stream_hash_bins

__all__ = ["batch_writer", "start_bin_split", "stream_hash_bins"]
