"""Structured Streaming: day-partitioned ingest, periodic search, and search /
insert request streams (all append-only, checkpointed in the shared folder)."""
