"""Readers and writers: broker and file streams, seeds, partitioned facts, keyed snapshots."""
