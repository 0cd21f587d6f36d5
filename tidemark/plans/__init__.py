"""Layered models: bronze decoding, staging, silver, gold, serving queries and the refresh run."""
