"""Incremental arrival of deliveries."""
