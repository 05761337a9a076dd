"""Readers: delimited deliveries, month tables, the shared test tables, synthetic people."""
