"""DataFrame -> DataFrame operators; no I/O and no actions."""
