"""The layer chain, the registered queries and their SQL counterparts."""
