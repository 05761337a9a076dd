"""Writers: idempotent partition replacement, run audit, table registration."""
