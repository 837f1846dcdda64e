"""The correctness queries on the driver tables, and their SQL counterparts."""
