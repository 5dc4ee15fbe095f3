"""The queries the driver runs, with their SQL counterparts."""
