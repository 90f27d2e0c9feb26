"""Jobs that run end to end, and the registered queries with their SQL counterparts."""
