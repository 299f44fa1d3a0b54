"""Stand-in tables, registered queries and their SQL counterparts over the test tables."""
