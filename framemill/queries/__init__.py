"""Query builders and their SQL counterparts for the registry."""
