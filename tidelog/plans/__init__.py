"""Plan shapes shared by the operators: distributed ordered scans and size-checked lookups."""
