"""Plan shapes shared by operators: locations (one or all in one job) and top-k per group."""
