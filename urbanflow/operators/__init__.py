"""DataFrame -> DataFrame operators; columns are parameters, and only sinks write."""
