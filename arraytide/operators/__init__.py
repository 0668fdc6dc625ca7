"""DataFrame -> DataFrame operators. Column names, thresholds and block sizes are keyword arguments."""
