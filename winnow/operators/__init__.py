"""DataFrame operators; names of columns and thresholds are arguments."""
