"""DataFrame operators; columns are arguments, every result is a DataFrame."""
