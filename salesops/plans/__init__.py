"""The sales model, its cleaning job, its reports, and the checks on the given tables."""
