"""The operators run over the given tables, each with its answer in plain SQL."""
