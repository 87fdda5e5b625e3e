"""Where files come from and where page images go."""
