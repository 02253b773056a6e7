"""The jobs run over the given tables: what they read is derived here, row by row."""
