"""Operators, queries and SQL for language-model data; nothing else in the package imports this."""
