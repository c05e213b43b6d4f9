"""Operators of a training-data pipeline (chat, tokens, vectors, near duplicates, archives ...).

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds its queries
only when it is installed.
"""
