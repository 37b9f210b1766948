"""Operators that prepare text for language-model training.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its queries when it is present.
"""
