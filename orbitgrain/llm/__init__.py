"""Operators for preparing language-model training data, one module each.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds the
queries listed in :mod:`orbitgrain.llm.registry` when it is present.
"""
