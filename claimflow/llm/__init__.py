"""Operators for preparing language-model training data.

Thirteen operators on text, vector, page and conversation tables, each in a module
of its own, their registered queries in :mod:`claimflow.llm.queries`.  Nothing
else in the library imports this subpackage.
"""
