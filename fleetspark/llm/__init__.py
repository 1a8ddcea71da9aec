"""Operators for building training corpora (documents, web pages, benchmarks).

Every module holds one operator with its own general interface; ``queries``
registers the thin ``opN_<name>`` queries. Nothing else in the library imports
this subpackage.
"""
