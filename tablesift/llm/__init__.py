"""Operators for preparing language-model training data.

Each module holds one operator with its own general interface and the query
``opN_<name>`` that applies it to the given tables.  Nothing outside this
package imports it.
"""
