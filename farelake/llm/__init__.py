"""Operators for preparing language-model training data.

Each module holds one operator; `queries` registers them over the given tables. Nothing outside this
package imports it.
"""
