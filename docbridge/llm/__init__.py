"""Operators for large-scale training-data pipelines.

Each module holds one operator with a general interface; ``queries`` derives the
digest columns of the registered ``opN_`` queries from them.  Nothing else in the
package imports this subpackage.
"""
