"""Operators of a training-data pipeline over the corpus tables.

Ten independent operators (one module each), their registered queries
(``queries``) and helpers shared by them (``common``).  Nothing else in the
package imports this subpackage.
"""
