"""Operators of a training-data pipeline over document, page, embedding and conversation tables.

Nothing outside this subpackage imports it.  ``registry`` lists its queries.
"""
