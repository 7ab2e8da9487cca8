"""Operators a training-data pipeline needs, over ``documents``, ``pages`` and ``benchmark``.

Nothing else in the library imports this package; it imports only general helpers
(``strata.session``).  One module per operator, ``queries.py`` registers them.
"""
