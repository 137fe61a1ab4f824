"""Operators of a training-data pipeline over document tables.

Nothing else in the library imports this subpackage.  ``QUERIES`` and
``ORACLES`` are loaded on first use, so that a task that needs one operator
does not import the others.
"""

__all__ = ["ORACLES", "QUERIES"]


def __getattr__(name: str):
    if name in __all__:
        from airtrace.llm import queries

        return getattr(queries, name)
    raise AttributeError(name)
