"""Training-data operators: ten self-contained stages for very large text corpora.

Nothing outside this subpackage imports it.  ``queries()`` and
``oracle_sql()`` are what the entry module registers.
"""

from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
