"""Every operator as a query over the given tables, with SQL to check it against.

``QUERIES[name]`` takes (spark, folder) and returns a DataFrame; ``ORACLE[name]``
is the same result in plain SQL where SQL can express it. ``AREAS[name]`` tells
which inventory ids the query covers.
"""

from evenkeel.catalogue import (  # noqa: F401  (importing registers the queries)
    checks, decisions, expressions, exploring, filed, learned, marts, shaping,
)
from evenkeel.catalogue.registry import AREAS, ORACLE, QUERIES  # noqa: F401
