"""Every query of the engine by name, with the SQL that gives the same rows."""

from __future__ import annotations

from . import domain_queries as _domain  # registers its queries, as does the next
from . import more_queries as _more
from .queries import QUERIES, SQL


assert _domain and _more


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
