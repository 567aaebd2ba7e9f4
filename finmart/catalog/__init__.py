"""The registered queries: each operator on the given tables, with the SQL that must give the same rows."""

from finmart.catalog import (  # noqa: F401  (registration)
    aggregates,
    cleaning,
    columns,
    io,
    jobs,
    scalars,
)
from finmart.catalog.base import QUERIES, SQL  # noqa: F401
