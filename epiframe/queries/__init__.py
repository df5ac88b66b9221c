"""Every operator as a query over the driver tables, with DuckDB SQL where SQL can say it."""

from epiframe.queries import catalog, geometry, io, joins, rows, sequence, stats, streams  # noqa: F401
from epiframe.queries.base import QUERIES, SQL  # noqa: F401
