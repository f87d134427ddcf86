"""All named queries.  Importing this package registers them."""

from millrace.queries import (basics, demand, files, forecast, joins, quality, ranking, scalars,  # noqa: F401
                              streams, totals, trips, warehouse)
from millrace.queries.registry import QUERIES, SQL  # noqa: F401
