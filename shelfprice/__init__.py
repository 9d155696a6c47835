"""shelfprice: shop-shelf price analytics on Spark.

Landed listing pages -> 14-column item table -> unit prices -> averages per
store, category and subcategory, plus a crawl audit, HTML reference tables and
daily Parquet / CSV / JDBC outputs.  Every step is a ``DataFrame -> DataFrame``
function; the daily jobs live in ``shelfprice.plans.jobs`` and run from the
command line with ``python -m shelfprice``.
"""

from .operators.aggregates import average_unit_prices, crawl_coverage, unit_price_sums
from .operators.items import keep_first
from .operators.prices import price_rows
from .operators.stores import with_city
from .plans import jobs
from .session import get_session
from .sources.daily import read_daily
from .sources.html_tables import html_first_table
from .sources.landing import read_landed_pages

__all__ = [
    "average_unit_prices", "crawl_coverage", "get_session", "html_first_table", "jobs",
    "keep_first", "price_rows", "read_daily", "read_landed_pages", "unit_price_sums", "with_city",
]
