"""commerce_marts — a Spark-native commerce data-mart library.

Raw order / item / customer / product / seller / payment / review sources are
cleaned, deduplicated and modelled into a star schema (calendar, customer,
product and seller dimensions plus an order-item fact), into sales, product
and delivery marts, BI result sets and data-quality reports.  Every operator
takes and returns DataFrames; the work runs on Spark's SQL engine.

Layout
------
sources/    schemas, CSV/parquet readers and writers, driver-table bindings
functions/  column-level helpers (rounding, bands, date keys, delivery days)
operators/  generic DataFrame operators (dedup, surrogate keys, calendar,
            aggregates, quality checks)
plans/      the concrete models composed from the operators (staging,
            warehouse, marts, reports, quality)
"""

from commerce_marts.session import ensure_checkpoint_dir, get_session

__all__ = ["ensure_checkpoint_dir", "get_session"]
