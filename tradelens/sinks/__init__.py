"""Sinks: staging tables, idempotent insert, seeding, views and load reports."""

from .tables import StagingTable, create_namespace, drop_tables, ddl_columns  # noqa: F401
from .load import LoadReport, insert_if_absent, insert_new_rows, load_frame, seed_if_empty, seed_table, stage_rows  # noqa: F401
from .views import publish_views, price_gap_view_sql, summary_view_sql  # noqa: F401
