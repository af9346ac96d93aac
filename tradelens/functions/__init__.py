"""Column-level helpers (scalar functions, row identity, name cleaning)."""

from .scalars import *  # noqa: F401,F403
from .identity import content_id, uuid_text, with_row_id  # noqa: F401
from .naming import clean_column_name, clean_columns, staging_type, staging_types  # noqa: F401
