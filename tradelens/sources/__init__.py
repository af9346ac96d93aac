"""Sources: the driver tables mapped onto trades / coin prices, table scans
with load windows, and price-history documents."""

from .fixtures import (load_events, trades_from_events, coin_prices_from_events, fixture_tables,
                       price_points_from_events)  # noqa: F401
from .trades import trades_month_to_date, trades_prev_day, trade_window  # noqa: F401
from .prices import (price_window, init_price_window, update_price_window, explode_price_docs,  # noqa: F401
                     parse_price_docs, read_price_docs, price_docs_from_prices)
