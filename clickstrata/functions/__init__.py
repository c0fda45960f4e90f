from clickstrata.functions.events import (
    canonical_event_type,
    category_key,
    event_count,
    is_event,
    parse_event_time,
    purchase_revenue,
    safe_ratio,
    session_key,
    session_label,
)
from clickstrata.functions.stats import chi_square_sf, erfc, two_sided_p

__all__ = [
    "canonical_event_type",
    "category_key",
    "chi_square_sf",
    "erfc",
    "event_count",
    "is_event",
    "parse_event_time",
    "purchase_revenue",
    "safe_ratio",
    "session_key",
    "session_label",
    "two_sided_p",
]
