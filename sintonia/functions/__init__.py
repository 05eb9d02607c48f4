from sintonia.functions.columns import (
    channel_list,
    event_date,
    hour_band,
    is_blank,
    parse_channel_list,
    rating_pct,
    round2,
    share_pct,
)

__all__ = [
    "channel_list",
    "event_date",
    "hour_band",
    "is_blank",
    "parse_channel_list",
    "rating_pct",
    "round2",
    "share_pct",
]
