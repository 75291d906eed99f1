from .scalars import (
    display_name,
    first_truthy,
    head,
    json_numbers,
    micro,
    micro_mean,
    norm_text,
    norm_tokens,
    np_round,
    or_empty,
    safe_ratio,
    stable_hash,
    strip,
    title_case,
    tokens,
)
from .timefns import day_bounds, epoch_to_timestamp, iso_utc, parse_published_at, week_start

__all__ = [
    "day_bounds", "display_name", "epoch_to_timestamp", "first_truthy", "head", "iso_utc",
    "json_numbers", "micro", "micro_mean", "norm_text", "norm_tokens", "np_round", "or_empty", "parse_published_at",
    "safe_ratio", "stable_hash", "strip", "title_case", "tokens", "week_start",
]
