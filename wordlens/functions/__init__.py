"""Native Column helpers (no Python workers)."""

from wordlens.functions.arrays import (
    first_position,
    map_values,
    percent,
    percent_positions,
    positions_of,
    ragged_transpose,
    safe_sequence,
    sub_range,
    with_term_profile,
    trim_pad,
)
from wordlens.functions.tokenise import (
    EOS,
    LEVEL_NAMES,
    N_LEVELS,
    TOKEN_PATTERN,
    level_name,
    regex_tokens,
    token_class,
    whitespace_units,
    with_eos,
)

__all__ = [
    "EOS", "LEVEL_NAMES", "N_LEVELS", "TOKEN_PATTERN",
    "first_position", "level_name", "map_values", "percent", "percent_positions",
    "positions_of", "ragged_transpose", "regex_tokens", "safe_sequence",
    "sub_range", "with_term_profile", "token_class", "trim_pad", "whitespace_units",
    "with_eos",
]
