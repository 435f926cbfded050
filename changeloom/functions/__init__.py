"""Column functions: pure expressions, no Python at run time."""

from .codec import (  # noqa: F401
    decimal_from_base64,
    decimal_from_bytes,
    decode_decimal,
    wire_body,
    wire_is_framed,
    wire_schema_id,
)
from .hashing import seeded_int, seeded_unit  # noqa: F401
from .text import (  # noqa: F401
    duration_text,
    format_ts_ms,
    op_name,
    table_short_name,
    topic_parts,
)
