"""Column-expression helpers (JVM-side, codegen-friendly; no Python UDFs)."""

from quarry.functions.columns import half_up_pct, hash_order_key, suffix_label  # noqa: F401
from quarry.functions.logs import log_fields, log_parts, parse_log_frame, render_log_line  # noqa: F401
