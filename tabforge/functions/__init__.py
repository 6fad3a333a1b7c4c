"""Pure ``Column -> Column`` functions; all run as JVM expressions (codegen)."""

from tabforge.functions.coerce import (  # noqa: F401
    coerce_by_dtype,
    safe_boolean,
    safe_double,
    safe_long,
    safe_string,
    safe_timestamp,
)
from tabforge.functions.mapping import (  # noqa: F401
    decode_label,
    encode_label,
    map_with_default,
    whitelist,
)
from tabforge.functions.text import (  # noqa: F401
    ascii_fold,
    cell_is_valid,
    is_missing,
    na_to_null,
    strip_symbols,
)
