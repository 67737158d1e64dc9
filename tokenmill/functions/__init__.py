"""Column → Column helpers built only from Spark SQL built-ins."""

from tokenmill.functions.text import (  # noqa: F401
    fingerprint,
    normalize_ws,
    pretokens,
    strip_ws,
    utf8_decode,
)
from tokenmill.functions.ids import (  # noqa: F401
    code_units_to_ids,
    id_char,
    ids_to_string,
    latin1_word,
    utf8_byte_ids,
)
