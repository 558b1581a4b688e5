"""Column-level helpers. Everything here returns a ``Column`` and stays in the JVM."""

from millrace.functions.casts import LENIENT_TYPES, lenient_cast, strict_cast
from millrace.functions.hashing import checksum16, content_hash, row_hash
from millrace.functions.numeric import cents_to_dollars, dollars_to_cents, percent_of, rate
from millrace.functions.text import blank_to_null, is_blank, python_text, strip
from millrace.functions.time import seconds_between, utc_literal

__all__ = [
    "LENIENT_TYPES",
    "blank_to_null",
    "cents_to_dollars",
    "checksum16",
    "content_hash",
    "dollars_to_cents",
    "is_blank",
    "lenient_cast",
    "percent_of",
    "python_text",
    "rate",
    "row_hash",
    "seconds_between",
    "strict_cast",
    "strip",
    "utc_literal",
]
