"""Column functions over message fields."""

from .headers import append_headers, epoch_ns_text, header_text, header_value
from .payload import payload_fingerprint

__all__ = [
    "append_headers",
    "epoch_ns_text",
    "header_text",
    "header_value",
    "payload_fingerprint",
]
