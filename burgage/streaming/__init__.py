"""Permit cleaning on a stream of landed files.

Cleaning needs no state: every row stands alone, so the batch functions apply unchanged and no
watermark is involved. Rows that do not convert and rows without a date are stored as well.
Reports are then run on the stored, growing table.
"""

from .landing import clean_permits_stream, permits_stream, store_permits, store_stream

__all__ = ["clean_permits_stream", "permits_stream", "store_permits", "store_stream"]
