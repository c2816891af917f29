"""Text expressions, and the one per-row helper: where a text is cut into chunks."""

from __future__ import annotations

import re
from bisect import bisect_right

from pyspark.sql import Column, functions as F

# Whitespace in any script, and the four separators that only some engines count.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITESPACE, " "))


def chunk_key(source_file: Column, page_number: Column, chunk_index: Column) -> Column:
    """The stable id of a chunk: the same place in the same file has the same id."""
    return F.md5(F.concat_ws(":", source_file, page_number.cast("string"), chunk_index.cast("string")))


def cut_spans(text: str, size: int, overlap: int, min_advance: bool = False) -> list[tuple[int, int]]:
    """Spans of at most ``size`` characters that cover the text. A span ends after the last
    sentence in reach, else after the last word, else at the limit; the next one starts
    ``overlap`` characters earlier, at least one after the last start. With ``min_advance``
    a cut must lie beyond the overlap, so every span brings new text."""
    ends = [m.start() + 1 for m in re.finditer(r"\. ", text)]
    words = [m.start() + 1 for m in re.finditer(" ", text)]
    spans, start = [], 0
    while text:
        limit = start + size
        if limit >= len(text):
            spans.append((start, len(text)))
            break
        floor = start + (overlap if min_advance else 0) + 1
        # A sentence needs its blank within reach too, hence one character less.
        for cuts, reach in ((ends, limit - 1), (words, limit)):
            last = bisect_right(cuts, reach) - 1
            if last >= 0 and cuts[last] > floor:
                limit = cuts[last]
                break
        spans.append((start, limit))
        start = max(limit - overlap, start + 1)
    return spans
