"""How much of a text repeats itself: characters inside repeated n-grams of words and repeated lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm import wordbytes
from tallyloom.session import spread

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
# Published limits of the repetition rules for web text: share of characters inside n-grams that were found
# before, by n, and inside lines that equal an earlier one.
NGRAMS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
MAX_DUP_LINES = 0.20

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "dup_line_chars long, " + ", ".join(f"dup_{n}gram_chars long" for n in NGRAMS))


def repeated(key: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries have an equal one in their group, and which have one before them."""
    key = wordbytes.mixed(key + group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    later = np.zeros(len(key), bool)
    later[order[1:][same]] = True
    either = later.copy()
    either[order[:-1][same]] = True
    return either, later


def per_text(values: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Sums of values[index[i]:index[i + 1]]."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[index[1:]] - sums[index[:-1]]


def measures(texts: list[bytes]) -> list[np.ndarray]:
    """The columns of SCHEMA after doc_id, for some texts."""
    s = wordbytes.Slice(texts)
    text_of, words = s.text_of_word(), s.hashes()
    inside = (s.data & 0xC0) != 0x80  # first bytes of code points
    inside &= ~wordbytes.WHITE[s.data]
    chars = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    word_chars = chars[s.end] - chars[s.start]
    bounds = np.append(s.begins, len(s.data))
    total = per_text(inside, bounds)
    symbols = per_text(SYMBOLS[s.data], bounds)

    # Lines: a text's line break at its end closes its last line.
    stop = np.flatnonzero(s.data == 10)
    start = np.concatenate([[0], stop[:-1] + 1])
    text_of_line = np.searchsorted(s.ends, start, side="right")
    held = np.flatnonzero(chars[stop] > chars[start])
    key = wordbytes.mixed(s.bytes.of(start[held], stop[held]) + text_of_line[held].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    again = np.ones(len(held), bool)
    again[np.unique(key, return_index=True)[1]] = False  # the first of each stays
    lines = held[again]
    n_lines = np.bincount(text_of_line[lines], minlength=s.n)
    line_chars = np.bincount(text_of_line[lines], chars[stop[lines]] - chars[start[lines]], s.n).astype(np.int64)

    # Windows: those of n words that repeat start where the windows of fewer words inside them repeat.
    rolling = wordbytes.windows(words)
    last = np.repeat(s.first[1:], s.n_words)  # one past the last word of the text
    place, covered, before, hit = np.arange(len(words)), {}, 1, None
    for n in (3, *NGRAMS):
        if hit is not None:
            inner = np.zeros(len(words) + n, np.int64)
            inner[place[hit]] = 1
            sums = np.concatenate([[0], np.cumsum(inner)])
            k = n - before + 1  # shorter windows inside a longer one
            place = place[hit]
            place = place[sums[place + k] - sums[place] == k]
        place = place[place + n <= last[place]]
        hit, later = repeated(rolling.of(place, place + n), text_of[place])
        counted = place[hit if n == 3 else later]  # the base counts the first occurrence too
        edge = np.zeros(len(words) + 1, np.int64)
        edge[counted] += 1
        edge[counted + n] -= 1
        covered[n] = np.cumsum(edge[:-1]) > 0
        before = n
    n_repeat = per_text(covered[3], s.first)
    grams = [per_text(np.where(covered[n], word_chars, 0), s.first) for n in NGRAMS]
    return [s.n_words, total, symbols, n_lines, n_repeat, line_chars, *grams]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for batch in batches:
        texts = wordbytes.binary(batch.column(1))
        for low, high in wordbytes.slices(texts):
            columns = [pa.array(np.asarray(c, np.int64)) for c in measures(texts[low:high])]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *columns], names=names)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, characters inside n-grams of 5 to 10 words and lines that were found
    before in the text, ``base_failed`` (fewer than 50 words, or more than half of them in windows of
    three that repeat) and ``kept`` (base passed, and no share of characters above its limit).

    Windows are compared by a 64-bit rolling hash. Null and empty texts have no words: base_failed. Texts are
    read whole; a task holds some two megabytes of them at once, or one longer text. Null ids and
    repeated rows are kept as they are; an empty table gives no rows; other columns are ignored."""
    found = spread(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).mapInArrow(_measured, SCHEMA)
    words, chars = F.col("n_words"), F.greatest(F.col("word_chars"), F.lit(1))
    failed = (words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * words)
    over = F.col("dup_line_chars") / chars > MAX_DUP_LINES
    for n, most in NGRAMS.items():
        over = over | (F.col(f"dup_{n}gram_chars") / chars > most)
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & ~over)
