"""Token ids of whole texts by the tokenizers library, a batch at a time."""

from __future__ import annotations

import os
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Pieces whose ids a worker remembers at once, and the longest of them: some 200 MB at most.
REMEMBERED, REMEMBERED_LENGTH = 1_000_000, 48
# Pieces sent to the library in one call.
ASKED = 20_000
# The endings that both kinds of files cut off after an apostrophe, beside runs of letters, of other signs, and of digits
# (single digits where white space is dropped).
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")
# Characters that mean the same to the library and here: their classes and lower case are those of all versions of
# Unicode, they are no decomposed letters, and of white space they have the blank, the tab and line ends. Not among
# them: capital sigma and dotted capital I (special lower cases), combining marks, and signs that NFC replaces.
PLAIN = r"\t\n\r -~\x{A1}-\x{12F}\x{131}-\x{2FF}\x{370}-\x{373}\x{375}-\x{37D}\x{37F}-\x{386}\x{388}-\x{3A2}\x{3A4}-\x{482}\x{48A}-\x{52F}\x{2010}-\x{2027}\x{20AC}"
WHITE, LETTER, DIGIT, SIGN, EDGE = range(5)


def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": DIGIT}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], SIGN) for c in range(0x20AD)], np.uint8)
    table[[9, 10, 13, 32]], table[0] = WHITE, EDGE
    return table


class Ids:
    """The ids of texts, as ``Tokenizer.encode`` gives them without special tokens added.

    Numpy cuts the texts of a batch into pieces as the file's pattern does, Arrow finds the distinct ones, only pieces not seen
    before reach the library, and numpy lays their ids out. A text with other characters than ``PLAIN`` or with a special
    string goes to the library whole, since the cuts could differ there.

    Pickles as its path. Sent as a broadcast, a worker process loads the file once and keeps what it remembers
    from task to task."""

    def __init__(self, path: str):
        self.path, self.library, self.known = path, None, {}

    def __reduce__(self):
        return type(self), (self.path,)

    def _load(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = Tokenizer.from_file(self.path)
        kind = type(self.library.pre_tokenizer).__name__, type(self.library.normalizer).__name__
        if kind not in (("ByteLevel", "NoneType"), ("Sequence", "Sequence")):
            raise ValueError(f"{self.path} cuts texts in an unknown way")
        self.lower, self.classes = kind[1] == "Sequence", _classes()
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.odd = "|".join([f"[^{PLAIN}]", *("".join(f"[{c}]" if c != "^" else r"\^" for c in s) for s in special)])

    @property
    def size(self) -> int:
        """One more than the largest id."""
        self.library or self._load()
        return self.library.get_vocab_size()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end (null: none), and where each text's begin, with the end of the last."""
        self.library or self._load()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, self.odd)
        plain = pc.if_else(odd, "", texts)
        cut, edges = self._cut((pc.utf8_lower(plain) if self.lower else plain).to_pylist())
        pieces = cut.dictionary_encode()
        held = self._ids(pieces.dictionary.to_pylist())
        lengths = np.fromiter((len(h) >> 2 for h in held), np.int64, len(held))
        begins = np.cumsum(lengths) - lengths
        at = pieces.indices.to_numpy()
        counts = lengths[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        flat = np.frombuffer(b"".join(held), "<u4")[np.repeat(begins[at] - ends + counts, counts) + np.arange(total)]
        offsets = ends[edges]
        rest = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(rest):
            parts = np.split(flat, offsets[1:-1])
            for i in rest:
                parts[i] = np.array(self.library.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4")
            flat = np.concatenate(parts)
            offsets = np.cumsum([0, *map(len, parts)])
        return flat, offsets

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """All pieces in order, a zero character before the first text and after each, and the places of these."""
        whole = "\x00".join(["", *texts, ""])
        codes = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        kind = self.classes[codes]
        before, after = np.roll(kind, 1), np.roll(kind, -1)  # the first and the last character are edges
        white = kind == WHITE
        begins = kind != before
        begins |= kind == EDGE
        sure = before != SIGN  # an apostrophe here starts a piece
        if self.lower:
            begins |= kind == DIGIT
        else:
            begins |= white & (after != WHITE) & (after != EDGE)  # the last of some white space stands alone
            joined = np.roll(codes == 32, 1) & ~white & (kind != EDGE)  # or is a blank that joins what follows
            begins &= ~joined
            sure &= ~joined
        marks = np.flatnonzero((codes == ord("'")) & sure)
        for ending in ENDINGS:
            hit = marks
            for i, letter in enumerate(ending, 1):
                hit = hit[codes[hit + i] == ord(letter)]
            begins[hit + 1] = False
            begins[hit + len(ending) + 1] = True
        begins[0] = True
        width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800)
        offsets = np.append((np.cumsum(width) - width)[begins], width.sum())
        data = pa.py_buffer(whole.encode())
        pieces = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), data)
        return pieces, np.flatnonzero(kind[begins] == EDGE)

    def _ids(self, pieces: list[str]) -> list[bytes]:
        known = self.known
        blank = "\x00 \t\n\r" if self.lower else "\x00"
        ask = [p for p in pieces if p not in known and p[0] not in blank]
        if len(known) + len(ask) > REMEMBERED:
            known = self.known = {p: known[p] for p in pieces if p in known}
        for at in range(0, len(ask), ASKED):
            part = ask[at:at + ASKED]
            for p, e in zip(part, self.library.encode_batch_fast(part, add_special_tokens=False)):
                known[p] = array("I", e.ids).tobytes()
        out = [b"" if p[0] in blank else known[p] for p in pieces]
        for p in ask:
            if len(p) > REMEMBERED_LENGTH:
                del known[p]
        return out
