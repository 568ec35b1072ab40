"""Token ids of texts through the tokenizers library, one call per distinct piece.

A text is cut at places where the tokenizer's own pre-tokenisation always cuts,
so the ids of a text are the ids of its pieces in a row. Each worker process
keeps the ids of the pieces that it has met (bounded by ``limit``; when full it
starts anew), so the library sees each frequent word once.
"""

from __future__ import annotations

import os
import re

import numpy as np

from bizlens.llm.common import gather

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task

#: A whitespace character and then a space: only there is a cut before a space unsafe.
UNSAFE = re.compile(r"\s ")
#: A cut before plain white space that follows anything but white space is always a cut of the pattern.
SAFE_CUT = re.compile(r"(?<=\S)(?=[ \n\t\r])")


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies write for each
    byte: printable Latin-1 bytes stand for themselves, the rest follow from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in own}
    for b in range(256):
        out.setdefault(b, chr(256 + len(out) - len(own)))
    return [out[b] for b in range(256)]


class PieceCache:
    """Maps pieces to rows of a growing ragged array of token ids.

    A piece that is one word of letters (with a space before it, where the
    pattern takes one) is a single match of the pattern, so its bytes go to the
    library's merge model as they are; a full stop or comma after it is a match
    of its own. All other pieces go through the whole tokenizer. ``normalize``
    is the tokenizer's own, None where it has none."""

    def __init__(self, tokenizer, limit: int = 1_000_000):
        self.tokenizer, self.limit = tokenizer, limit
        self.model, self.normalize = tokenizer.model, tokenizer.normalizer and tokenizer.normalizer.normalize_str
        self.letters = dict(enumerate(byte_characters()))
        self.marks = dict(zip(".,", self._whole([".", ","]), strict=True))
        self.clear()

    def _whole(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _word(self, piece: str) -> list[int]:
        if self.normalize:
            piece = self.normalize(piece)
            if not piece.isalpha():  # a letter may become a letter and a mark
                return self._whole([piece])[0]
        return [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]

    def _encode(self, pieces: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(pieces)
        rest = []
        for k, p in enumerate(pieces):
            mark = p[-1:] if p[-1:] in self.marks else ""
            core = p[:-1] if mark else p
            if core[1:].isalpha() and (core[0] == " " or core[0].isalpha()) or core.isalpha():
                out[k] = self._word(core) + self.marks[mark] if mark else self._word(core)
            else:
                rest.append(k)
        for k, ids in zip(rest, self._whole([pieces[k] for k in rest]), strict=True):
            out[k] = ids
        return out

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.data = np.empty(1 << 16, np.uint32)
        self.offsets = np.zeros(1 << 16, np.int64)

    def _add(self, pieces: list[str]) -> None:
        for k in range(0, len(pieces), 4096):
            part = pieces[k : k + 4096]
            ids = self._encode(part)
            n, lens = len(self.index), np.fromiter(map(len, ids), np.int64, len(ids))
            used, more = int(self.offsets[n]), int(lens.sum())
            while n + len(part) + 1 > len(self.offsets):
                self.offsets = np.concatenate([self.offsets, np.zeros_like(self.offsets)])
            while used + more > len(self.data):
                self.data = np.concatenate([self.data, np.empty_like(self.data)])
            self.data[used : used + more] = [x for one in ids for x in one]
            self.offsets[n + 1 : n + 1 + len(part)] = used + np.cumsum(lens)
            self.index.update(zip(part, range(n, n + len(part)), strict=True))

    def ids(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text (a list of pieces)."""
        flat = [p for t in texts for p in t]
        rows = list(map(self.index.get, flat))
        if None in rows:
            new = list(dict.fromkeys(p for p, r in zip(flat, rows, strict=True) if r is None))
            if len(self.index) + len(new) > self.limit:
                self.clear()
                new = list(dict.fromkeys(flat))
            self._add(new)
            rows = list(map(self.index.__getitem__, flat))
        rows = np.fromiter(rows, np.int64, len(rows))
        out, lens = gather(self.offsets, self.data, rows)
        per_text = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.concatenate([[0], np.cumsum(lens)])[np.concatenate([[0], np.cumsum(per_text)])]
        return out, np.diff(ends)


def words(text: str) -> list[str]:
    """Pieces for a tokenizer that drops white space."""
    return text.replace("\n", " ").split(" ")


def spaced_pieces(text: str) -> list[str]:
    """Pieces, each with the white space before it, for a byte-level pattern:
    no match of such a pattern goes on from a non-space to a space."""
    if UNSAFE.search(text):
        return SAFE_CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *map(" ".__add__, rest)]
