"""Words of whole texts as spans of bytes, many texts at once; long texts by segments."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from ledgerloom.llm.rolling import row_groups

#: Bytes of texts that are looked at together, and of a segment of a long text.
GROUP, SEGMENT = 1 << 20, 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

#: Which bytes belong to words: anything but ASCII white space; digits, ASCII letters and whatever is not ASCII.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Piece:
    """Texts, or a segment of one, with ASCII letters in lower case; word i of text ``first + row[i]`` is data[start[i]:end[i]]."""

    first: int
    n: int
    data: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    #: Words at the beginning that the segment before had too.
    carried: int = 0
    #: False for a segment of a text of which there are others.
    whole: bool = True


def _spans(inside: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cut = np.zeros(len(inside) + 1, dtype=bool)  # a text begins here
    cut[begins] = True
    start = np.flatnonzero(inside & (cut[:-1] | np.append(True, ~inside[:-1])))
    end = np.flatnonzero(inside & (cut[1:] | np.append(~inside[1:], True))) + 1
    return np.searchsorted(begins, start, side="right") - 1, start, end


def _segments(text: np.ndarray, word: np.ndarray, first: int, overlap: int) -> Iterator[Piece]:
    """Segments end between words; the next begins ``overlap`` words earlier. Only a word longer than a segment makes one longer."""
    at, end, carried = 0, SEGMENT, 0
    while True:
        while end < len(text):
            out = ~word[text[end : end + SEGMENT]]
            if out.any():
                end += int(out.argmax())
                break
            end += SEGMENT
        end = min(end, len(text))
        data = _LOWER[text[at:end]]
        row, start, stop = _spans(word[data], np.array([0, len(data)]))
        if end == len(text):
            yield Piece(first, 1, data, row, start, stop, carried, at == 0)
            return
        if len(start) <= overlap:  # no new word that could make a window
            end += end - at
            continue
        yield Piece(first, 1, data, row, start, stop, carried, False)
        at, carried, end = (at + int(start[-overlap]), overlap, end + SEGMENT) if overlap else (end, 0, end + SEGMENT)


def pieces(data: np.ndarray, offsets: np.ndarray, word: np.ndarray, overlap: int) -> Iterator[Piece]:
    """All words of the texts data[offsets[i]:offsets[i + 1]], whatever their length."""
    for i, j in row_groups(offsets, GROUP):
        if offsets[j] - offsets[i] > SEGMENT:
            yield from _segments(data[offsets[i] : offsets[j]], word, i, overlap)
        else:
            part = _LOWER[data[offsets[i] : offsets[j]]]
            yield Piece(i, j - i, part, *_spans(word[part], offsets[i : j + 1] - offsets[i]))
