"""The tokenizers of ``operators.metrics`` (13a, zh; U6) on the code points of an Arrow batch.

Same tokens as the regular expressions there, which rewrite a whole string for each rule. Here one table gives each character's class and
the rules become places where a token is cut: around the punctuation of the first rule (and CJK characters, for zh), around a hyphen after a digit, and
in runs of full stops and commas, where a run's length and neighbours say what the rules' matches, which don't overlap, cut off.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from parley.functions.tokenize import codepoints

SPACE, MARK, STOP, DIGIT, HYPHEN, CJK = 1, 2, 4, 8, 16, 32
# Python's white space; the first rule's characters; the blocks that zh isolates.
_RANGES = {
    SPACE: [(0x9, 0xd), (0x1c, 0x20), (0x85, 0x85), (0xa0, 0xa0), (0x1680, 0x1680), (0x2000, 0x200a), (0x2028, 0x2029), (0x202f, 0x202f),
            (0x205f, 0x205f), (0x3000, 0x3000)],
    MARK: [(0x21, 0x26), (0x28, 0x2b), (0x2f, 0x2f), (0x3a, 0x40), (0x5b, 0x60), (0x7b, 0x7e)],
    STOP: [(0x2c, 0x2c), (0x2e, 0x2e)], DIGIT: [(0x30, 0x39)], HYPHEN: [(0x2d, 0x2d)],
    CJK: [(0x2e80, 0x303f), (0x3100, 0x312f), (0x31a0, 0x31ef), (0x3200, 0x4dbf), (0x4e00, 0x9fff), (0xf900, 0xfaff), (0xfe10, 0xfe1f),
          (0xfe30, 0xfe4f), (0xff00, 0xffef)],
}
CLASSES = np.zeros(0x110000, np.uint8)
for _bit, _spans in _RANGES.items():
    for _a, _b in _spans:
        CLASSES[_a:_b + 1] |= _bit
#: 13a's replacements, in order
REPLACED = (("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))


def _numbers(points: np.ndarray) -> np.ndarray:
    """Numbers from 0 for the code points in use."""
    used = np.zeros(int(points.max()) + 1 if len(points) else 0, bool)
    used[points] = True
    return (np.cumsum(used) - 1)[points]


def _per_text(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many places of each text are flagged."""
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])[ends], prepend=0).astype(np.int64)


def characters(points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the characters but white space, how many each text has)."""
    ink = CLASSES[points] & SPACE == 0
    return _numbers(points[ink]), _per_text(ink, np.cumsum(sizes))


def replaced(texts: pa.Array) -> pa.Array:
    """``texts`` itself where nothing is to be replaced."""
    for mark in ("<skipped>", "\n", "&"):
        if mark.encode() in bytes(texts.buffers()[2] or b""):
            for old, new in REPLACED:
                if mark in old:
                    texts = pc.replace_substring(texts, old, new)
    return texts


def _cuts(points: np.ndarray, cls: np.ndarray, start: np.ndarray, zh: bool) -> np.ndarray:
    """Whether a token is cut before each character (one more place at the end). ``start``: a text begins there."""
    cut, alone = start.copy(), cls & (MARK | CJK if zh else MARK) > 0
    hyphens = np.flatnonzero(cls & HYPHEN)
    hyphens = hyphens[~start[hyphens]]
    alone[hyphens[cls[hyphens - 1] & DIGIT > 0]] = True
    cut[:-1] |= alone
    cut[1:] |= alone
    stops = np.flatnonzero(cls & STOP)
    if len(stops):
        inner = np.append(False, np.diff(stops) == 1) & ~start[stops]
        cut[stops[inner]] = True
        first = np.flatnonzero(~inner)
        length = np.diff(np.append(first, len(stops)))
        a, z = stops[first], stops[first] + length   # a run's first place, the one after its last
        # a text's edge: 13a puts a space there; for zh no rule matches beyond it, as if a digit stood there
        before = np.where(start[a], zh, cls[a - 1] & DIGIT > 0)
        after = np.where(start[z], zh, cls[np.minimum(z, len(cls) - 1)] & DIGIT > 0)
        cut[a] |= ~(before & after & (length == 1))
        cut[z] |= ~after | (length % 2 != before)
    return cut


def tokens(points: np.ndarray, sizes: np.ndarray, zh: bool) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the tokens of all texts, how many each text has); equal tokens have equal numbers, counted from 0. For zh the texts are trimmed."""
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(len(sizes), np.int64)
    ends, cls = np.cumsum(sizes), CLASSES[points]
    start = np.zeros(len(points) + 1, bool)
    start[0] = True
    start[ends] = True
    begins = _cuts(points, cls, start, zh)[:-1]
    ink = cls & SPACE == 0
    begins[1:] |= ~ink[:-1]
    begins &= ink
    counts, chars, first = _per_text(begins, ends), points[ink], np.flatnonzero(begins[ink])
    length = np.diff(np.append(first, len(chars)))
    long = length > 1
    if 2 * np.count_nonzero(long) > len(long):
        return _encoded(chars, length), counts
    out = np.zeros(len(first), np.int64)
    out[~long] = _numbers(chars[first[~long]])
    if long.any():
        out[long] = _encoded(chars[np.repeat(long, length)], length[long]) + (out.max() + 1)
    return out, counts


def _encoded(chars: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Numbers of the tokens that lie end to end."""
    chars = chars.astype(np.uint8) if int(chars.max()) < 256 else chars.astype(np.uint32)
    at = np.concatenate([[0], np.cumsum(length)]) * chars.itemsize
    tokens = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(at), pa.py_buffer(chars)])
    return tokens.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _edged(points: np.ndarray, sizes: np.ndarray) -> bool:
    """Whether a text begins or ends with a space."""
    ends = np.cumsum(sizes)[sizes > 0]
    return bool((points[ends - 1] == 32).any() or (points[ends - sizes[sizes > 0]] == 32).any())


def side_units(texts: pa.Array, zh: bool) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """The ``tokens`` and the ``characters`` of texts of one tokenizer. Null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    points, sizes = codepoints(texts)
    of = replaced(texts) if not zh else pc.utf8_trim(texts, " ") if _edged(points, sizes) else texts
    return tokens(*(codepoints(of) if of is not texts else (points, sizes)), zh), characters(points, sizes)
