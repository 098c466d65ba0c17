"""Cutting texts into segments that a byte-level BPE with the usual word pattern encodes independently.

The pattern never matches across the border between a character that is no white space and one that is.  So a text
may be cut before every white space that follows another character; the few distinct segments are encoded once and
looked up.
"""

from __future__ import annotations

import re
import string
from itertools import chain

import numpy as np

#: Unicode's White_Space, as the word pattern has it (Python's own \\s has four control characters more).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BORDER = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")
_RARE = [c for c in map(chr, range(0x3001)) if re.match(f"[{SPACE}]", c) and c not in " \n"]
_WHITE = frozenset([*_RARE, " ", "\n"])


def _plain(text: str) -> list[str] | None:
    """The words of a text in which all white space is single spaces and line breaks, none beside another or at the
    end: a word after a line break begins with it, any other but the first had a space before it.  None for other
    texts."""
    for c in _RARE:
        if c in text:
            return None
    words = text.replace("\n", " \n").split(" ")
    rest = words[1:]
    return None if "" in rest or "\n" in rest else words


def _segment(word: str) -> str:
    return word if word[0] == "\n" else " " + word


def _segment_or_space(word: str) -> str:
    return _segment(word) if word else " "


def segments(text: str) -> list[str]:
    """The segments of a text, in order; joined they are the text."""
    words = _plain(text)
    if words is None:
        return _BORDER.split(text)
    return words[:1] * bool(words[0]) + [_segment(w) for w in words[1:]]


_BESIDE = "  ", " \n", "\n ", "\n\n"


def _odd(text: str) -> bool:
    """Whether a text has white space beside other white space, at its end, or of another kind than these two."""
    return text.endswith((" ", "\n")) or any([x in text for x in _BESIDE]) or any([c in text for c in _RARE])


def _marked(words: list[str]) -> dict[int, str]:
    """By place, those words without the punctuation at their end that may be cut there: the pattern never matches
    across the border between a letter or a digit and what is neither."""
    short = [w.rstrip(string.punctuation) for w in words]
    # what is a letter or a digit below U+0500 is the same in any Unicode version since 7
    return {i: c for i, (w, c) in enumerate(zip(words, short))
            if len(w) != len(c) and c and c[-1] < "\u0500" and c[-1].isalnum()}


class SegmentCache:
    """Segment -> what ``encode(list of segments)`` gives for it.  About ``limit`` entries are kept: those used since
    the last half of them came in, and the half before."""

    def __init__(self, encode, limit: int = 800_000):
        self.encode, self.limit = encode, limit
        self.after: tuple[dict, dict] = {}, {}  # by the words that follow a space or begin with a line break
        self.whole: tuple[dict, dict] = {}, {}  # by other segments

    def _values(self, caches: tuple[dict, dict], wanted: list, segment) -> tuple[tuple[dict, dict], list]:
        """The caches with every one of the wanted words in the younger one, and the words' values in order."""
        young, old = caches
        if len(young) + len(wanted) > self.limit // 2:
            young, old = {}, young
        values = list(map(young.get, wanted))
        missing = [i for i, v in enumerate(values) if v is None]
        if missing:
            new = list(dict.fromkeys([wanted[i] for i in missing]))
            found = list(map(old.get, new))
            unknown = [w for w, v in zip(new, found) if v is None]
            coded = iter(self.encode([segment(w) for w in unknown]) if unknown else ())
            young.update(zip(new, [next(coded) if v is None else v for v in found]))
            for i in missing:
                values[i] = young[wanted[i]]
        return (young, old), values

    @staticmethod
    def _cut(texts: list[str]):
        """``(odd, words, word, cut)``: the places of odd texts; the different words of the others, told apart by Arrow
        so that Python sees each once; the places of all their words in ``words``, in order, and where each text's
        begin among them (one more than such texts)."""
        import pyarrow as pa
        import pyarrow.compute as pc

        odd = [i for i, t in enumerate(texts) if _odd(t)]
        skip = set(odd)
        plain = [t for i, t in enumerate(texts) if i not in skip] if odd else texts
        lists = pc.split_pattern(pc.replace_substring(pa.array(plain, pa.large_string()), "\n", " \n"), " ")
        coded = lists.values.dictionary_encode()
        # by NumPy: to_pylist takes microseconds a value
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        return odd, words, coded.indices.to_numpy(), lists.offsets.to_numpy()

    def joined(self, texts: list[str], end: bytes = b""):
        """For each text, the values (bytes) of its segments, joined, and ``end``, as an Arrow binary array.

        Punctuation at the end of a word is looked up by itself, so that a word is encoded and kept once whatever
        follows it; Arrow takes and joins the values, with no Python object a word or a text.
        """
        import pyarrow as pa

        odd, words, word, cut = self._cut(texts)
        marked = _marked(words)
        marks = [words[i][len(core) :] for i, core in marked.items()]
        first = [words[k] for k in word[cut[:-1]].tolist()]
        others = [_BORDER.split(texts[i]) for i in odd]
        cores = words.copy()
        for i, core in marked.items():
            cores[i] = core
        whole = list(dict.fromkeys(chain(marks, filter(None, first), *others)))
        self.after, values = self._values(self.after, cores, _segment_or_space)
        self.whole, of_whole = self._values(self.whole, whole, str)
        place = dict(zip(whole, range(len(whole))))
        for i, mark in zip(marked, marks):
            values[i] += of_whole[place[mark]]
        place = {s: len(words) + k for s, k in place.items()}
        place[""] = len(words) + len(whole)  # no text's first word
        values += [*of_whole, b"", end]
        word, ending = word.astype(np.int64), len(values) - 1
        word[cut[:-1]] = list(map(place.__getitem__, first))
        takes = [np.insert(word, cut[1:], ending)]
        stops = [cut[1:] + np.arange(1, len(cut))]
        for some in others:
            takes.append(np.array([*map(place.__getitem__, some), ending], np.int64))
        if odd:
            stops.append(stops[0][-1:].sum() + np.cumsum([len(t) for t in takes[1:]]))
        taken = pa.array(values, pa.large_binary()).take(pa.array(np.concatenate(takes)))
        at = np.frombuffer(taken.buffers()[1], np.int64)[np.concatenate([[0], *stops])]
        out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(at), taken.buffers()[2]])
        if odd:
            order = np.empty(len(texts), np.int64)
            order[np.concatenate([np.delete(np.arange(len(texts)), odd), odd])] = np.arange(len(texts))
            out = out.take(pa.array(order))
        return out.cast(pa.binary())

    def looked_up(self, texts: list[str]) -> tuple[list, list[list[int]]]:
        """``(values, places)``: the values of the different segments of all texts, and for each text the places in
        ``values`` of its segments in order.
        """
        odd, words, word, cut = self._cut(texts)
        skip = set(odd)
        plain = [i for i in range(len(texts)) if i not in skip]
        self.after, values = self._values(self.after, words, _segment_or_space)
        place: dict[str, int] = {}
        of = lambda s: place.setdefault(s, len(words) + len(place))
        places: list = [None] * len(texts)
        for i, a, z in zip(plain, cut[:-1].tolist(), cut[1:].tolist()):
            first = words[word[a]]
            places[i] = ([of(first)] if first else []) + word[a + 1 : z].tolist()
        for i, text in enumerate(texts):
            if places[i] is None:
                places[i] = [of(s) for s in _BORDER.split(text)]
        self.whole, others = self._values(self.whole, list(place), str)
        return values + others, places

    def many(self, texts: list[str]) -> list[list]:
        """For each text, the values of its segments in order."""
        values, places = self.looked_up(texts)
        return [[values[k] for k in some] for some in places]


def joinable(some: list[str]) -> dict[str, list[int]]:
    """The places of segments that may be joined: by ``""`` those that begin with white space and end without, by
    ``"\\n"`` those without at either end; ``"alone"`` the others."""
    kinds: dict[str, list[int]] = {"": [], "\n": [], "alone": []}
    for i, s in enumerate(some):
        kinds["alone" if not s or s[-1] in _WHITE else "" if s[0] in _WHITE else "\n"].append(i)
    return kinds


def encode_joined(some: list[str], encode, id_bytes: np.ndarray, dtype: str, at_once: int = 100) -> list[bytes]:
    """The ids of each segment as bytes, by few calls of ``encode(list of texts) -> lists of ids``.

    Segments that begin with white space and end without are joined as they are, those without white space at either
    end by line breaks: all these borders are the pattern's own.  The ids are parted again by the bytes that each
    stands for (``id_bytes``).  Other segments are encoded one by one.
    """
    out: list = [None] * len(some)
    kinds = joinable(some)
    for i, ids in zip(kinds["alone"], encode([some[i] for i in kinds["alone"]])):
        out[i] = np.array(ids, dtype).tobytes()
    width = np.dtype(dtype).itemsize
    for glue in ("", "\n"):
        which = kinds[glue]
        if not which:
            continue
        parts = [some[i] for i in which]
        coded = encode([glue.join(parts[a : a + at_once]) for a in range(0, len(parts), at_once)])
        ids = np.fromiter(chain.from_iterable(coded), np.int64)
        ends = np.concatenate(([0], np.cumsum(id_bytes[ids])))
        size = np.fromiter(map(len, map(str.encode, parts)), np.int64, len(parts))
        after = np.full(len(parts), len(glue))
        after[at_once - 1 :: at_once] = 0  # nothing after the last of a group
        begin = np.cumsum(size + after) - size - after
        first, last = np.searchsorted(ends, begin), np.searchsorted(ends, begin + size)
        data = ids.astype(dtype).tobytes()
        for i, a, z in zip(which, (first * width).tolist(), (last * width).tolist()):
            out[i] = data[a:z]
    return out


def batches_of_text(values, n_bytes: int = 4 << 20):
    """Slices of a list of texts of about ``n_bytes`` each (one text at least)."""
    begin, size = 0, 0
    for i, v in enumerate(values):
        size += len(v)
        if size >= n_bytes:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(values):
        yield begin, len(values)
