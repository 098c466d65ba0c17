"""Personal data: transducers rewrite disguises into plain characters, detectors read the plain text, and the spans
they find are mapped back to the characters of the source.

A ``Tape`` is a text of which every character knows the source characters that it stands for.  Each transducer takes a
tape and gives a tape: look-alike characters, spelled digits, marks for ``@`` and ``.``.  All of them, and the detectors,
pass over a text once, whatever it holds.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import forget_worker_caches, read_table, ship

KINDS = ("email", "ip", "card", "phone")

# --- detectors -------------------------------------------------------------------------------------------------------

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, ``@``, dotted domain: found by the ``@``, the local part read backwards, so that
    a long run of letters without ``@`` is not read from each of its places."""
    out, before = [], 0
    for m in _DOMAIN.finditer(text):
        a = m.start()
        while a > before and text[a - 1] in _LOCAL:
            a -= 1
        before = m.start() + 1  # the local part of a later match has no @ in it
        if a < m.start():
            out.append((a, m.end()))
            before = m.end()
    return out


def _ips(text: str) -> list[tuple[int, int]]:
    # a part of more than 1,000 digits need not be read as a number: without leading zeros it is over 255
    small = lambda p: len(p := p.lstrip("0")) < 4 and int(p or 0) <= 255
    return [m.span() for m in _IP.finditer(text) if all(map(small, m.group().split(".")))]


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(m.span())
    return out


def _phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m.group())) <= 15]


def detect(text: str) -> dict[str, list[tuple[int, int]]]:
    """The spans of each kind in a plain text: leftmost, not overlapping within a kind; matches that fail the kind's
    check (parts at most 255; 13 to 19 digits passing Luhn; 9 to 15 digits) are dropped and not tried again."""
    return {
        "email": _emails(text) if "@" in text else [],
        "ip": _ips(text),
        "card": _cards(text),
        "phone": _phones(text) if "+" in text else [],
    }


# --- tapes and transducers -------------------------------------------------------------------------------------------


class Tape:
    """A text whose character ``i`` stands for the source characters ``start[i]`` to ``end[i]`` (exclusive)."""

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None):
        self.text = text
        self.start = np.arange(len(text)) if start is None else start
        self.end = self.start + 1 if end is None else end

    def rewritten(self, edits: list[tuple[int, int, str]]) -> Tape:
        """The tape with ``text[a:b]`` replaced by ``new`` for each edit ``(a, b, new)``, in order and not overlapping.
        Every new character stands for all that the replaced ones stood for."""
        if not edits:
            return self
        parts, start, end, at = [], [], [], 0
        for a, b, new in edits:
            parts += [self.text[at:a], new]
            start += [self.start[at:a], np.full(len(new), self.start[a])]
            end += [self.end[at:a], np.full(len(new), self.end[b - 1])]
            at = b
        parts.append(self.text[at:])
        start.append(self.start[at:])
        end.append(self.end[at:])
        return Tape("".join(parts), np.concatenate(start), np.concatenate(end))

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a]), int(self.end[b - 1])


# Letters of other scripts that look like Latin ones, dashes and dots of other scripts.
LOOK_ALIKES = {
    "a": "аɑα", "b": "Ьƅ", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іıɩι", "j": "ј", "k": "κ",
    "l": "ӏ", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "τ", "u": "υս", "v": "ѵν", "w": "ԝѡ",
    "x": "хχ", "y": "уγ", "z": "ᴢ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "D": "Ꭰ", "E": "ЕΕ", "G": "Ԍ", "H": "НΗ", "I": "ІΙӀ", "J": "Ј", "K": "КΚ", "L": "Ꮮ",
    "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "Q": "Ԛ", "S": "Ѕ", "T": "ТΤ", "V": "Ѵ", "W": "Ԝ", "X": "ХΧ", "Y": "ҮΥ",
    "Z": "Ζ",
    "-": "‐‑‒–—―−⁃", ".": "。｡∙·․", "+": "✚➕",
}


@lru_cache(None)
def _plain_of() -> np.ndarray:
    """Code point -> the plain character it is read as; itself where it is no disguise; 0 where it is invisible.

    Besides the listed look-alikes: characters that Unicode's compatibility form makes one ASCII character (full-width,
    mathematical, superscript, circled letters and digits), decimal digits of all scripts, and format characters.
    """
    table = np.arange(0x110000, dtype=np.uint32)
    for cp in range(0x80, 0x20000):
        c = chr(cp)
        kind = unicodedata.category(c)
        if kind in ("Cn", "Lo", "Cs", "Co"):
            continue
        same = unicodedata.normalize("NFKC", c)
        if kind == "Cf":
            table[cp] = 0
        elif kind in ("Nd", "No") and unicodedata.digit(c, None) is not None:
            table[cp] = 48 + unicodedata.digit(c)
        elif len(same) == 1 and " " <= same <= "~":
            table[cp] = ord(same)
    for plain, others in LOOK_ALIKES.items():
        for c in others:
            table[ord(c)] = ord(plain)
    return table


def plain_characters(text: str) -> Tape:
    """First transducer: character by character."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = _plain_of()[points]
    if np.array_equal(plain, points):
        return Tape(text)
    keep = np.flatnonzero((plain != 0) | (points == 0))
    return Tape(plain[keep].tobytes().decode("utf-32-le", "surrogatepass"), keep)


# The digits' names in English, German, French and Spanish (French "un" and Spanish "un" are articles).
DIGIT_NAMES = {
    "0": "zero null zéro cero", "1": "one eins uno", "2": "two zwei deux dos", "3": "three drei trois tres",
    "4": "four vier quatre cuatro", "5": "five fünf cinq cinco", "6": "six sechs seis", "7": "seven sieben sept siete",
    "8": "eight acht huit ocho", "9": "nine neun neuf nueve",
}
_NAMED = {name: digit for digit, names in DIGIT_NAMES.items() for name in names.split()}
_TIMES = {"double": 2, "triple": 3}
_BY_LETTER = {c: [n[1:] for n in sorted(_NAMED, key=len, reverse=True) if n[0] == c] for c in sorted({n[0] for n in _NAMED})}
_NAME = "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in _BY_LETTER.items())  # by first letter: fewer tries a place
_SPELLED = re.compile(rf"(?<![^\W\d_])(?:(double|triple) )?({_NAME})(?![^\W\d_])")
_SPELLED_AT_ALL = re.compile(rf"(?:\b|[0-9_])(?:{_NAME})(?![^\W\d_])")
_GAP = re.compile(r"[ \t\n,.;-]{1,2}|")
_DOT_WORD = r"(?:dot|point|punto|punkt)"
_DIGIT_AFTER = re.compile(rf"(?i)[ -]?[0-9]|\s?[\[({{<]?\s?(?:{_DOT_WORD}\b|\.[ ]?[0-9])")
_DIGIT_BEFORE = re.compile(rf"(?i)(?:[0-9][ -]?|(?:\b{_DOT_WORD}|[0-9]\.)\s?[\])}}>]?\s?)\Z")
_LETTER_DIGIT = re.compile(r"(?<=[0-9])[OoIl]+(?=[ .-]?[0-9])")


def _lower(text: str) -> str:
    """The text in lower case, character by character."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def spelled_digits(tape: Tape) -> Tape:
    """Second transducer: names of digits become digits, and the gaps between two of them go; so do the letters O, o, I
    and l between digits.

    A name alone counts only between digits or beside a dot: before or after a number it is a word.
    """
    text, edits, run = tape.text, [], []

    def close():
        if len(run) == 1:
            a, b, _ = run[0]
            after, before = _DIGIT_AFTER.match(text, b), _DIGIT_BEFORE.search(text[max(0, a - 12): a])
            number = lambda m: m and m.group()[-1].isdigit()
            beside = bool(after and not number(after)) or bool(before and not before.group()[0].isdigit())
            if not beside and not (after and before):
                run.clear()
        for k, (a, b, new) in enumerate(run):
            edits.append((a, run[k + 1][0] if k + 1 < len(run) else b, new))
        run.clear()

    for m in _SPELLED.finditer(_lower(text)):
        if run and not _GAP.fullmatch(text, run[-1][1], m.start()):
            close()
        run.append((*m.span(), _NAMED[m.group(2)] * _TIMES.get(m.group(1), 1)))
    close()
    tape = tape.rewritten(edits)
    letter = lambda s: "".join("0" if c in "Oo" else "1" for c in s)
    return tape.rewritten([(*m.span(), letter(m.group())) for m in _LETTER_DIGIT.finditer(tape.text)])


_AT_WORD = r"(?:at|arroba|arobase|@)"
_MARK = re.compile(
    rf"(?i)\s{{0,2}}[\[({{<]\s?(?:(?P<at>{_AT_WORD})|(?P<dot>{_DOT_WORD}|\.))\s?[\])}}>]\s{{0,2}}"  # (at), [ dot ], {{.}}
    rf"|(?<=[0-9])\s(?P<point>{_DOT_WORD})\s(?=[0-9])"  # 10 dot 0 dot 0 dot 1
    r"|(?<![0-9A-Za-z])(?<![0-9]\s)(?P<plus>plus)\s?(?=[0-9])")
_LOOSE_AT = re.compile(rf"(?i)(?:\s{{1,3}}|_)({_AT_WORD})(?:\s{{1,3}}|_)")
_LABEL = re.compile(r"[A-Za-z0-9-]++")
_STEP = re.compile(rf"(?i)\.(?=[A-Za-z0-9])|(?:\s{{1,3}}|_)(?:{_DOT_WORD}|\.)(?:\s{{1,3}}|_)(?=[A-Za-z0-9])")
_WORD_BACK = re.compile(rf"(?i)(?:\s{{1,3}}|_)(?:{_DOT_WORD}|\.)(?:\s{{1,3}}|_)\Z")

# Endings of addresses that are accepted after a mark which might be an ordinary word.
ENDINGS = frozenset("com org net edu gov mil int info biz io dev app ai co uk de fr es eu ca au ch nl ru cn jp br pl se "
                    "dk fi mx ar pt at".split())


def _marks(tape: Tape) -> Tape:
    new = {"at": "@", "dot": ".", "point": ".", "plus": "+"}
    return tape.rewritten([(*m.span(), new[m.lastgroup]) for m in _MARK.finditer(tape.text)])


def _domain(text: str, a: int):
    """Where a domain that begins at ``a`` ends, its worded dots, its last label and whether it has a dot at all."""
    label = _LABEL.match(text, a)
    if label is None:
        return None
    dots, end, last, n = [], label.end(), label.group(), 0
    while (step := _STEP.match(text, end)) is not None:
        label = _LABEL.match(text, step.end())
        if step.group() != ".":
            if label.group().lower() in ("at", "arroba", "arobase"):
                break
            dots.append((*step.span(), "."))
        end, last, n = label.end(), label.group(), n + 1
    return (end, dots, last, n)


def _local(text: str, b: int, least: int):
    """Where a local part that ends at ``b`` begins, and its worded dots."""
    dots = []
    while True:
        a = b
        while a > least and text[a - 1] in _LOCAL and not (a - 1 > least and text[a - 1] == "_" and _WORD_BACK.search(text, max(least, a - 12), a)):
            a -= 1
        if a == b:
            return (dots[0][1] if dots else b), dots[1:]
        word = _WORD_BACK.search(text, max(least, a - 12), a)
        if word is None:
            return a, dots
        dots.insert(0, (*word.span(), "."))
        b = word.start()


def at_and_dot(tape: Tape) -> Tape:
    """Third transducer: bracketed marks for ``@`` and ``.``, worded dots between digits, ``plus`` before digits; then
    loose marks (``name at host dot com``).

    A loose ``at`` counts only where a local part, a domain and a known ending surround it, and, if no dot of the address
    is worded, where the local part is more than letters: "seen at example.com" names no person.
    """
    tape = _marks(tape)
    text, edits, least = tape.text, [], 0
    for m in _LOOSE_AT.finditer(text):
        if m.start() < least:
            continue
        domain = _domain(text, m.end())
        if domain is None or not domain[3] or domain[2].lower() not in ENDINGS:
            continue
        start, dots = _local(text, m.start(), least)
        if start >= m.start() or not (dots or domain[1] or re.search(r"[0-9._%+]", text[start:m.start()])):
            continue
        edits += [*dots, (*m.span(), "@"), *domain[1]]
        least = domain[0]
    return tape.rewritten(edits)


TRANSDUCERS = (plain_characters, spelled_digits, at_and_dot)

# A text in lower case without any of these has no disguise that the second or third transducer would rewrite.
_DISGUISES = [_SPELLED_AT_ALL] + [re.compile(p) for p in (
    rf"[\[({{<]\s?(?:{_AT_WORD}|{_DOT_WORD}|\.)\s?[\])}}>]",
    rf"[\s_]{_AT_WORD}(?:\s{{1,3}}|_)[a-z0-9-]++(?:\.[a-z0-9]|(?:\s{{1,3}}|_)(?:{_DOT_WORD}|\.)[\s_])",
    rf"[0-9](?:[oil]|\s{_DOT_WORD}\s)",
    r"plus\s?[0-9]",
)]


def find(text: str) -> tuple[dict, dict]:
    """``(base, added)``: the spans of each kind in the text as it is, and those that only its plain form shows.

    An added span is one of the plain form's that no base span of its kind covers.
    """
    base = detect(text)
    tape = None if text.isascii() else plain_characters(text)
    plain = text if tape is None else tape.text
    low = _lower(plain)
    if any(p.search(low) for p in _DISGUISES):
        tape = at_and_dot(spelled_digits(Tape(plain) if tape is None else tape))
    if tape is None or tape.text == text:
        return base, {k: [] for k in KINDS}
    added = {}
    for kind, spans in detect(tape.text).items():
        found = sorted({tape.source(a, b) for a, b in spans})
        added[kind] = [s for s in found if not _covered(s, base[kind])]
    return base, added


def _covered(span: tuple[int, int], spans: list[tuple[int, int]]) -> bool:
    """Whether one of the ordered, separate ``spans`` covers ``span``."""
    from bisect import bisect_right

    i = bisect_right(spans, (span[0], 1 << 62)) - 1
    return i >= 0 and spans[i][1] >= span[1]


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, base, spans)``: arrays of ``(kind, start, end)`` in code points (end exclusive), ordered by kind
    (email, ip, card, phone), then start.

    ``base`` are the matches in the text as it is, ``spans`` those and the ones that only the plain form shows.  Whole
    texts are read, in one task each and in time linear in their length; nothing is shuffled.  Null and empty texts have
    no spans; ids are passed on as they are (null, repeated); other columns are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        forget_worker_caches()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                plain, every = [], []
                for text in some.column(1).to_pylist():
                    base, added = find(text or "")
                    rows = [{"kind": k, "start": a, "end": b} for k in KINDS for a, b in base[k]]
                    plain.append(rows)
                    if any(added.values()):
                        rows = [{"kind": k, "start": a, "end": b} for k in KINDS for a, b in sorted(base[k] + added[k])]
                    every.append(rows)
                yield pa.record_batch([some.column(0), pa.array(plain, span), pa.array(every, span)],
                                      names=[id_col, "base", "spans"])

    s = "array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"{id_col} {kind}, base {s}, spans {s}")


def masked(docs: DataFrame, mask: str = "[{}]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, masked)``: the texts with each stretch of overlapping spans replaced by ``mask`` filled with the kind
    of its first span.  Rows and edge cases are those of ``personal_data``; a null text is empty."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                out = [_masked(t or "", mask) for t in some.column(1).to_pylist()]
                yield pa.record_batch([some.column(0), pa.array(out, pa.string())], names=[id_col, "masked"])

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"{id_col} {kind}, masked string")


def _masked(text: str, mask: str) -> str:
    base, added = find(text)
    spans = sorted((a, -b, k) for k in KINDS for a, b in base[k] + added[k])
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], mask.format(k)]
        at = max(at, -b)
    return "".join([*out, text[at:]])


def op11_pii(spark, sf_dir: str) -> DataFrame:
    """``n_*`` and ``base_sha256`` count and digest the base spans; ``spans`` lists all, ``n_added`` the others."""
    found = personal_data(read_table(spark, sf_dir, "documents"))
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[of(k) for k in KINDS], F.sha2(line("base"), 256).alias("base_sha256"),
                        line("spans").alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))
