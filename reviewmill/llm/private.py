"""Personal data in disguise, found in a normalised copy and mapped back to the source.

Base patterns run over the source. Then transducers rewrite it: look-alike letters and digits become plain ones and
invisible characters go, runs of spelled digits become digits, and written-out at and dot become signs. A second copy
turns every spelled digit into a digit, also alone or next to digits, and adds what only it shows. Each
transducer keeps the places of its edits, so that a span found in the last text is carried back through
all of them to source characters. Such a span is added unless a base span of its kind covers it; base spans stay.

Plain " at " counts only before a host with a written-out dot, so that prose such as "look at example.com" stays.
Defined results: a null or empty text has no spans; repeated rows are searched alike; other columns pass through.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StructType

from reviewmill.llm.common import unused

KINDS = ("email", "ip", "card", "phone")

# The base patterns. The guards before digits and the possessive marks change no match; they
# keep long runs of digits linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like Latin ones.
_LOOK_ALIKE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "к": "k", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ѕ": "S", "Ј": "J", "З": "3", "ο": "o", "α": "a",
    "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "τ": "t", "ε": "e", "χ": "x", "γ": "y", "Α": "A", "Β": "B",
    "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y",
    "Χ": "X", "օ": "o", "ս": "u", "ո": "n", "ɑ": "a", "ɡ": "g", "ı": "i", "ⅼ": "l",
}
_INVISIBLE = "­͏؜᠎​‌‍‎‏⁠⁡⁢⁣⁤﻿"
_DOTS_AND_DASHES = {"․": ".", "。": ".", "｡": ".", **dict.fromkeys("‐‑‒–—―−", "-")}

# The digits as words, zero to nine, in the languages of the corpus.
_DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)


def _plain_characters() -> dict[int, str]:
    """Code point to plain character: other digits, and wide, styled or spaced forms of ASCII."""
    table = {}
    for code in range(0xA0, 0x1FBFA):
        char = chr(code)
        kind = unicodedata.category(char)
        if kind == "Nd":
            table[code] = str(unicodedata.decimal(char))
        elif kind == "Zs":
            table[code] = " "
        elif kind[0] in "LPS":
            folded = unicodedata.normalize("NFKC", char)
            if len(folded) == 1 and "!" <= folded <= "~":
                table[code] = folded
    table.update({ord(k): v for k, v in {**_LOOK_ALIKE, **_DOTS_AND_DASHES}.items()})
    # Ordinal signs and superscripts are text of their own.
    return {k: v for k, v in table.items() if k not in (0xAA, 0xBA)}


_PLAIN = _plain_characters()
_BEYOND_LATIN = re.compile("[\xa0\xad\u0100-\U0001ffff]")
_ODD = frozenset(map(chr, _PLAIN)) | frozenset(_INVISIBLE)
_HIDDEN = re.compile(f"[{_INVISIBLE}]+")
_DIGIT_OF = {word: str(i) for words in _DIGIT_WORDS for i, word in enumerate(words.split())}
_ONE = "(?:" + "|".join(sorted(_DIGIT_OF, key=len, reverse=True)) + ")"
_SPELLED = re.compile(rf"(?<!\w){_ONE}(?:[ ,\-]{{1,3}}{_ONE}){{2,}}(?!\w)", re.IGNORECASE)
_DIGIT_WORD = re.compile(_ONE, re.IGNORECASE)
_UNIT = re.compile(rf"(?<!\w)(?:{_ONE}|[0-9]+)(?!\w)", re.IGNORECASE)
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_AT = rf"(?: *{_OPEN} *(?:at|@|arroba|arobase) *{_CLOSE} *)"
_DOT = rf"(?: *{_OPEN} *(?:dot|\.|punto|point|punkt) *{_CLOSE} *| +dot +)"
_SIGNS = re.compile(
    rf"(?P<at>{_AT}| +at +(?=[A-Za-z0-9-]+{_DOT}[A-Za-z])| +@ *(?=[A-Za-z0-9-]+(?:{_DOT}|\.)[A-Za-z])|(?<=\w)@ +(?=[A-Za-z0-9-]+(?:{_DOT}|\.)[A-Za-z]))"
    rf"|(?P<dot>(?<=[A-Za-z0-9]){_DOT}(?=[A-Za-z0-9]))",
    re.IGNORECASE,
)
_SIGN_HINT = re.compile(rf"@ | @|{_OPEN} *(?:at|@|arroba|arobase|dot|\.|punto|point|punkt) *{_CLOSE}| dot ", re.IGNORECASE)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns: by kind as listed, then by start."""
    found = [("email", start, end) for start, end in _emails(text)]
    for match in _IP.finditer(text):
        parts = [part.lstrip("0") for part in match[0].split(".")]
        if all(len(part) <= 3 and int(part or "0") <= 255 for part in parts):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in match[0]) <= 15:
                found.append(("phone", *match.span()))
    return found


class Trace:
    """A text rewritten by edits (start, end, new), and the way back from its spans."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        pieces, self.places, last, length = [], [], 0, 0
        for start, end, new in edits:
            for piece, source, copied in ((text[last:start], last, True), (new, start, False)):
                if piece:
                    self.places.append((length, source, source if copied else end, copied))
                    pieces.append(piece)
                    length += len(piece)
            last = end
        self.places.append((length, last, last, True))
        pieces.append(text[last:])
        self.text = "".join(pieces)
        self.starts = [place[0] for place in self.places]

    def back(self, start: int, end: int) -> tuple[int, int]:
        first = self.places[bisect_right(self.starts, start) - 1]
        last = self.places[bisect_right(self.starts, end - 1) - 1]
        return (
            first[1] + (start - first[0]) * first[3],
            last[1] + end - last[0] if last[3] else last[2],
        )


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Edits for runs of three or more spelled digits."""
    edits = []
    words = text.lower().replace(",", " ").replace("-", " ").split()
    # The first and last word of a run may hold other signs, so two plain neighbours are enough to look closer.
    likely = b"\1\1" in bytes(map(_DIGIT_OF.__contains__, words))
    for run in _SPELLED.finditer(text) if likely else ():
        last = run.start()
        for word in _DIGIT_WORD.finditer(text, *run.span()):
            # What stands between two digits of a run goes with the digit after it.
            edits.append((last, word.end(), _DIGIT_OF[word[0].lower()]))
            last = word.end()
    return edits


def _spelled_anywhere(text: str) -> list[tuple[int, int, str]]:
    """Edits for every spelled digit, which joins the digits on either side of it."""
    edits, last, word_before = [], -1, False
    for unit in _UNIT.finditer(text):
        start, end = unit.span()
        word = not unit[0][0].isdigit()
        joined = last >= 0 and (word or word_before) and 1 <= start - last <= 3 and not text[last:start].strip(" ,-")
        if word:
            edits.append((last if joined else start, end, _DIGIT_OF[unit[0].lower()]))
        elif joined:
            edits.append((last, start, ""))
        last, word_before = end, word
    return edits


def normalise(text: str, spelled: Callable[[str], list[tuple[int, int, str]]] = _spelled) -> list[Trace]:
    """The transducers that change the text, in order; none if it has no disguise."""
    steps = []

    def then(edits: list[tuple[int, int, str]]) -> None:
        nonlocal text
        if edits:
            steps.append(Trace(text, edits))
            text = steps[-1].text

    if not text.isascii() and _BEYOND_LATIN.search(text) and not _ODD.isdisjoint(text):
        # One character stands for one, so places stay; the trace is that of the hidden ones.
        shown = text.translate(_PLAIN)
        hidden = [(*m.span(), "") for m in _HIDDEN.finditer(shown)]
        steps.append(Trace(shown, hidden))
        text = steps[-1].text
    then(spelled(text))
    if _SIGN_HINT.search(text):
        then([(*m.span(), "@" if m["at"] else ".") for m in _SIGNS.finditer(text)])
    return steps


def find_spans(text: str) -> list[tuple[str, int, int, bool]]:
    """All spans (kind, start, end, whether the base patterns found it), by kind as listed, then by start."""
    base = base_spans(text)
    spans = [(*span, True) for span in base]
    seen = None
    # Runs of spelled digits first; then the copy where every spelled digit counts, whose spans must find more.
    for spelled in (_spelled, _spelled_anywhere):
        steps = normalise(text, spelled)
        if not steps or steps[-1].text == seen:
            continue
        seen, found = steps[-1].text, list(spans)
        for kind, start, end in base_spans(seen):
            for step in reversed(steps):
                start, end = step.back(start, end)
            if not any(k == kind and s <= start and end <= e for k, s, e, _ in found):
                spans.append((kind, start, end, False))
    spans.sort(key=lambda span: (KINDS.index(span[0]), span[1], span[2]))
    return spans


def find_private(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``spans``: array of (kind, start, end, base) in code points, end exclusive."""
    name = unused(docs.columns, "spans")
    others = [c for c in docs.columns if c != text]
    span = StructType().add("kind", "string").add("start", "integer").add("end", "integer").add("base", "boolean")
    schema = docs.select(*(f"`{c}`" for c in others)).schema.add(name, ArrayType(span))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            rows = [
                [dict(zip(("kind", "start", "end", "base"), span)) for span in find_spans(value.as_py() or "")]
                for value in texts
            ]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in others]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, kind)], names=[*others, name])

    return docs.mapInArrow(run, schema)
