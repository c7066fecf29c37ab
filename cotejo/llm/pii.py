"""Personal data, also in disguise, with spans of the text as it stands.

Plain identifiers are found by pattern. Texts that show a disguise are then rewritten (look-alike
characters, spelled digits, bracketed or spelled "at" and "dot") while every rewritten character
remembers where it comes from; what is found there is mapped back to the source characters.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from cotejo.llm.common import record_batch, texts_of

KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Letters of other scripts that look like ASCII letters.
LOOKALIKES = dict(
    zip(
        "авеԁіјкӏмпорԛѕтгухһԝАВЕІЈКМНОРЅТУХСсαερνοικτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧϲ",
        "abedijklmnopqstryxhwABEIJKMHOPSTYXCcaepvoiktuxABEZHIKMNOPTYXc",
        strict=False,
    )
)
# Signs that look like the ASCII signs of an identifier, and characters without width.
SIGNS = {
    "．": ".", "。": ".", "․": ".", "·": ".", "•": ".", "﹒": ".",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹢": "+", "﹫": "@",
    " ": " ", " ": " ", " ": " ", " ": " ",
}
NO_WIDTH = "​‌‍⁠­﻿"
# Words for digits in the languages of the texts.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
# Words for teens and tens, which are read as two digits.
DIGIT_WORDS |= dict(
    zip(
        "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety".split(),
        "10 11 12 13 14 15 16 17 18 19 20 30 40 50 60 70 80 90".split(),
        strict=True,
    )
)
_DIGIT = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"

_SPELLED = re.compile(rf"(?<!\w)(?:plus[\s-]+)?{_DIGIT}(?:[\s,.;-]{{1,3}}(?:{_DIGIT}|dot|point|[0-9]+)){{3,}}(?!\w)", re.I)
_SPELLED_ON = frozenset(DIGIT_WORDS) | {"dot", "point"}
_RUN = re.compile(r"[^\W_]+")
# ASCII signs as spaces.
_PARTED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_SPELLED_PART = re.compile(rf"{_DIGIT}|plus|dot|point|[0-9]+", re.I)
_AT = re.compile(r"[ \t]*(?:[\[({<][ \t]*(?:at|@|arroba|arobase|klammeraffe)[ \t]*[\])}>]|&#64;|&commat;)[ \t]*", re.I)
_DOT = re.compile(r"[ \t]*(?:[\[({<][ \t]*(?:dot|\.|point|punkt|punto)[ \t]*[\])}>]|&#46;|&period;)[ \t]*", re.I)
_DIGIT_DOT = re.compile(r"(?<=[0-9])[ \t]+(?:dot|point)[ \t]+(?=[0-9])", re.I)
# An address with words in it: name at host dot ... dot domain; a sign @ or dot may stand for a word.
_WORDS = re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}(?:[ \t]+dot[ \t]+[\w%+-]{1,64}){0,3}([ \t]+at[ \t]+|[ \t]*@[ \t]*)[\w-]{1,63}(?:(?:[ \t]+dot[ \t]+|\.)[\w-]{1,63}){1,4}(?!\w)", re.I)
_WORD_DOT = re.compile(r"[ \t]+dot[ \t]+", re.I)
# The same in other languages, where the words for the sign @ are no words of running text.
_FOREIGN = re.compile(
    r"(?<![\w.%+-])[\w.%+-]{1,64}(?:[ \t]+(?:punto|point|punkt)[ \t]+[\w%+-]{1,64}){0,3}([ \t]+(?:arroba|arobase|klammeraffe)[ \t]+)"
    r"[\w-]{1,63}(?:(?:[ \t]+(?:punto|point|punkt|dot)[ \t]+|\.)[\w-]{1,63}){1,4}(?!\w)", re.I
)
_FOREIGN_DOT = re.compile(r"[ \t]+(?:punto|point|punkt|dot)[ \t]+", re.I)
_FOREIGN_AT = frozenset("arroba arobase klammeraffe".split())
# Words joined by low lines.
_JOINED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9.%+-]+(?:_[A-Za-z0-9.%+-]+){0,5}?(_at_)[A-Za-z0-9-]+(?:_dot_[A-Za-z0-9-]+){1,4}(?![A-Za-z0-9_])", re.I)
_JOINED_DOT = re.compile("_dot_", re.I)
# Letters that look like digits, in groups of digits.
_DIGIT_LETTERS = {"l": "1", "I": "1", "O": "0", "o": "0"}
_MIXED = re.compile(r"(?<![A-Za-z0-9])(?=[lIOo]*[0-9])[0-9]*[lIOo][0-9lIOo]*(?![A-Za-z0-9])")
_LETTER = re.compile("[lIOo]")
_MAY_BE_MIXED = re.compile("[0-9][lIOo]|[lIOo][0-9]")
_BRACKET = re.compile(r"[\[({<][ \t]*(?:at|@|arroba|arobase|klammeraffe|dot|\.|point|punkt|punto)[ \t]*[\])}>]|&#(?:64|46);|&(?:commat|period);", re.I)


def _character_map() -> dict[str, str]:
    import unicodedata

    table = dict(LOOKALIKES) | SIGNS | {c: "" for c in NO_WIDTH}
    table |= {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}  # full width forms
    for c in range(0x80, 0x1FBFA):
        value = unicodedata.decimal(chr(c), None)
        if value is not None:
            table[chr(c)] = str(value)
    table |= {chr(c): str((c - 0x245F) % 10) for c in range(0x2460, 0x2469)}  # circled digits
    return table


class Finder:
    """Finds the spans of one text after another; one for each task."""

    def __init__(self):
        self.table = _character_map()
        self.odd = re.compile("[" + "".join(re.escape(c) for c in self.table) + "]")

    def plain(self, text: str) -> list[tuple[int, int, str]]:
        """Base spans (start, end, kind), leftmost without overlap for each kind."""
        found = list(emails(text))
        digits = re.search("[0-9]", text)
        if digits:
            for kind, pattern, good in (("ip", IP, good_ip), ("card", CARD, good_card), ("phone", PHONE, good_phone)):
                if kind == "phone" and "+" not in text:
                    continue
                found += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if good(m[0])]
        return found

    def spans(self, text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """Base spans, and the further ones that a rewritten text shows; both in order."""
        base = self.plain(text)
        more: list[tuple[int, int, str]] = []
        rewritten = self.rewrite(text)
        if rewritten:
            new, starts, ends = rewritten
            for start, end, kind in self.plain(new):
                span = (starts[start], ends[end - 1], kind)
                # A plain span stays as it is; one that reaches further is added beside it.
                if not any(k == kind and s <= span[0] and span[1] <= e for s, e, k in base):
                    more.append(span)
        rank = {k: i for i, k in enumerate(KINDS)}
        key = lambda x: (x[0], rank[x[2]], x[1])
        return sorted(base, key=key), sorted(set(more), key=key)

    def rewrite(self, text: str) -> tuple[str, array, array] | None:
        """The text without disguises and each character's source start and end, or None."""
        # Cheap tests first; most texts show no sign of a disguise.
        words = _parted(text)
        odd = not text.isascii() and self.odd.search(text) is not None
        signs = any(c in text for c in "[({<&") and _BRACKET.search(text) is not None
        dots = "dot" in words or ("point" in words and _DIGIT_DOT.search(text) is not None)
        mixed = _MAY_BE_MIXED.search(text) is not None and _MIXED.search(text) is not None
        foreign = not _FOREIGN_AT.isdisjoint(words)
        low_lines = "_dot_" in text.lower()
        if not (odd or signs or dots or mixed or foreign or low_lines or _may_be_spelled(text, words)):
            return None
        now = (text, array("q", range(len(text))), array("q", range(1, len(text) + 1)))
        if odd:
            now = self._characters(*now)
        if mixed or odd:
            letters = [d.start() for m in _MIXED.finditer(now[0]) for d in _LETTER.finditer(now[0], m.start(), m.end())]
            now = _replace(*now, [(at, at + 1, [(at, at + 1, _DIGIT_LETTERS[now[0][at]])]) for at in letters])
        edits = []
        for m in _SPELLED.finditer(now[0]):
            edits.append((m.start(), m.end(), [(p.start(), p.end(), _digits(p[0])) for p in _SPELLED_PART.finditer(now[0], m.start(), m.end())]))
        now = _replace(*now, edits)
        edits = [(m.start(), m.end(), [(m.start(), m.end(), c)]) for pattern, c in ((_AT, "@"), (_DOT, ".")) for m in pattern.finditer(now[0])]
        now = _replace(*now, sorted(edits))
        now = _replace(*now, [(m.start(), m.end(), [(m.start(), m.end(), ".")]) for m in _DIGIT_DOT.finditer(now[0])])
        for there, pattern, dot in ((foreign or odd, _FOREIGN, _FOREIGN_DOT), (low_lines, _JOINED, _JOINED_DOT)):
            if there:
                edits = []
                for m in pattern.finditer(now[0]):
                    edits.append((m.start(1), m.end(1), [(m.start(1), m.end(1), "@")]))
                    edits += [(d.start(), d.end(), [(d.start(), d.end(), ".")]) for d in dot.finditer(now[0], m.start(), m.end())]
                now = _replace(*now, sorted(edits))
        new, starts, ends = now
        edits = []
        for m in _WORDS.finditer(new):
            # A dot that stood for something else; the bare word "point" is one of numbers.
            hidden = any(new[p] == "." and text[starts[p] : ends[p]].strip().lower() not in (".", "point") for p in range(m.start(), m.end()))
            if not hidden and not _WORD_DOT.search(m[0]):
                continue  # "at" alone is a word of the language
            edits.append((m.start(1), m.end(1), [(m.start(1), m.end(1), "@")]))
            edits += [(d.start(), d.end(), [(d.start(), d.end(), ".")]) for d in _WORD_DOT.finditer(now[0], m.start(), m.end())]
        return _replace(*now, sorted(edits))

    def _characters(self, text: str, starts: array, ends: array) -> tuple[str, array, array]:
        """Look-alikes by character. A letter of another script counts only beside ASCII: in a
        word of that script alone it stays."""
        out, s, e, at = [], array("q"), array("q"), 0
        for m in self.odd.finditer(text):
            i = m.start()
            out.append(text[at:i])
            s.extend(starts[at:i])
            e.extend(ends[at:i])
            new = self.table[m[0]]
            if new:
                out.append(new)
                s.append(starts[i])
                e.append(ends[i])
            at = i + 1
        out.append(text[at:])
        s.extend(starts[at:])
        e.extend(ends[at:])
        return "".join(out), s, e


def _parted(text: str) -> list[str]:
    """Runs of letters and digits, in lower case."""
    if text.isascii():
        return text.lower().encode().translate(_PARTED).decode().split()
    return _RUN.findall(text.casefold())


def _may_be_spelled(text: str, words: list[str]) -> bool:
    """Whether a digit word has three parts of a number after it; true wherever ``_SPELLED`` matches."""
    if "\u0130" in text or "\u0131" in text:
        return True  # these equal an i when case is ignored, but not here
    for i in [i for i, w in enumerate(words) if w in DIGIT_WORDS]:
        rest = words[i + 1 : i + 4]
        if len(rest) == 3 and all(w in _SPELLED_ON or (w.isascii() and w.isdigit()) for w in rest):
            return True
    return False


def _digits(part: str) -> str:
    part = part.lower()
    return {"plus": "+", "dot": ".", "point": "."}.get(part) or DIGIT_WORDS.get(part, part)


def _replace(text: str, starts: array, ends: array, edits: list) -> tuple[str, array, array]:
    """Replace stretches (from, to, [(from, to, new text)]); new characters cover their source."""
    if not edits:
        return text, starts, ends
    out, s, e, at = [], array("q"), array("q"), 0
    for begin, end, parts in edits:
        if begin < at:
            continue
        out.append(text[at:begin])
        s.extend(starts[at:begin])
        e.extend(ends[at:begin])
        for a, b, new in parts:
            out.append(new)
            own = b - a == len(new)
            s.extend(starts[a : a + len(new)] if own else [starts[a]] * len(new))
            e.extend(ends[a : a + len(new)] if own else [ends[b - 1]] * len(new))
        at = end
    out.append(text[at:])
    s.extend(starts[at:])
    e.extend(ends[at:])
    return "".join(out), s, e


def emails(text: str) -> Iterator[tuple[int, int, str]]:
    """Leftmost matches of local@domain, found from each @ in time linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end(), "email"
            done = m.end()
        at = text.find("@", max(done, at + 1))


def good_ip(found: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in found.split("."))


def good_card(found: str) -> bool:
    digits = NOT_DIGIT.sub("", found)
    if not 14 <= len(digits) <= 19:
        return False
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def good_phone(found: str) -> bool:
    return 10 <= len(NOT_DIGIT.sub("", found)) <= 15


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact_text(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Each stretch of overlapping spans becomes the name of its first kind in angle brackets."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_disguised long, base_sha256 string, spans string"


def personal_data(docs: DataFrame) -> DataFrame:
    """Spans of personal data of every row of ``docs`` (doc_id, text), in code points.

    The counts and ``base_sha256`` are of the plain spans; ``spans`` has the disguised ones too,
    ``n_disguised`` counts those. Null and empty texts have none. Repeated rows get a row each,
    a null doc_id stays null, other columns are not read. No shuffle.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(FOUND))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        finder = Finder()
        rank = {k: i for i, k in enumerate(KINDS)}
        for batch in batches:
            rows = []
            for raw in texts_of(batch):
                base, more = finder.spans(raw.decode("utf-8", "surrogatepass") if raw else "")
                kinds = [k for _, _, k in base]
                every = sorted(base + more, key=lambda x: (x[0], rank[x[2]], x[1]))
                rows.append((*(kinds.count(k) for k in KINDS), len(more), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            if rows:
                yield record_batch(schema, [batch.column(0), *zip(*rows)])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, FOUND)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span, plain or disguised, replaced by its kind. ``n_chars``, if there,
    follows the text; null texts stay null; no row goes."""
    place = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in batches:
            texts = []
            for value in batch.column(place):
                text = value.as_py()
                base, more = finder.spans(text) if text else ([], [])
                texts.append(redact_text(text, base + more) if base or more else text)
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            if size is not None:
                counts = [None if t is None else len(t) for t in texts]
                columns[size] = pa.array(counts, batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
