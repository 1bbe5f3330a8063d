"""Personal data in texts, plain and disguised, as spans of the source.

Plain identifiers are found by four patterns. Disguised ones are found in a normalised reading of the
text, which transducers write together with the place in the source of every character:

1. Look-alikes: letters, digits and signs of other scripts or widths become the ASCII character they
   imitate, one for one (Cyrillic and Greek letters by a table, all others by Unicode's own
   compatibility mappings). Invisible characters vanish.
2. Signs spelled out: "[at]", "(dot)", "{punkt}", "&#64;", "%40", "_at_" and the like become "@" and ".".
   Without brackets, "name at host dot tld" is read as an address only if it has both words and ends in
   one of the usual top-level domains: these words occur in any prose. So are signs set off by blanks.
3. Digits spelled out in English, German, French or Spanish, three or more in a row, become digits, with
   "dot" between digits a point and "plus" before them a "+". Within a row of digits, O and l become 0, 1.

The same patterns then search the normalised text, and what they find is mapped back to the source. A
find counts only if a transducer wrote some of it; everything else is plain, and was found before.

A span is (kind, start, end): code points, end exclusive. Defined results: a null text is empty; a null id
stays; repeated rows count each; an empty table gives an empty result; extra columns are not read.
Texts are searched whole, in time proportional to their length.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_disguised long"

#: Letters of other scripts that look like an ASCII letter.
CYRILLIC = dict(zip("аесорхуіјѕԁһӏԛԝкмтвАВЕКМНОРСТХУІЈЅ", "aecopxyijsdhlqwkmtbABEKMHOPCTXYIJS", strict=True))
GREEK = dict(zip("οαινρυκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "oaivpukABEZHIKMNOPTYX", strict=True))
SIGNS = dict(zip("․。．｡·•‧＠﹫－‐‑‒–−﹣＋﹢（）    ", "......." + "@@" + "-------" + "++" + "()" + "    ", strict=True))
INVISIBLE = "­​‌‍⁠﻿"
#: Top-level domains that end an address written in plain words.
ENDINGS = frozenset("com org net edu gov mil info biz io co ai app dev me tv eu de at ch fr be nl es it pt uk ie us ca mx br ar cl au nz in jp cn kr ru pl se no dk fi example test".split())
#: Digits in words.
DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "fuenf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}



def by_first_letter(words: Iterable[str]) -> str:
    """A pattern of the words, those of one first letter together."""
    rest: dict[str, list[str]] = {}
    for x in sorted(words, key=len, reverse=True):
        rest.setdefault(x[0], []).append(x[1:])
    return "(?:" + "|".join(f"{k}(?:{'|'.join(v)})" for k, v in rest.items()) + ")"


AT_WORD, DOT_WORD = "(?:at|ät|arroba|arobase|klammeraffe)", "(?:dot|punkt|punto|point)"
HOST = r"[A-Za-z0-9-]+"
DIGIT = by_first_letter(DIGITS)
GAP = r"[\x20\t,-]{1,3}"

IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

SIGN = re.compile(
    rf"(?P<at>[\x20\t]*[\[({{<][\x20\t]*(?:{AT_WORD}|@)[\x20\t]*[\])}}>][\x20\t]*|&\#0*64;|&\#x0*40;|&commat;|%40|_{AT_WORD}_)"
    rf"|(?P<dot>[\x20\t]*[\[({{<][\x20\t]*(?:{DOT_WORD}|\.)[\x20\t]*[\])}}>][\x20\t]*|&\#0*46;|&\#x0*2e;|&period;|%2e|_{DOT_WORD}_)",
    re.I,
)
#: What every match of SIGN has; much quicker to look for.
MARK = re.compile(r"[\[({<&%_](?=[\x20\t]*(?:[#.@CcPp]|[AaÄä][TtRr]|[Kk]l|[Dd][Oo]|[24]))")
SPELLED = re.compile(rf"(?<=[A-Za-z0-9_%+-])(?:[\x20\t]+{AT_WORD}[\x20\t]+|[\x20\t]*@[\x20\t]*){HOST}(?:(?:[\x20\t]+{DOT_WORD}[\x20\t]+|[\x20\t]*\.[\x20\t]*){HOST})+", re.I)
AT = re.compile(rf"(?P<dot>[\x20\t]+{AT_WORD}[\x20\t]+|[\x20\t]*@[\x20\t]*)", re.I)
DOT = re.compile(rf"(?P<dot>[\x20\t]+({DOT_WORD})[\x20\t]+|[\x20\t]*\.[\x20\t]*)", re.I)
HOST_NAME = re.compile(HOST)
#: The end of a name, from its last spelled dot on; names of more than 100 characters end there.
NAME_DOT = re.compile(rf"(?<=[A-Za-z0-9_%+-])(?P<dot>[\x20\t]+{DOT_WORD}[\x20\t]+)[A-Za-z0-9._%+-]+\Z", re.I)
NUMBER = re.compile(rf"(?<!\w)(?:plus{GAP})?(?:(?:{DIGIT}|[0-9]+)(?:{GAP}(?:{DOT_WORD}{GAP})?|\.(?=\w)))*{DIGIT}(?!\w)", re.I)
TOKEN = re.compile(rf"plus|{DOT_WORD}|{DIGIT}|[0-9]+|\.", re.I)
LETTERS = re.compile(r"(?<![A-Za-z0-9])(?=[OoIl|\x20.-]*[0-9])(?:[0-9OoIl|]{1,19}[\x20.-]?){3,24}(?![A-Za-z0-9])")
AS_DIGIT = str.maketrans("OoIl|", "00111")

# Texts without these have nothing to rewrite. They look at lower-cased text and start with a rare sign, which makes them quick.
BEYOND = re.compile("[^\x00-\u017f]")
PAIR = re.compile(rf"[\x20\t]{AT_WORD}[\x20\t]+[a-z0-9-]+(?:[\x20\t]+{DOT_WORD}[\x20\t]|[\x20\t]*\.)|@[\x20\t]|[\x20\t]@|@[a-z0-9-]+(?:[\x20\t]+(?:\.|{DOT_WORD})|\.[\x20\t])")
TWO = re.compile(rf"[\x20\t,.-](?:[0-9]+|{by_first_letter(DIGITS)}){GAP}(?:{DOT_WORD}{GAP})?(?:[0-9]|{by_first_letter(DIGITS)}(?!\w))")
MIXED = re.compile(r"[0-9][\x20.-]?[OoIl|]")

Span = tuple[str, int, int]


@cache
def lookalikes() -> dict[int, str]:
    """Code point -> the one ASCII character it imitates."""
    table = {ord(k): v for k, v in (CYRILLIC | GREEK | SIGNS).items()}
    for c in (*range(0x0660, 0x3000), *range(0xA620, 0xABFA), *range(0xFF01, 0xFF5F), *range(0x104A0, 0x104AA), *range(0x11066, 0x11DAA), *range(0x1D400, 0x1D800), *range(0x1FBF0, 0x1FBFA)):
        x = chr(c)
        kind = unicodedata.category(x)
        if kind == "Nd":
            table[c] = str(unicodedata.decimal(x))
        elif kind[0] == "L" and kind != "Lm" or 0xFF00 < c < 0xFF5F:
            plain = unicodedata.normalize("NFKC", x)
            if len(plain) == 1 and plain.isascii():
                table.setdefault(c, plain)
    return table


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(x * 2 - 9 * (x > 4) for x in map(int, digits[-2::-2]))) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern: from each "@" back over the name, on over the host."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        else:
            end = max(end, start)
        at = text.find("@", max(at + 1, end))


def plain(text: str) -> list[Span]:
    """Spans of the four patterns, by kind, then start."""
    out: list[Span] = [("email", a, b) for a, b in emails(text)]
    if any(x in text for x in "0123456789"):
        for m in IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= sum(x in "0123456789" for x in m[0]) <= 15:
                    out.append(("phone", *m.span()))
    return out


class Reading:
    """A normalised text: pieces of the source, each copied or rewritten."""

    def __init__(self, source: str, changes: list[tuple[int, int, str]]):
        """changes: (start, end, what stands there instead), by start, not overlapping."""
        out: list[str] = []
        self.at: list[int] = []  # where a piece begins in the normalised text
        self.piece: list[tuple[int, int, bool]] = []  # its start and end in the source, and whether it was rewritten
        place = done = 0
        for a, b, new in [*changes, (len(source), len(source), "")]:
            for start, end, text, written in ((done, a, source[done:a], False), (a, b, new, True)):
                if text:
                    self.at.append(place)
                    self.piece.append((start, end, written))
                    out.append(text)
                    place += len(text)
            done = b
        self.text = "".join(out)

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Source start and end of a normalised span."""
        i, j = bisect.bisect_right(self.at, start) - 1, bisect.bisect_left(self.at, end) - 1
        first, last = self.piece[i], self.piece[j]
        return first[0] if first[2] else first[0] + start - self.at[i], last[1] if last[2] else last[0] + end - self.at[j]


def separate(changes: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """By start; of overlapping changes the first stays."""
    out: list[tuple[int, int, str]] = []
    for x in sorted(changes, key=lambda c: (c[0], -c[1])):
        if not out or x[0] >= out[-1][1]:
            out.append(x)
    return out


def number(text: str) -> str | None:
    """A row of spelled digits as a card, phone or ip would be written; None if it has fewer than three words."""
    tokens = [x.lower() for x in TOKEN.findall(text)]
    if sum(x in DIGITS for x in tokens) < 3:
        return None
    return "".join("+" if x == "plus" else DIGITS.get(x) or (x if x[0] in "0123456789" else ".") for x in tokens)


def rewritten(text: str) -> list[tuple[int, int, str]]:
    """The changes that spelled signs, spelled digits and invisible characters ask for."""
    changes: list[tuple[int, int, str]] = []
    if not text.isascii():
        changes += [(m.start(), m.end(), "") for m in re.finditer(f"[{INVISIBLE}]+", text)]
    if MARK.search(text):
        changes += [(m.start(), m.end(), "@" if m["at"] else ".") for m in SIGN.finditer(text)]
    low = text.lower()
    if PAIR.search(low):
        for m in SPELLED.finditer(text):
            changes += address(text, m)
    if TWO.search(low):
        for m in NUMBER.finditer(text):
            if new := number(m[0]):
                changes.append((*m.span(), new))
    if MIXED.search(text):
        for m in LETTERS.finditer(text):
            if not m[0].isdigit() and sum(map(str.isdigit, m[0])) * 3 >= 2 * sum(map(str.isalnum, m[0])):
                new = m[0].translate(AS_DIGIT)
                changes += [(m.start() + k, m.start() + k + 1, y) for k, (x, y) in enumerate(zip(m[0], new, strict=True)) if x != y]
    return separate(changes)


def address(text: str, m: re.Match) -> list[tuple[int, int, str]]:
    """Changes of "name at host dot tld", and of dots spelled in the name; none if it is likely prose."""
    host = AT.match(text, m.start())
    dots = list(DOT.finditer(text, host.end(), m.end()))
    while dots:
        last = HOST_NAME.match(text, dots[-1].end())[0].lower()
        if last in ENDINGS and ("@" in host[0] or any(x[2] for x in dots)):
            break
        dots.pop()
    if not dots or all(len(x[0]) == 1 for x in (host, *dots)):
        return []
    name = m.start()
    while before := NAME_DOT.search(text, max(0, name - 100), name):
        dots.append(before)
        name = before.start("dot")
    return [(*x.span("dot"), new) for x, new in ((host, "@"), *((d, ".") for d in dots)) if x["dot"] != new]


def disguised(text: str, base: set[Span]) -> list[Span]:
    """Spans found in the normalised text only."""
    odd = not text.isascii() and (BEYOND.search(text) or any(x in text for x in "\xa0\xad\xb7"))
    same = text.translate(lookalikes()) if odd else text
    changes = rewritten(same)
    if not changes and same == text:
        return []
    reading = Reading(same, changes)
    found = []
    for kind, a, b in plain(reading.text):
        start, end = reading.span(a, b)
        if reading.text[a:b] != text[start:end] and (kind, start, end) not in base:
            found.append((kind, start, end))
    return found


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """(plain spans, disguised spans) of a whole text, each by kind, then start."""
    base = plain(text)
    return base, disguised(text, set(base))


def written(found: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(found, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def find(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """For every row: key, counts and hash of plain spans, all spans as text, number of disguised ones."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, out = batch.column(0), []
            for t in batch.column(1):
                base, more = spans(t.as_py() or "")
                counts = [sum(k == x[0] for x in base) for k in KINDS]
                out.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(base + more), len(more)))
            columns = [keys, *(pa.array([x[k] for x in out], kind) for k, kind in enumerate([pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]))]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(each, SCHEMA)


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span of `text` replaced by its kind in angle brackets; overlapping spans become one, of the first's kind."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(text)
            new = [None if t is None else masked(t) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return docs.mapInArrow(each, docs.schema)


def masked(text: str) -> str:
    base, more = spans(text)
    out, done, end = [], 0, -1
    for kind, a, b in sorted(base + more, key=lambda x: (x[1], -x[2])):
        if a >= end:
            out += [text[done:a], f"<{kind}>"]
        end = done = max(end, b)
    return "".join([*out, text[done:]])
