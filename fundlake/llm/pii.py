"""Personal data in texts, in disguise too, at the places of the source text.

Plain identifiers are found in the text itself.  Then a transducer rewrites the
text: look-alike letters become the ASCII ones, invisible characters go, runs
of spelled digits become digits, disguised at and dot signs become ``@`` and
``.``, and so do the written-out dots of an address of four numbers.  It keeps the source range of every character it writes, so what is
detected in the rewritten text maps back to a span of the source.  Those spans
are added to the plain ones, unless a plain span of the kind contains them.

Kinds: email, ip (parts at most 255), card (13 to 19 digits that pass Luhn),
phone (9 to 15 digits).  Matches of a kind are leftmost and do not overlap; one
that fails its condition is dropped without another try.

Defined cases: a null or empty text has no spans; offsets count code points,
ends are exclusive; repeated rows give repeated results; an empty table gives
an empty result.  Texts are searched whole, in time linear in their length, and
chains of written-out signs are followed however long they are.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_column, importable

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# The look-alikes of ASCII letters (Cyrillic, Greek, small dotless i) and full-width signs.  Letters that stand
# for ASCII ones by NFKC and the digits of all scripts follow; superscript and circled digits, and letters with marks, stay.
LOOKALIKES = dict(zip(
    "аАВеЕкКМНоОрРсСТуУхХіІјЈѕЅԁԛԝһΑΒΕΖΗΙΚΜΝΟΡΤΥΧοινıɑɡ",
    "aABeEkKMHoOpPcCTyYxXiIjJsSdqwhABEZHIKMNOPTYXoiviag".replace(" ", ""), strict=True))
LOOKALIKES |= {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}
LOOKALIKES |= {chr(0x0660 + i): str(i) for i in range(10)} | {chr(0x06F0 + i): str(i) for i in range(10)}
LOOKALIKES |= {" ": " ", " ": " ", " ": " ", "　": " ", "。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "﹫": "@"}
# further confusables: Greek and Cyrillic letters (palochka too), Armenian ones
LOOKALIKES |= dict(zip("\u03b1\u03b5\u03b3\u03b7\u03ba\u03c1\u03c3\u03c4\u03c5\u03c7\u03c9\u03f2\u03f3\u03f9\u037f", "aeynkpotuxwcjCJ", strict=True))
LOOKALIKES |= dict(zip("\u04c0\u04cf\u0433\u043a\u043c\u0442\u0474\u0475\u04ae\u04af\u051c\u050c\u04bb", "IlrkmtVvYyWGh", strict=True))
LOOKALIKES |= dict(zip("\u0585\u057d\u0578\u0570\u0581\u0566\u0555", "ounhgqO", strict=True))


def _folded(c: str) -> str:
    """ASCII letters or digits that NFKC (or the digit's value) gives for a letter, digit or letter sign, else nothing."""
    kind = unicodedata.category(c)
    if kind == "Nd":
        return str(unicodedata.decimal(c))
    one = unicodedata.normalize("NFKC", c)
    one = LOOKALIKES.get(one, one)
    fits = kind in ("Ll", "Lu", "Lm", "Nl", "So") and len(one) == 1 or "\ufb00" <= c <= "\ufb06"
    return one if fits and one.isascii() and one.isalnum() else ""


# the two lowest planes hold all that fold to ASCII
LOOKALIKES |= {c: f for c in map(chr, range(0x80, 0x20000)) if c not in LOOKALIKES and (f := _folded(c))}
INVISIBLE = "­​‌‍‎‏⁠﻿"
SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
           "seven": "7", "eight": "8", "nine": "9"}

_DIGIT_WORD = "(?:" + "|".join(SPELLED) + ")"
_SPELLED_RUN = re.compile(rf"(?<![A-Za-z]){_DIGIT_WORD}(?:[ ,.()-]{{0,3}}(?:(?:dot|point)[ ]?)?(?<![A-Za-z]){_DIGIT_WORD}(?![A-Za-z])|[ -]?[0-9]+(?![A-Za-z0-9]))+(?![A-Za-z])", re.I)
_SPELLED_ITEM = re.compile(rf"{_DIGIT_WORD}|dot|point|[0-9]|[.]|[ ,()-]+", re.I)
# four parts of an address, in digits or spelled, with dots of which some are written out
_IP_PART = rf"(?:[0-9]{{1,3}}|{_DIGIT_WORD}(?:[ _-]{{1,2}}{_DIGIT_WORD}){{0,2}})"
_WRITTEN_DOT = "(?:[ ]{1,2}(?:dot|point)[ ]{1,2}|_(?:dot|point)_|-(?:dot|point)-)"
_WRITTEN_IP = re.compile(rf"(?<![0-9])(?:(?<![A-Za-z])|(?=[0-9])){_IP_PART}(?:(?:{_WRITTEN_DOT}|[.]){_IP_PART}){{3}}(?![0-9])(?:(?![A-Za-z])|(?<=[0-9]))", re.I)
_IP_ITEM = re.compile(rf"{_WRITTEN_DOT}|{_DIGIT_WORD}|[0-9.]", re.I)
_PLUS = re.compile(r"(?<![A-Za-z])plus[ ](?=[0-9])", re.I)
_BRACKET_AT = re.compile(r"[ ]{0,2}[\[({<][ ]{0,2}(?:at|@|arroba)[ ]{0,2}[\])}>][ ]{0,2}", re.I)
_BRACKET_DOT = re.compile(r"[ ]{0,2}[\[({<][ ]{0,2}(?:dot|\.|punkt|punto)[ ]{0,2}[\])}>][ ]{0,2}", re.I)
_GAPS = (("[ ]{1,2}", "[A-Za-z0-9-]"), ("_", "[A-Za-z0-9-]"), ("-", "[A-Za-z0-9]"))
_WORD_AT = re.compile("|".join(
    rf"(?<=[A-Za-z0-9_%+-]){gap}at{gap}(?={label}+{gap}dot{gap}{label})" for gap, label in _GAPS), re.I)
_WORD_DOT = re.compile("|".join(rf"(?<=[A-Za-z0-9]){gap}dot{gap}(?=[A-Za-z0-9])" for gap, _ in _GAPS), re.I)
# before a plain domain only what cannot be a word of prose counts as the local part
_LOCAL_WORD = re.compile(r"[A-Za-z0-9._%+-]+")
_TWO_NAMES = re.compile(r"[A-Za-z]+[._][A-Za-z]{2,}")
_LETTER, _DIGIT_SIGN = re.compile("[A-Za-z]"), re.compile("[0-9_]")
_SPACED_WORD_AT = re.compile(" at ", re.I)
_PLAIN_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:[.][A-Za-z0-9-]{1,63})*[.][A-Za-z]{2,24}(?![A-Za-z0-9])")
# letters that stand for digits inside a long number; every part of it has a digit
_PART = "(?=[OoIl]{0,9}[0-9])[0-9OoIl]+"
_MIXED_NUMBER = re.compile(rf"(?<![A-Za-z0-9]){_PART}(?:[ ().-]{{1,2}}{_PART})*(?![A-Za-z0-9])")
_AS_DIGIT = {"O": "0", "o": "0", "I": "1", "l": "1"}
_SPACED_AT = re.compile(r"(?<=[A-Za-z0-9])(?:[ ]{1,2}@[ ]{0,2}|@[ ]{1,2})(?=[A-Za-z0-9-]+(?:\.|[ ]{1,2}dot[ ]{1,2})[A-Za-z0-9-])", re.I)
# what ends a stretch after an at sign, what a stretch up to one begins with, and whole labels between written-out dots
_AT_LEFT = re.compile(r"@[A-Za-z0-9.-]*\Z")
_AT_RIGHT = re.compile(r"[A-Za-z0-9._%+-]+@")
_LABEL = re.compile("[A-Za-z0-9-]+")
_DIGIT = re.compile("[0-9]")
# one range for the upper plane: a class that lists its letters is searched one by one
_ODD = re.compile("[" + re.escape("".join(c for c in LOOKALIKES if c < "\U00010000") + INVISIBLE) + "\U00010000-\U0001ffff]")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _emails(text: str) -> Iterator[Span]:
    """From every ``@`` outwards; the same as matching from the left, in linear time."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            last = domain.end()
        else:
            last = at + 1
        at = text.find("@", last)


def find(text: str) -> dict[str, list[Span]]:
    """Spans of each kind as the text stands."""
    return {
        "email": list(_emails(text)),
        "ip": [m.span() for m in _IP.finditer(text) if all(_at_most_255(p) for p in m[0].split("."))],
        "card": [m.span() for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)],
        "phone": [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15],
    }


class Rewritten:
    """A text and, for each of its characters, the source range it stands for."""

    def __init__(self, text: str):
        self.text, self.start, self.end, self.changed = text, range(len(text)), range(1, len(text) + 1), False

    def source(self, span: Span) -> Span:
        return self.start[span[0]], self.end[span[1] - 1]

    def replace(self, edits: list[tuple[int, int, list[tuple[str, int, int]]]]) -> None:
        """Replace [a, b) by characters that stand for parts of it; edits are in order and do not overlap."""
        if not edits:
            return
        text, start, end, last = [], [], [], 0
        for a, b, new in edits:
            text.append(self.text[last:a])
            start.extend(self.start[last:a])
            end.extend(self.end[last:a])
            for c, x, y in new:
                text.append(c)
                start.append(self.start[x])
                end.append(self.end[y - 1])
            last = b
        text.append(self.text[last:])
        start.extend(self.start[last:])
        end.extend(self.end[last:])
        self.text, self.start, self.end, self.changed = "".join(text), start, end, True


def _letters(out: Rewritten) -> None:
    out.replace([(m.start(), m.end(), [(c, m.start(), m.end()) for c in LOOKALIKES.get(m[0], "")])
                 for m in _ODD.finditer(out.text) if m[0] in LOOKALIKES or m[0] in INVISIBLE])


def _spelled(out: Rewritten) -> None:
    edits = []
    for run in _SPELLED_RUN.finditer(out.text):
        new = []
        for item in _SPELLED_ITEM.finditer(out.text, run.start(), run.end()):
            word = item[0].lower()
            if word in SPELLED or word.isdigit():
                new.append((SPELLED.get(word, word), item.start(), item.end()))
            elif word in ("dot", "point"):
                new.append((".", item.start(), item.end()))
            elif word == ".":
                new.append((".", item.start(), item.end()))
        if len(new) >= 4:
            edits.append((run.start(), run.end(), new))
    out.replace(edits)


def _signs(out: Rewritten, pattern: re.Pattern, sign: str) -> None:
    out.replace([(m.start(), m.end(), [(sign, m.start(), m.end())]) for m in pattern.finditer(out.text)])


def rewrite(text: str) -> Rewritten:
    """The transducers in a row, each over the one before's output."""
    out = Rewritten(text)
    if not text.isascii():
        _letters(out)
    low = out.text.lower()
    if "dot" in low or "@" in low or "arroba" in low or "[" in low or "(" in low or "{" in low or "<" in low:
        _signs(out, _BRACKET_AT, "@")
        _signs(out, _BRACKET_DOT, ".")
        _signs(out, _WORD_AT, "@")
        _signs(out, _SPACED_AT, "@")
        if "@" in out.text and "dot" in low:
            _word_dots(out)
    _name_ats(out)
    if _SPELLED_RUN.search(out.text):
        _spelled(out)
        _signs(out, _PLUS, "+")
    if "dot" in low or "point" in low:
        _written_ips(out)
    if _DIGIT.search(out.text):
        _mixed_numbers(out)
    return out


def _written_ips(out: Rewritten) -> None:
    """Written-out dots between the four parts of an address; parts in words become digits."""
    edits = []
    for ip in _WRITTEN_IP.finditer(out.text):
        items = _IP_ITEM.finditer(out.text, ip.start(), ip.end())
        edits.append((ip.start(), ip.end(), [(SPELLED.get(i[0].lower(), i[0] if len(i[0]) == 1 else "."), i.start(), i.end()) for i in items]))
    out.replace(edits)


def _is_name(word: str) -> bool:
    """Whether it cannot be a word of prose: an account's characters with a digit or underscore, or two names joined."""
    if not _LOCAL_WORD.fullmatch(word) or not _LETTER.search(word):
        return False
    if _DIGIT_SIGN.match(word[-1]) or _TWO_NAMES.fullmatch(word):
        return True
    return bool(_LETTER.match(word) and _DIGIT_SIGN.search(word))


def _name_ats(out: Rewritten) -> None:
    """`` at `` between an account's name and a plain domain; each word before one is read once."""
    edits, text, last = [], out.text, 0
    for m in _SPACED_WORD_AT.finditer(text):
        at = m.start()
        if _PLAIN_DOMAIN.match(text, m.end()):
            start = at
            while start > last and not text[start - 1].isspace():
                start -= 1
            if _is_name(text[start:at]):
                edits.append((at, m.end(), [("@", at, m.end())]))
        last = m.end()
    out.replace(edits)


def _mixed_numbers(out: Rewritten) -> None:
    edits = []
    for number in _MIXED_NUMBER.finditer(out.text):
        if len(number[0]) >= 9 and sum("0" <= c <= "9" for c in number[0]) >= 6:
            edits += [(i, i + 1, [(_AS_DIGIT[c], i, i + 1)]) for i, c in enumerate(number[0], number.start()) if c in _AS_DIGIT]
    out.replace(edits)


def _word_dots(out: Rewritten) -> None:
    """`` dot `` counts in what touches an at sign: the words that it chains to the sign's left or right, however many."""
    text, dots = out.text, list(_WORD_DOT.finditer(out.text))
    if not dots:
        return
    ends = [0, *[m.end() for m in dots]]
    begins = [*[m.start() for m in dots], len(text)]
    between = [text[a:b] for a, b in zip(ends, begins, strict=True)]
    # a chain goes on over whole labels only
    left = []
    for i in range(len(dots)):
        left.append(bool(_AT_LEFT.search(between[i])) or (i > 0 and left[-1] and bool(_LABEL.fullmatch(between[i]))))
    right = [False] * (len(dots) + 1)
    for i in range(len(dots) - 1, -1, -1):
        right[i] = bool(_AT_RIGHT.match(between[i + 1])) or (right[i + 1] and bool(_LOCAL_WORD.fullmatch(between[i + 1])))
    out.replace([(m.start(), m.end(), [(".", m.start(), m.end())]) for m, x, y in zip(dots, left, right, strict=False) if x or y])


def spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """(plain spans, all spans) of each kind, in order."""
    plain = find(text)
    out = rewrite(text)
    every = {k: list(v) for k, v in plain.items()}
    if out.changed:
        for kind, found in find(out.text).items():
            for a, b in map(out.source, found):
                if not any(x <= a and b <= y for x, y in plain[kind]):
                    every[kind].append((a, b))
            every[kind] = sorted(set(every[kind]))
    return plain, every


def listed(found: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in found[k])


def masked(text: str, sign: str = "█") -> str:
    """The text with every span's characters replaced; lengths and other offsets stay."""
    out = list(text)
    for found in spans(text)[1].values():
        for a, b in found:
            out[a:b] = sign * (b - a)
    return "".join(out)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of plain spans, their SHA-256, all spans, and counts with the disguised ones."""
    importable(docs.sparkSession)
    own = docs.select(as_column(id_col).alias("doc_id"), as_column(text_col).cast("string").alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {f"n_{k}{s}": [] for s in ("", "_all") for k in KINDS}
            sums, lists = [], []
            for text in batch["text"]:
                plain, every = spans(text.as_py() or "")
                for k in KINDS:
                    counts[f"n_{k}"].append(len(plain[k]))
                    counts[f"n_{k}_all"].append(len(every[k]))
                sums.append(hashlib.sha256(listed(plain).encode()).hexdigest())
                lists.append(listed(every))
            names = [f"n_{k}" for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(counts[n], pa.int64()) for n in names), pa.array(sums, pa.string()), pa.array(lists, pa.string()),
                 *(pa.array(counts[n + "_all"], pa.int64()) for n in names)],
                names=["doc_id", *names, "base_sha256", "spans", *(n + "_all" for n in names)])

    counted = ", ".join(f"n_{k} long" for k in KINDS)
    after = ", ".join(f"n_{k}_all long" for k in KINDS)
    return own.mapInArrow(search, f"doc_id {dict(own.dtypes)['doc_id']}, {counted}, base_sha256 string, spans string, {after}")
