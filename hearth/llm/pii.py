"""Personal data with offset-preserving deobfuscation.

Base detectors find e-mail addresses, IPv4 addresses, card and phone numbers in
the text as it stands.  Then two transducers rewrite the text while carrying
the source span of every output character: the first folds look-alike and
full-width characters and drops invisible ones, the second turns disguised
``@`` and ``.`` and spelled digits into the characters they stand for.  The same
detectors run over the result, and their spans are mapped back to the source.
Spans are code points, end exclusive; all scans are linear in the text.

Null and empty texts have no spans; rows are judged each by itself, so copies,
ties and extra columns need no care.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Characters that look like ASCII ones.
_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "һ": "h", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ɡ": "g", "ɑ": "a", "ο": "o", "α": "a", "ν": "v", "ρ": "p", "υ": "u",
    "ι": "i", "κ": "k", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I",
    "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "‐": "-", "‑": "-", "‒": "-",
    "–": "-", "−": "-", "․": ".", "。": ".", "﹒": ".", "﹫": "@", " ": " ", " ": " ", " ": " ",
}
_INVISIBLE = "​‌‍⁠﻿­"
_DIGIT_WORDS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())}
_DIGIT_WORDS["oh"] = "0"


def _fold_table() -> dict[int, str]:
    table = {ord(k): v for k, v in _LOOKALIKES.items()}
    table |= {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}  # full width
    for c in range(0x80, 0x20000):
        if unicodedata.category(chr(c)) == "Nd":
            table[c] = str(unicodedata.decimal(chr(c)))
        elif 0x1D400 <= c < 0x1D7CE or 0x2460 <= c < 0x24FF:  # mathematical letters, enclosed ones
            plain = unicodedata.normalize("NFKC", chr(c))
            if len(plain) == 1 and plain.isascii():
                table[c] = plain
    return table


_FOLD = _fold_table()
_ODD = re.compile("[" + re.escape(_INVISIBLE + "".join(map(chr, _FOLD))) + "]")
_NOT_LATIN = re.compile("[^\x00-\x9f\xa1-\xac\xae-\u024f]")  # a quick test before it
_O = r"[\[({<]\s{0,3}"
_C = r"\s{0,3}[\])}>]"
_AT_WORDS, _DOT_WORDS = r"(?:at|arroba)", r"(?:dot|punto|punkt)"
_DIGITS = "|".join(_DIGIT_WORDS)
#: cheap tests on the lower-cased text, each behind substrings that it needs;
#: without any of them the base spans are all
_HINTS = [
    (("(", "[", "{", "<"), re.compile(rf"{_O}(?:{_AT_WORDS}|{_DOT_WORDS}|@|\.){_C}")),
    (("dot", "punto", "punkt"), re.compile(rf"{_DOT_WORDS}\s")),
    (("at ", "at\n", "at\t", "arroba"), re.compile(rf"{_AT_WORDS}\s{{1,3}}[a-z0-9-]{{1,64}}\.[a-z]")),
    (("@",), re.compile(r"\s@|@\s")),
    (tuple(w for w in _DIGIT_WORDS if w not in ("one", "oh")), re.compile(rf"(?:{_DIGITS})[\s,-]{{1,3}}(?:{_DIGITS})")),
    (("one one", "one-one", "one,"), re.compile(r"one[\s,-]{1,3}one")),
    (tuple("0123456789"), re.compile(r"[0-9][ -]?[oil][ -]?[0-9]")),
]
_TOKENS = re.compile(
    rf"(?P<at>\s{{0,3}}{_O}(?:{_AT_WORDS}|@){_C}\s{{0,3}}|\s{{1,3}}@\s{{0,3}}(?=[a-z0-9])|@\s{{1,3}}(?=[a-z0-9]))"
    rf"|(?P<dot>\s{{0,3}}{_O}(?:{_DOT_WORDS}|\.){_C}\s{{0,3}})"
    rf"|(?P<weak_dot>\s{{1,3}}(?:{_DOT_WORDS}|\.)\s{{1,3}}(?=[a-z0-9]))"
    rf"|(?P<weak_at>\s{{1,3}}{_AT_WORDS}\s{{1,3}}(?=[a-z0-9]))"
    rf"|(?P<plus>(?<![a-z])plus\s{{1,3}}(?=(?:{_DIGITS}|[0-9])))"
    rf"|(?P<digits>(?<![a-z])(?:{_DIGITS})(?:[\s,-]{{1,3}}(?:{_DIGITS}))*(?![a-z]))"
    rf"|(?P<letter>(?:(?<=[0-9])|(?<=[0-9][ -]))[oil](?=[ -]?[0-9]))",
    re.I,
)
_DIGIT_WORD = re.compile(_DIGITS, re.I)
_STANDS_FOR = {"at": "@", "weak_at": "@", "dot": ".", "weak_dot": ".", "plus": "+"}


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of the e-mail pattern, found from each
    ``@`` outwards instead of from each character."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        lead = text[done:at]
        start = done + len(lead.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _ips(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _DOTTED.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, at = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                out.append((at, at + size))
            at += size + 1
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base detectors."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    out += [(a, 1, b) for a, b in _ips(text)]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


class Tape:
    """A text with the source span of each of its characters."""

    def __init__(self, text: str, starts=None, ends=None):
        self.text = text
        self.starts = starts if starts is not None else range(len(text))
        self.ends = ends if ends is not None else range(1, len(text) + 1)


def fold(tape: Tape) -> Tape:
    """First transducer: look-alikes to ASCII, invisible characters dropped."""
    text = tape.text.translate(_FOLD)
    if not any(c in text for c in _INVISIBLE):
        return Tape(text, tape.starts, tape.ends)
    keep = [i for i, c in enumerate(text) if c not in _INVISIBLE]
    return Tape("".join([text[i] for i in keep]), [tape.starts[i] for i in keep], [tape.ends[i] for i in keep])


def reveal(tape: Tape) -> tuple[Tape, set[int], set[int]]:
    """Second transducer: disguised ``@``, ``.`` and digits become characters
    that span their disguise.  Also the places of bare-word at and dot."""
    out, starts, ends, weak_at, weak_dot, done = [], [], [], set(), set(), 0
    s, e, text = tape.starts, tape.ends, tape.text

    def copy(lo, hi):
        out.append(text[lo:hi])
        starts.extend(s[lo:hi])
        ends.extend(e[lo:hi])

    for m in _TOKENS.finditer(text):
        copy(done, m.start())
        done = m.end()
        kind = m.lastgroup
        if kind == "digits":
            for w in _DIGIT_WORD.finditer(text, m.start(), m.end()):
                out.append(_DIGIT_WORDS[w[0].lower()])
                starts.append(s[w.start()])
                ends.append(e[w.end() - 1])
            continue
        if kind == "weak_at":
            weak_at.add(len(starts))
        elif kind == "weak_dot":
            weak_dot.add(len(starts))
        out.append(_STANDS_FOR.get(kind) or ("0" if m[0] in "oO" else "1"))
        starts.append(s[m.start()])
        ends.append(e[m.end() - 1])
    copy(done, len(text))
    return Tape("".join(out), starts, ends), weak_at, weak_dot


def _plausible(tape: Tape, a: int, b: int, weak_at: set[int], weak_dot: set[int]) -> bool:
    """Whether an e-mail on the revealed tape may stand for one: a top domain
    of letters and, behind a bare word "at", either a bare or bracketed dot or a
    local part that prose does not have."""
    found = tape.text[a:b]
    local, _, domain = found.partition("@")
    top = domain.rpartition(".")[2]
    if not (2 <= len(top) <= 12 and top.isalpha()):
        return False
    at = a + len(local)
    if at not in weak_at:
        return True
    dots = [i for i in range(at + 1, b) if tape.text[i] == "."]
    return any(i in weak_dot or tape.ends[i] - tape.starts[i] > 1 for i in dots) or any(not c.isalpha() for c in local)


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of disguised identifiers, in source characters, that no base span
    of their kind contains."""
    odd = not text.isascii() and _NOT_LATIN.search(text) is not None and _ODD.search(text) is not None
    low = text.lower()
    if not odd and not any(any(w in low for w in need) and h.search(low) for need, h in _HINTS):
        return []
    tape = fold(Tape(text)) if odd else Tape(text)
    shown, weak_at, weak_dot = reveal(tape)
    found = set()
    for t, at_words, dot_words in ((tape, set(), set()), (shown, weak_at, weak_dot)):
        for a, kind, b in base_spans(t.text):
            if kind or _plausible(t, a, b, at_words, dot_words):
                found.add((t.starts[a], kind, t.ends[b - 1]))
    return sorted(x for x in found if not any(k == x[1] and a <= x[0] and x[2] <= b for a, k, b in base))


def _line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_spans(df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: key, base counts per kind (n_email, n_ip, n_card, n_phone),
    base_spans and spans (base and added) as ``kind:start:end`` lists."""
    slim = df.select(key, text_col)
    names = [key, *(f"n_{k}" for k in KINDS), "base_spans", "spans"]
    schema = T.StructType(
        [slim.schema[key]] + [T.StructField(n, T.LongType()) for n in names[1:5]] + [T.StructField(n, T.StringType()) for n in names[5:]]
    )

    def run(batches):
        for batch in batches:
            counts, base_out, all_out = ([], [], [], []), [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text) if text else []
                extra = added_spans(text, base) if text else []
                for k in range(4):
                    counts[k].append(sum(x[1] == k for x in base))
                base_out.append(_line(base))
                all_out.append(_line(sorted(base + extra)) if extra else base_out[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(base_out, pa.string()), pa.array(all_out, pa.string())],
                names=names,
            )

    return slim.mapInArrow(run, schema)


def redact(text: str | None) -> str:
    """The text with every span replaced by its kind in brackets."""
    if not text:
        return ""
    base, out, done = base_spans(text), [], 0
    for a, k, b in sorted(base + added_spans(text, base)):
        if b <= done:
            continue
        out.append(text[done : max(a, done)] + f"[{KINDS[k].upper()}]")
        done = b
    return "".join(out) + text[done:]

