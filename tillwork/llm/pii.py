"""Personal data with offset-preserving deobfuscation.

The plain text is searched first, per kind from left to right without overlaps (``BASE``). Then a transducer rewrites
disguises and keeps, for every character it writes, the source characters it stands for: characters that look like
ASCII (Cyrillic and Greek look-alikes, what NFKC or the digit property of Unicode gives, dashes and spaces), invisible ones,
spelled digits in runs or beside a disguised dot, and at/dot in brackets or as words of the four languages. The same search runs over the rewritten text, and its finds are mapped
back to source spans. A find that overlaps a plain one of its kind is dropped, so the method only adds spans.

A bare English "at" is a sign only before a domain that is disguised or ends in a name of ``_TOP``; in the second case not after
words such as "us" or "look", nor before "www.". Eight or nine spelled digits that only count up or down are no phone number.

A text without any disguise is not rewritten. All work is per row in one pass, without a shuffle.

Defined results: null is the empty text and has no spans; texts of any length, and numbers of any length in them, are read whole;
spans are code points, end exclusive; where kinds overlap each is listed, and of one kind the leftmost; repeated rows are judged
one by one; an empty table gives no rows; other columns are carried, but for those that bear the name of
an added one.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import tables

KINDS = ("email", "ip", "card", "phone")
#: What stands in for each kind when a text is masked.
MASKS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number run is entered at its start: from within, the pattern cannot match where it has failed before.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def plain_spans(text: str) -> list[Span]:
    """Personal data as written, by kind, then by place."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", *span) for span in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_is_byte, m.groups()))]
        found += [("card", *m.span()) for m in _CARD.finditer(text) if m.end() - m.start() >= 16 and _is_card(m.group())]
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m.group())) <= 15]
    return found


def _is_byte(digits: str) -> bool:
    """Up to 255, with any number of leading zeros: ``int`` refuses very long numbers, however small."""
    digits = digits.lstrip("0") or "0"
    return len(digits) <= 3 and int(digits) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the longest run of local characters before it, as far as earlier matches leave it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def _is_card(text: str) -> bool:
    digits = [int(one) for one in text if one not in " -"]
    if not 16 <= len(digits) <= 19:
        return False
    doubled = [2 * one - 9 if one > 4 else 2 * one for one in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


# The transducer.

# Characters that look like the ASCII character they are listed under.
_LOOK_ALIKES = {
    "a": "аαɑ", "c": "сϲ", "e": "еε", "h": "һ", "i": "іι", "j": "ј", "k": "кκ", "o": "оο", "p": "рρ", "s": "ѕ", "u": "υ", "v": "ν", "x": "хχ", "y": "у",
    "A": "АΑ", "B": "ВΒ", "C": "С", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "T": "ТΤ", "X": "ХΧ", "Y": "ΥҮ", "Z": "Ζ",
    "-": "\u2010\u2011\u2012\u2013\u2014\u2212\ufe63", ".": "\u2024\u3002\uff0e\uff61", "@": "\ufe6b", " ": "\u00a0\u2007\u2009\u200a\u202f",
    "": "\u200b\u200c\u200d\u2060\ufeff\u00ad",
}
# The names of the digits.
_DIGIT_NAMES = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}


def _characters() -> dict[str, str]:
    """ASCII for each character that stands for some: by the list above, as a digit of any script, or by NFKC."""
    found = {}
    for one in map(chr, range(0x80, 0x20000)):  # none beyond
        number = unicodedata.digit(one, None)
        plain = str(number) if number is not None else unicodedata.normalize("NFKC", one)
        if plain.isascii() and (len(plain) == 1 or plain.isalnum()):
            found[one] = plain
    return found | {one: plain for plain, listed in _LOOK_ALIKES.items() for one in listed}


_CHARACTERS = _characters()
_NAME = "|".join(sorted(_DIGIT_NAMES, key=len, reverse=True))
_NAMES = re.compile(rf"(?i)\b(?:plus[\s,.-]+)?(?:(?:{_NAME}|[0-9])[\s,.-]+){{6,}}(?:{_NAME}|[0-9])\b")
_ONE_NAME = re.compile(rf"(?i)\b(?:plus|{_NAME}|[0-9])\b")
# The names of the two signs, but for "at", which prose holds too.
_AT_NAMES = "arroba|arobase|arrobase|arobas|klammeraffe|ät"
_DOT_NAMES = "dot|punto|point|punkt"
_AT = rf"(?:\s*[\[({{<]\s*(?:at|{_AT_NAMES}|@)\s*[\])}}>]\s*|\s+(?:at|{_AT_NAMES})\s+)"
_DOT = rf"(?:\s*[\[({{<]\s*(?:{_DOT_NAMES}|\.)\s*[\])}}>]\s*|\s+(?:{_DOT_NAMES})\s+)"
_DISGUISED = re.compile(rf"(?i)(?<=[A-Z0-9])(?:{_DOT}|{_AT})(?=[A-Z0-9])")
_AT_ONLY = re.compile(rf"(?i){_AT}")
# Ends of domains; words before "at" that are no mailbox.
_TOP = "com|org|net|edu|gov|mil|int|info|biz|io|co|ai|app|dev|eu|de|at|ch|li|fr|be|lu|es|mx|ar|cl|pe|uk|ie|us|ca|au|nz|za|in|it|nl|pt|br|pl|cz|se|no|dk|fi|ru|jp|cn"
_NO_MAILBOX = frozenset(
    "us me him her them it you we they is are was were be been am look looks looking looked stay live lives work works worked working hosted"
    " found available online here there now out only sold bought published posted read see shop order register sign page site website".split()
)
_LABELS = r"[A-Z0-9-]+(?:\.[A-Z0-9-]+)*"
# A bare " at " counts where the domain after it is disguised anywhere, or (the second group) is plain but has a known end.
_BARE_AT = re.compile(
    rf"(?i)(?<=[A-Z0-9])\s+at\s+(?=(?:({_LABELS}{_DOT}[A-Z0-9])|(?!www\.)((?:[A-Z0-9-]+\.)+(?-i:{_TOP}|{_TOP.upper()}|Com|Org|Net)(?![\w-]|\.\w))))"
)
_LAST_WORD = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_HINT = re.compile(rf"(?i)[\[({{<]\s*(?:at|{_AT_NAMES}|{_DOT_NAMES}|[@.])\s*[\])}}>]|\s(?:{_AT_NAMES}|{_DOT_NAMES})\s")
_DOT_SIGN = re.compile(rf"(?i)(?<=[A-Z0-9]){_DOT}")
_SHORT_RUN = re.compile(rf"(?i)\b(?:{_NAME}|[0-9])(?:[\s,-]+(?:{_NAME}|[0-9]))*\b")
_DIGIT_WORDS = frozenset(_DIGIT_NAMES) | frozenset("0123456789")


def _has_digit_words(text: str) -> bool:
    """Whether five words in a row are digits or their names; of seven, brackets may hide the outer two."""
    words = text.lower().replace(",", " ").replace(".", " ").replace("-", " ").split()
    return b"\1" * 5 in bytes(map(_DIGIT_WORDS.__contains__, words))


class Rewritten:
    """A text with replaced stretches; places in it map back to the source."""

    def __init__(self, source: str, edits: list[tuple[int, int, str]]):
        """``edits``: (start, end, replacement) in order, without overlaps."""
        parts: list[str] = []
        self.starts, self.source, self.edited = [0], [0], [False]
        self.ends = [0]
        place = done = 0
        for start, end, text in edits:
            if start > done:
                self._open(place, done, start, False)
                parts.append(source[done:start])
                place += start - done
            if text:
                self._open(place, start, end, True)
                parts.append(text)
                place += len(text)
            done = end
        self._open(place, done, len(source), False)
        parts.append(source[done:])
        self.text = "".join(parts)

    def _open(self, place: int, start: int, end: int, edited: bool) -> None:
        self.starts.append(place)
        self.source.append(start)
        self.ends.append(end)
        self.edited.append(edited)

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The source span of ``text[start:end]``."""
        first, last = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        left = self.source[first] if self.edited[first] else self.source[first] + start - self.starts[first]
        right = self.ends[last] if self.edited[last] else self.source[last] + end - self.starts[last]
        return left, right


def _foreign_edits(text: str) -> list[tuple[int, int, str]]:
    if _CHARACTERS.keys().isdisjoint(text):
        return []
    return [(k, k + 1, _CHARACTERS[one]) for k, one in enumerate(text) if one in _CHARACTERS]


def _spelled_edits(text: str, signs: bool) -> list[tuple[int, int, str]]:
    """Digits in runs of seven or more, with ``signs`` also of any length beside a disguised dot, at least half of them
    names; the separators between them go."""
    runs = [match.span() for match in _NAMES.finditer(text)] if _has_digit_words(text) else []
    if signs:
        starts, ends = [start for start, _ in runs], [end for _, end in runs]
        dots = [match.span() for match in _DOT_SIGN.finditer(text)]
        before, after = {end for _, end in dots}, {start for start, _ in dots}
        for match in _SHORT_RUN.finditer(text) if dots else ():
            start, end = match.span()
            if (start in before or end in after) and bisect_right(starts, end - 1) == bisect_right(ends, start):
                runs.append((start, end))
        runs.sort()
    edits = []
    for start, end in runs:
        names = [one.lower() in _DIGIT_NAMES for one in _ONE_NAME.findall(text[start:end])]
        if 2 * sum(names) < len(names):
            continue
        done = start
        for one in _ONE_NAME.finditer(text, start, end):
            name = one.group().lower()
            edits.append((done, one.end(), "+" if name == "plus" else _DIGIT_NAMES.get(name, name)))
            done = one.end()
    return edits


def _is_mailbox(text: str, end: int) -> bool:
    word = _LAST_WORD.search(text, max(0, end - 64), end)
    return word is not None and word.group().lower() not in _NO_MAILBOX


def _sign_edits(text: str) -> list[tuple[int, int, str]]:
    bare = {match.span() for match in _BARE_AT.finditer(text) if match.group(1) or _is_mailbox(text, match.start())}
    edits = []
    for match in _DISGUISED.finditer(text):
        if _AT_ONLY.fullmatch(match.group()):
            if match.group().strip().lower() != "at" or match.span() in bare:
                edits.append((*match.span(), "@"))
        else:
            edits.append((*match.span(), "."))
    return edits


def added_spans(text: str, plain: list[Span]) -> list[Span]:
    """Personal data that only the rewritten text shows."""
    layers = []
    current = text
    if not text.isascii() and (edits := _foreign_edits(text)):
        layers.append(Rewritten(current, edits))
        current = layers[-1].text
    signs = _HINT.search(current) is not None or _BARE_AT.search(current) is not None
    if edits := _spelled_edits(current, signs):
        layers.append(Rewritten(current, edits))
        current = layers[-1].text
    if signs and (edits := _sign_edits(current)):
        layers.append(Rewritten(current, edits))
        current = layers[-1].text
    found: list[Span] = []
    for kind, start, end in plain_spans(current) if layers else ():
        for layer in reversed(layers):
            start, end = layer.span(start, end)
        if not any(k == kind and start < b and a < end for k, a, b in plain):
            found.append((kind, start, end))
    if layers:
        found += _spelled_numbers(layers, current, plain + found)
    return found


def _counts(digits: str) -> bool:
    return digits in "0123456789" or digits in "9876543210"


def _spelled_numbers(layers: list[Rewritten], current: str, known: list[Span]) -> list[Span]:
    """Runs of eight to fifteen spelled digits without a plus are phone numbers too."""
    found = []
    for match in re.finditer(r"(?<![0-9+])[0-9]{8,15}(?![0-9])", current):
        if len(match.group()) < 10 and _counts(match.group()):
            continue
        start, end = match.span()
        for layer in reversed(layers):
            start, end = layer.span(start, end)
        written = end - start
        if written >= 3 * len(match.group()) and not any(start < b and a < end for _, a, b in known):
            found.append(("phone", start, end))
    return found


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Plain spans and all spans, each by kind, then by place."""
    if not text:
        return [], []
    plain = plain_spans(text)
    added = added_spans(text, plain)
    return plain, sorted(plain + added, key=lambda one: (KINDS.index(one[0]), one[1:])) if added else plain


def _written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def annotate(documents: DataFrame) -> DataFrame:
    """``documents`` with counts, digest of the plain spans and the list of all spans."""
    names = ("n_email", "n_ip", "n_card", "n_phone")
    documents = tables.without(documents, (*names, "base_sha256", "spans"))
    added = [F.lit(0).cast("bigint").alias(name) for name in names] + [F.lit("").alias("base_sha256"), F.lit("").alias("spans")]
    schema = documents.select("*", *added).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], [], []]
            digests, spans = [], []
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                plain, every = find(text)
                for kind, column in zip(KINDS, counts):
                    column.append(sum(one[0] == kind for one in plain))
                digests.append(hashlib.sha256(_written(plain).encode()).hexdigest())
                spans.append(_written(every))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(x, pa.int64()) for x in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                [*batch.schema.names, *names, "base_sha256", "spans"],
            )

    return documents.mapInArrow(run, schema)


def masked(text: str | None) -> str | None:
    """The text with a mark in place of each span; spans that overlap share the first one's mark.

    Marks part what was too long to be one number, so the search is repeated until nothing is found.
    """
    while text and (spans := sorted(find(text)[1], key=lambda one: (one[1], -one[2]))):
        text = _marked(text, spans)
    return text


def _marked(text: str, spans: list[Span]) -> str:
    parts, done = [], 0
    kind, start, end = spans[0]
    for other, first, last in [*spans[1:], ("", len(text) + 1, 0)]:
        if first < end:
            end = max(end, last)
            continue
        parts += [text[done:start], MASKS[kind]]
        done = end
        kind, start, end = other, first, last
    return "".join([*parts, text[done:]])


def mask(documents: DataFrame) -> DataFrame:
    """``documents`` with personal data replaced in ``text``; other texts stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [masked(text) for text in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return documents.mapInArrow(run, documents.schema)


def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and spans of personal data in every document."""
    return annotate(tables.read(spark, folder, "documents").select("doc_id", "text")).drop("text")
