"""Plain versions of the operators, row by row and pair by pair, to compare with."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def repeats(documents, length=50):
    """doc_id -> (bytes, removed, spans, digest of the rest)."""
    known: dict[bytes, int] = {}
    for doc_id, text in documents:
        raw = (text or "").encode()
        for k in range(len(raw) - length + 1):
            window = raw[k : k + length]
            known[window] = min(doc_id, known.get(window, doc_id))
    out = {}
    for doc_id, text in documents:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if known[raw[k : k + length]] < doc_id:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k, one in enumerate(gone) if one and (k == 0 or not gone[k - 1]))
        out[doc_id] = len(raw), sum(gone), spans, sha(bytes(one for one, cut in zip(raw, gone) if not cut))
    return out


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1)))


def near_components(documents):
    """id -> smallest id it reaches, for (id, text) rows in which ids may repeat with differing texts."""
    rows = list({(doc_id, shingles(text)) for doc_id, text in documents})
    group = {doc_id: doc_id for doc_id, _ in rows}
    for k, (first, one) in enumerate(rows):
        for second, other in rows[:k]:
            common = len(one & other)
            if common and 100 * common >= 80 * len(one | other):
                low, high = sorted((group[first], group[second]))
                group = {doc_id: low if at == high else at for doc_id, at in group.items()}
    return group


def near_groups(documents):
    """doc_id -> (set size, smallest id of its component)."""
    sets = {doc_id: shingles(text) for doc_id, text in documents}
    group = {doc_id: doc_id for doc_id in sets}
    ids = sorted(sets)
    for k, first in enumerate(ids):
        for second in ids[:k]:
            common = len(sets[first] & sets[second])
            if common and 100 * common >= 80 * len(sets[first] | sets[second]):
                old, new = group[first], group[second]
                low = min(old, new)
                group = {one: low if at in (old, new) else at for one, at in group.items()}
    return {doc_id: (len(sets[doc_id]), group[doc_id]) for doc_id in ids}


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def contamination(documents, benchmark):
    """doc_id -> (words, hit words, items, digest of items, any hit)."""
    windows: dict[tuple, set[str]] = {}
    for item_id, text in benchmark:
        words = item_words(text)
        size = min(10, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[k : k + size]), set()).update([] if item_id is None else [str(item_id)])
    out = {}
    for doc_id, text in documents:
        words = item_words(text)
        hit, items = set(), set()
        for size in {len(one) for one in windows}:
            for k in range(len(words) - size + 1):
                names = windows.get(tuple(words[k : k + size]))
                if names is not None:
                    hit.update(range(k, k + size))
                    items |= names
        out[doc_id] = len(words), len(hit), len(items), sha(",".join(sorted(items))), bool(hit)
    return out


_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def personal_data(text):
    def luhn(digits):
        total = 0
        for k, one in enumerate(reversed(digits)):
            value = int(one) * (1 + k % 2)
            total += value - 9 if value > 9 else value
        return total % 10 == 0

    def digits(match):
        return re.sub("[^0-9]", "", match.group())

    found = [("email", *m.span()) for m in _EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(re.fullmatch("0*([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])", x) for x in m.group().split("."))]
    found += [("card", *m.span()) for m in _CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return found + [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


def rule_measures(text):
    """words, characters in words, symbols, repeated lines, words in repeated windows."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [one for one in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", one)]
    places: dict[tuple, list[int]] = {}
    for k in range(len(words) - 7):
        places.setdefault(tuple(words[k : k + 8]), []).append(k)
    hit = {k + j for found in places.values() if len(found) > 1 for k in found for j in range(8)}
    return len(words), sum(map(len, words)), sum(text.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def filter_failures(documents):
    """(part, failure bits of A to E) of (id, text, language) rows."""
    known = {}
    for doc_id, text, _ in documents:
        if doc_id is not None:
            known[text or ""] = min(doc_id, known.get(text or "", doc_id))
    out = []
    for doc_id, text, lang in documents:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = (
            len(words) < 100,
            100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            any(one in "#$%&*|" for one in text),
            doc_id is not None and known[text] < doc_id,
        )
        out.append((lang or "", sum(1 << k for k, one in enumerate(failed) if one)))
    return out


def filter_audit(documents, labels):
    """(part, order, step) -> the seven figures, by applying the filters document by document."""
    good = {doc_id for doc_id, quality, _ in labels if quality == 1 and doc_id is not None}
    toxic = {doc_id for doc_id, _, toxic in labels if toxic == 1 and doc_id is not None}
    judged = [(part, failed, row[0] in good, row[0] in toxic) for row, (part, failed) in zip(documents, filter_failures(documents))]
    out, shares = {}, {}
    for part in {row[0] for row in judged}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [row for row in judged if row[0] == part]
            failing = {name: sum(row[1] >> k & 1 for row in left) for k, name in enumerate("ABCDE")}
            only = {name: sum(row[1] == 1 << k for row in left) for k, name in enumerate("ABCDE")}
            for step, name in enumerate(order, 1):
                gone = [row for row in left if row[1] >> "ABCDE".index(name) & 1]
                left = [row for row in left if not row[1] >> "ABCDE".index(name) & 1]
                shares[part, name] = shares.get((part, name), 0) + len(gone)
                out[part, order, step] = (
                    len(left), len(gone), failing[name] - len(gone), only[name], sum(row[2] for row in gone), sum(row[3] for row in gone),
                )
    return {key: (*row, shares[key[0], key[1][key[2] - 1]]) for key, row in out.items()}


def best_documents(documents, items, top=20):
    """Rows (item id, rank, id, score) by scoring every document for every item."""
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))

    docs = [(doc_id, terms(text)) for doc_id, text in documents]
    docs = [(doc_id, Counter(words), len(words)) for doc_id, words in docs if words]
    n, size = len(docs), sum(one[2] for one in docs)
    holding = Counter(term for _, counts, _ in docs for term in counts)
    out = []
    for item_id, text in set(items):
        needs, found = Counter(terms(text)), []
        for doc_id, counts, length in docs:
            m = 100 - 25 + (25 * length * n) // size
            score = 0
            for term, times in needs.items():
                if counts[term]:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * holding[term] + 1)))
                    score += times * weight * ((1000000000 * counts[term]) // (1000 * counts[term] + 12 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, rank, None if none else doc_id, -score) for rank, (score, none, doc_id) in enumerate(sorted(found)[:top], 1)]
    return out
