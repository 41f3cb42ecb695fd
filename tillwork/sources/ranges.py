"""Ranges of a key that together hold every row of a table once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql.datasource import InputPartition

#: The n-th key in order, from 0, of the rows that ``where`` leaves, in two spellings of SQL.
NTH_LIMIT = "SELECT {key} FROM {table} WHERE {where} ORDER BY {key} LIMIT 1 OFFSET {n}"
NTH_OFFSET = "SELECT {key} FROM {table} WHERE {where} ORDER BY {key} OFFSET {n} ROWS FETCH NEXT 1 ROWS ONLY"


def literal(value: object, moment: str = "'{value}'", escaped_backslash: bool = False) -> str:
    """``value`` as SQL; ``moment`` is how the database writes points in time."""
    if isinstance(value, bool):
        raise TypeError("a flag is no key")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return moment.format(value=value.isoformat(sep=" "))
    if isinstance(value, dt.date):
        return moment.format(value=value.isoformat() + " 00:00:00") if "TIMESTAMP" in moment else moment.format(value=value.isoformat())
    if isinstance(value, str):
        text = value.replace("\\", "\\\\") if escaped_backslash else value
        return "'" + text.replace("'", "''") + "'"
    raise TypeError(f"keys of type {type(value).__name__} cannot be cut")


@dataclass
class KeyRange(InputPartition):
    """``low <= key < high``; a missing bound is open, and the first range also takes NULL keys."""

    low: object | None
    high: object | None

    def where(self, key: str, moment: str = "'{value}'", escaped_backslash: bool = False) -> str:
        parts = []
        if self.low is not None:
            parts.append(f"{key} >= {literal(self.low, moment, escaped_backslash)}")
        if self.high is not None:
            parts.append(f"{key} < {literal(self.high, moment, escaped_backslash)}")
        if not parts:
            return "1 = 1"
        bounded = " AND ".join(parts)
        return bounded if self.low is not None else f"({bounded} OR {key} IS NULL)"


def ranges_between(cuts: Sequence[object]) -> list[KeyRange]:
    """The ranges around the cut values, open at both ends."""
    return [KeyRange(a, b) for a, b in zip([None, *cuts], [*cuts, None])]


def key_ranges(low: int | None, high: int | None, parts: int) -> list[KeyRange]:
    """Even ranges of whole numbers from the smallest to the largest."""
    if low is None or high is None or parts < 2 or high <= low:
        return [KeyRange(None, None)]
    parts = min(parts, high - low + 1)
    return ranges_between([low + (high - low + 1) * number // parts for number in range(1, parts)])


def cuts_of(
    ask: Callable[[str], list[tuple]],
    table: str,
    key: str,
    parts: int,
    nth: str = NTH_LIMIT,
    moment: str = "'{value}'",
    escaped_backslash: bool = False,
) -> list[object]:
    """Distinct keys at about even positions in the database's own order, so that the same order decides in every range.

    Works for text, numbers, dates and times. ``ask`` runs a query and returns its rows. Every question starts behind the cut before
    it, so all of them together walk the index of the key once, however many parts there are. Rows that repeat
    a cut stay with its range, which then holds more than its share; the cuts behind it move on by as much.
    """
    count = int(ask(f"SELECT COUNT({key}) AS n FROM {table}")[0][0])
    places = sorted({count * number // parts for number in range(1, parts)} - {0, count})
    cuts: list[object] = []
    passed = 0
    for place in places:
        behind = f"{key} > {literal(cuts[-1], moment, escaped_backslash)}" if cuts else f"{key} IS NOT NULL"
        found = ask(nth.format(key=key, table=table, where=behind, n=place - passed))
        if not found:  # rows that repeat a cut have used up the places
            break
        if not cuts or found[0][0] != cuts[-1]:
            cuts.append(found[0][0])
            passed = place + 1
    return cuts
