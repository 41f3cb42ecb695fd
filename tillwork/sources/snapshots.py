"""One state of a database for all the connections of a load.

Cut values, ranges and tables are read over many connections. A product with a past to ask for gets the same moment put into
every question. One without is watched: its state is asked before the first question and again when all rows are
read, and a load during which anything was committed is refused before it is shown. A product that offers neither is refused at once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

Ask = Callable[[str], list[tuple]]


class NoSnapshot(RuntimeError):
    """The product cannot give or watch one state."""


class SourceChanged(RuntimeError):
    """Something was committed in the source while it was read."""


@dataclass(frozen=True)
class SnapshotSql:
    """How a product names its state.

    ``state`` asks for it. ``as_of`` is the FROM item of a table at that state; without it the state is watched instead.
    """

    state: str
    as_of: str | None = None


# What the products' SQL asks for. The first has no past over several connections, but a set of all transactions; the
# second keeps one by change numbers, as far back as it retains undo; the third keeps one for system-versioned tables.
SNAPSHOTS = {
    "mysql": SnapshotSql(state="SELECT NULLIF(@@GLOBAL.gtid_executed, '') AS state"),
    "oracle": SnapshotSql(
        state="SELECT TO_CHAR(DBMS_FLASHBACK.GET_SYSTEM_CHANGE_NUMBER) AS state FROM DUAL", as_of="{table} AS OF SCN {state}"
    ),
    "azuresql": SnapshotSql(
        state="SELECT CONVERT(VARCHAR(27), SYSUTCDATETIME(), 121) AS state", as_of="{table} FOR SYSTEM_TIME AS OF '{state}'"
    ),
}


@dataclass(frozen=True)
class Snapshot:
    """The state that a load reads; one serves any number of tables."""

    sql: SnapshotSql
    state: str
    ask: Ask = field(repr=False, compare=False)

    def table(self, name: str) -> str:
        """What to write after FROM."""
        return name if self.sql.as_of is None else self.sql.as_of.format(table=name, state=self.state)

    def verify(self) -> None:
        """Call when all rows are read and before anyone sees them."""
        if self.sql.as_of is None:
            now = _state(self.sql, self.ask)
            if now != self.state:
                raise SourceChanged(f"the source went from state {self.state} to {now} while it was read")


def _state(sql: SnapshotSql, ask: Ask) -> str:
    found = ask(sql.state)
    if not found or found[0][0] is None:
        raise NoSnapshot(f"the source does not tell its state: {sql.state}")
    return str(found[0][0])


def take_snapshot(kind: str, ask: Ask, known: dict[str, SnapshotSql] | None = None) -> Snapshot:
    """The present state of a source of ``kind``, which ``known`` or ``SNAPSHOTS`` describes."""
    sql = (SNAPSHOTS | (known or {})).get(kind)
    if sql is None:
        raise NoSnapshot(f"no way is known to read one state of a source of kind {kind!r}")
    return Snapshot(sql, _state(sql, ask), ask)
