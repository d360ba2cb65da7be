"""Budget meter over a stream of actions.

Prices and validity are column expressions ahead of the stateful step; the step itself
only sums. An episode's state is spread over variables of different lives:

* ``meter``: units spent, steps, budget and the order key of the last row, while it is open;
* ``ended``: the mark of an episode that has ended; it expires, so ended episodes
  cost nothing for ever. A row that comes after that starts a new episode;
* ``runs``: sorted runs of rows while a micro-batch is being put in order.

Rows of a micro-batch come in pieces without order. One piece is sorted and summed at
once; of several, each is sorted and put aside in ``runs`` in chunks, and the runs
are merged chunk by chunk, so a task holds a chunk of each run and never an episode.

An open episode without rows for ``idle_seconds`` is closed like a log that ends without
a report: a forced ``submit_report`` without order key.

A row older than what its episode has passed comes out marked ``late`` and changes nothing.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from callsift.operators.actions import price_actions
from callsift.operators.replay import total_budget

_METER = "spent long, steps long, budget long, last_major long, last_minor long"
_RUN_KEY = "run int, chunk int"
_RUN = (
    "major array<long>, minor array<long>, cost array<long>, "
    "total_budget array<long>, action_type array<string>"
)
_COLUMNS = ["major", "minor", "cost", "total_budget", "action_type"]
OUTPUT = (
    "episode_id long, major long, minor long, action_type string, step long, "
    "remaining long, exhausted boolean, done boolean, late boolean"
)
#: Rows of a chunk of a sorted run.
CHUNK_ROWS = 2_048
#: How long it is remembered that an episode has ended.
ENDED_SECONDS = 7 * 24 * 3600


class BudgetMeter(StatefulProcessor):
    def __init__(self, ended_seconds: int, idle_seconds: int | None):
        self._ended_ms, self._idle = ended_seconds * 1000, idle_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._meter = handle.getValueState("meter", _METER)
        self._ended = handle.getValueState("ended", "at long", self._ended_ms)
        self._runs = handle.getMapState("runs", _RUN_KEY, _RUN)

    def handleInputRows(  # noqa: N802 - name set by Spark
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues
    ) -> Iterator[pd.DataFrame]:
        if self._ended.exists():
            for _ in rows:
                pass
            return
        state = self._meter.get() or (0, 0, 0, None, None)
        ended = False
        for batch in self._in_order(_pieces(rows)):
            found, state, ended = _metered(key, batch, state, ended)
            yield from found
        now = timerValues.getCurrentProcessingTimeInMs()
        if self._idle is not None:
            for timer in list(self._handle.listTimers()):
                self._handle.deleteTimer(timer)
        if ended:
            self._meter.clear()
            self._ended.update((now,))
        else:
            self._meter.update(state)
            if self._idle is not None:
                self._handle.registerTimer(now + 1000 * self._idle)

    def handleExpiredTimer(  # noqa: N802 - name set by Spark
        self, key: tuple, timerValues, expiredTimerInfo
    ) -> Iterator[pd.DataFrame]:
        state = self._meter.get()
        if state is None:
            return
        spent, steps, budget, _, _ = state
        self._meter.clear()
        self._ended.update((timerValues.getCurrentProcessingTimeInMs(),))
        forced = pd.DataFrame(
            {
                "major": pd.array([None], "Int64"),
                "minor": pd.array([None], "Int64"),
                "action_type": ["submit_report"],
            }
        )
        left = [budget - spent]
        yield _output(key, forced, step=[steps + 1], remaining=left, done=True)

    def close(self) -> None:
        pass

    def _in_order(self, pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows by their order key, in frames of bounded size."""
        first = next(pieces, None)
        second = next(pieces, None) if first is not None else None
        if first is None:
            return
        if second is None:
            yield _sorted(first)
            return
        sizes = [self._put(0, first), self._put(1, second)]
        for piece in pieces:
            sizes.append(self._put(len(sizes), piece))
        yield from self._merged(sizes)

    def _put(self, run: int, piece: pd.DataFrame) -> int:
        """Stores a piece as a sorted run; the number of its chunks."""
        piece = _sorted(piece)
        chunks = range(0, len(piece), CHUNK_ROWS)
        for k, at in enumerate(chunks):
            part = piece.iloc[at : at + CHUNK_ROWS]
            self._runs.updateValue((run, k), tuple(part[c].tolist() for c in _COLUMNS))
        return len(chunks)

    def _take(self, run: int, chunk: int) -> pd.DataFrame:
        """A stored chunk, which is removed."""
        values = self._runs.getValue((run, chunk))
        self._runs.removeKey((run, chunk))
        return pd.DataFrame(dict(zip(_COLUMNS, map(list, values), strict=True)))

    def _merged(self, sizes: list[int]) -> Iterator[pd.DataFrame]:
        """Merges runs: what is not above the least last key of the open chunks is final."""
        open_chunks = {r: self._take(r, 0) for r, n in enumerate(sizes) if n}
        taken = dict.fromkeys(open_chunks, 1)
        while open_chunks:
            last = {r: _key(c.iloc[-1]) for r, c in open_chunks.items()}
            least = min(last.values())
            ready = []
            for run in list(open_chunks):
                chunk = open_chunks[run]
                n = len(chunk) if last[run] == least else _below(chunk, least)
                if n:
                    ready.append(chunk.iloc[:n])
                    open_chunks[run] = chunk.iloc[n:]
                if n == len(chunk):
                    if taken[run] < sizes[run]:
                        open_chunks[run] = self._take(run, taken[run])
                        taken[run] += 1
                    else:
                        del open_chunks[run]
            yield _sorted(pd.concat(ready, ignore_index=True))


def _pieces(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return (piece[_COLUMNS] for piece in rows if len(piece))


def _sorted(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.iloc[np.lexsort((rows["minor"], rows["major"]))]


def _key(row: pd.Series) -> tuple[int, int]:
    return int(row["major"]), int(row["minor"])


def _below(chunk: pd.DataFrame, key: tuple[int, int]) -> int:
    """Rows of a sorted chunk that are not above a key."""
    major, minor = chunk["major"].to_numpy(), chunk["minor"].to_numpy()
    return int(((major < key[0]) | ((major == key[0]) & (minor <= key[1]))).sum())


def _metered(
    key: tuple, batch: pd.DataFrame, state: tuple, ended: bool
) -> tuple[list[pd.DataFrame], tuple, bool]:
    """What ordered rows give, and the state after them."""
    spent, steps, budget, last_major, last_minor = state
    if ended:
        return [], state, True
    found = []
    if last_major is not None:
        passed = _below(batch, (last_major, last_minor))
        if passed:
            found.append(_output(key, batch.iloc[:passed], late=True))
            batch = batch.iloc[passed:]
    if batch.empty:
        return found, state, False
    cost, budgets = batch["cost"].to_numpy(), batch["total_budget"].to_numpy()
    submits = (batch["action_type"] == "submit_report").to_numpy()
    total = spent + np.cumsum(cost)
    too_dear = ~submits & (total > budgets)
    closing = submits | too_dear
    # Up to and including the first row that closes the episode.
    ended = bool(closing.any())
    n = int(closing.argmax()) + 1 if ended else len(batch)
    used = total[:n] - np.where(too_dear[:n], cost[:n], 0)
    found.append(
        _output(
            key,
            batch.iloc[:n],
            step=np.arange(steps + 1, steps + n + 1),
            remaining=budgets[:n] - used,
            exhausted=too_dear[:n],
            done=closing[:n],
        )
    )
    state = (int(used[-1]), steps + n, int(budgets[n - 1]), *_key(batch.iloc[-1]))
    return found, state, ended


def _output(key: tuple, rows: pd.DataFrame, late: bool = False, **found) -> pd.DataFrame:
    unknown = pd.array([None] * len(rows), dtype="Int64")
    return pd.DataFrame(
        {
            "episode_id": key[0],
            "major": rows["major"].to_numpy(),
            "minor": rows["minor"].to_numpy(),
            "action_type": rows["action_type"].to_numpy(),
            "step": found.get("step", unknown),
            "remaining": found.get("remaining", unknown),
            "exhausted": found.get("exhausted", False),
            "done": found.get("done", False),
            "late": late,
        }
    )


def meter_stream(
    actions: DataFrame,
    major: str,
    minor: str,
    ended_seconds: int = ENDED_SECONDS,
    idle_seconds: int | None = None,
) -> DataFrame:
    """Remaining budget after every counted action of a stream.

    ``major`` and ``minor`` name whole-number columns that order an episode. The stream
    needs a state store that can hold several variables: ``sinks`` start it with one.
    """
    priced = price_actions(actions).select(
        "episode_id",
        F.col(major).cast("long").alias("major"),
        F.col(minor).cast("long").alias("minor"),
        "action_type",
        F.col("cost").cast("long").alias("cost"),
        total_budget().cast("long").alias("total_budget"),
    )
    return priced.groupBy("episode_id").transformWithStateInPandas(
        statefulProcessor=BudgetMeter(ended_seconds, idle_seconds),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="ProcessingTime",
    )
