"""Only what has changed since the last poll, by state kept across micro-batches.

Open incidents are polled again and again, mostly unchanged. For every incident the state
has the place of the latest poll that has it and a digest of what that poll said. Records
that say the same again go no further, so a merge downstream gets as many rows as have
changed. Incidents are dealt to shares by their key; a share's state is one value, read and
written once a micro-batch, which costs in proportion to the incidents polled lately.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadevents.schema import FIELDS, MERGE_KEYS
from roadevents.sinks.files import PARTITION
from roadevents.streaming.ingest import BLOCK, POSITION

_SEEN, _SHARE = "_seen_at", "_share"
# An incident and what it says as two numbers each: 128 bits.
_INCIDENT, _SAID = ["_incident_a", "_incident_b"], ["_said_a", "_said_b"]
_POLL = ["_day", "_polled", "_file"]
_KNOWN = [*_INCIDENT, *_POLL, *_SAID]


def changed_records(
    stream: DataFrame,
    keys: Sequence[str] = MERGE_KEYS,
    *,
    forget: str = "2 days",
    shares: int = 256,
) -> DataFrame:
    """The records of ``landed_stream`` that differ from those of the poll before.

    Per poll an incident has one record, the first. The order of polls is that of the
    stored tables: day, time and name of the file. A poll older than the latest one of the
    incident is late and changes nothing, whether it comes with it or afterwards; so the
    outcome does not depend on how polls fall into micro-batches. A record polled
    ``forget`` before the newest one of an earlier micro-batch is late for every incident
    and left out. An incident that no poll has had for longer than that is forgotten: when
    it comes back, its record counts as changed. Records without a complete key are incidents
    by all they say. ``shares`` bounds what a task holds at once: the incidents of a share.
    """
    place = POSITION if POSITION in stream.columns else BLOCK
    columns = stream.columns
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    said = [F.xxhash64(F.lit(seed), *FIELDS) for seed in (1, 2)]
    incident = [F.xxhash64(F.lit(seed), *keys) for seed in (3, 4)]
    marks = dict(zip(_SAID, said))
    marks |= {n: F.when(complete, i).otherwise(s) for n, i, s in zip(_INCIDENT, incident, said)}
    marks[_SEEN] = F.col("polled_at").cast("timestamp")
    marks |= {"_day": F.unix_date(PARTITION), "_polled": F.unix_micros(marks[_SEEN])}
    marked = stream.withColumns(marks).withColumn(_SHARE, F.pmod(_INCIDENT[0], F.lit(shares)))
    kept_us = _microseconds(stream, forget)

    def changes(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames), ignore_index=True)
        rows["_file"] = rows["file"]
        known = _unpacked(state.get[0]) if state.exists else pd.DataFrame(columns=_KNOWN)
        kept, known = _compared(known, _first(rows, place), kept_us)
        known = known[known["_polled"] >= state.getCurrentWatermarkMs() * 1000 - kept_us]
        state.update((_packed(known),))
        newest = max(int(rows["_polled"].max()) // 1000, state.getCurrentWatermarkMs())
        state.setTimeoutTimestamp(newest + kept_us // 1000 + 1)
        yield rows.loc[sorted(kept), columns]

    grouped = marked.withWatermark(_SEEN, forget).groupBy(_SHARE)
    return grouped.applyInPandasWithState(
        changes, stream.schema, "known binary", "append", GroupStateTimeout.EventTimeTimeout
    )


def _sorted(*columns: np.ndarray) -> np.ndarray:
    """Places in the order of the columns, rows that are equal in all as they come.

    Columns of one value cost no sorting: a micro-batch mostly has one poll.
    """
    varying = [c for c in columns if len(c) and (c != c[0]).any()]
    size = len(columns[0])
    return np.lexsort(varying[::-1]) if varying else np.arange(size)


def _turns(*columns: np.ndarray) -> np.ndarray:
    """Which rows differ from the one before in any column; the first does."""
    turns = np.ones(len(columns[0]), bool)
    turns[1:] = False
    for c in columns:
        turns[1:] |= c[1:] != c[:-1]
    return turns


def _numbers(df: pd.DataFrame) -> dict[str, np.ndarray]:
    """The columns of ``_KNOWN`` as whole numbers: of a file its rank by name, of what is
    null a number above all others."""
    found = {n: df[n].to_numpy() for n in (*_INCIDENT, *_SAID, "_polled")}
    found = {n: v.astype(np.int64) for n, v in found.items()}
    above = np.iinfo(np.int64).max
    found["_day"] = df["_day"].astype("Int64").fillna(above).to_numpy(np.int64)
    codes, names = pd.factorize(df["_file"], sort=True)
    found["_file"] = np.where(codes < 0, len(names), codes)
    return found


def _first(rows: pd.DataFrame, place: str) -> pd.DataFrame:
    """Per incident and poll the first record, with what ``_KNOWN`` has of it."""
    v = _numbers(rows)
    poll = [*(v[n] for n in _INCIDENT), *(v[n] for n in _POLL)]
    order = _sorted(*poll, rows[place].to_numpy())
    return rows[_KNOWN].take(order[_turns(*(c[order] for c in poll))])


def _compared(
    known: pd.DataFrame, fresh: pd.DataFrame, forget_us: int
) -> tuple[list[int], pd.DataFrame]:
    """Which rows of ``fresh`` say something new, and what is known after them.

    ``known`` has one row an incident, ``fresh`` one an incident and poll.
    """
    both = pd.concat([known, fresh], ignore_index=True) if len(known) else fresh.reset_index(drop=True)
    old = np.arange(len(both)) < len(known)
    row = np.concatenate((np.full(len(known), -1), fresh.index.to_numpy()))
    v = _numbers(both)
    # A poll that is known stands before its own repetition is looked at, which is late.
    order = _sorted(*(v[n] for n in (*_INCIDENT, *_POLL)), old)
    old = old[order]
    incident = np.cumsum(_turns(*(v[n][order] for n in _INCIDENT))) - 1
    at = np.arange(len(order))
    latest = np.full(len(order), -1)
    latest[incident[old]] = at[old]
    current = at >= latest[incident]
    order, old, incident = order[current], old[current], incident[current]
    new_incident = _turns(incident)
    polled = v["_polled"][order]
    same = ~(new_incident | _turns(*(v[n][order] for n in _SAID)))
    same[1:] &= polled[1:] - polled[:-1] <= forget_us
    last = np.append(new_incident[1:], True)[: len(order)]
    return row[order[~same & ~old]].tolist(), both[_KNOWN].take(order[last])


def _packed(known: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(known, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(value).read_all().to_pandas()


def _microseconds(df: DataFrame, span: str) -> int:
    start = "timestamp'1970-01-03 00:00:00'"
    row = df.sparkSession.sql(f"SELECT unix_micros({start} + interval {span}) - unix_micros({start})")
    return int(row.first()[0])
