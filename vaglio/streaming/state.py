"""Streaming twins of the change detection and of the error streaks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vaglio.operators.incremental import ChangeFeed

#: Outcomes that a source may be late by: as many of its last ones are kept to be counted again.
LATE = 64


def streaks(outcomes: DataFrame, late: int = LATE) -> DataFrame:
    """source_id, seq, status, streak of a stream of outcomes, as history.error_streaks() has them.

    The state holds a source's last outcomes by seq, late of them, and the streak before the first of these. An
    outcome that comes after later ones of its source is put in its place, and it and the later ones whose
    streak it changes are given out again: of several rows of a seq the last holds. One that is older than all that is
    held, or repeats a held one's seq and status, gives nothing.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seqs, errors, given, base, floor = (list(map(list, state.get[:3])) + list(state.get[3:])) if state.exists else [[], [], [], 0, None]
        held = {q: [e, g] for q, e, g in zip(seqs, errors, given)}
        status_of = {}
        for rows in batches:
            for seq, status in zip(rows["seq"], rows["status"]):
                if floor is None or seq > floor:
                    held[int(seq)] = [status == "error", -1]
                    status_of[int(seq)] = status
        out, streak = [], base
        for q in sorted(held):
            error, was = held[q]
            streak = streak + 1 if error else 0
            if streak != was:
                out.append((key[0], q, status_of.get(q, "error" if error else "ok"), streak))
                held[q][1] = streak
        order = sorted(held)
        for q in order[:-late]:
            base, floor = held.pop(q)[1], q
        order = sorted(held)
        state.update((order, [held[q][0] for q in order], [held[q][1] for q in order], base, floor))
        yield pd.DataFrame(out, columns=["source_id", "seq", "status", "streak"])

    return outcomes.select("source_id", "seq", "status").groupBy("source_id").applyInPandasWithState(
        run, "source_id STRING, seq INT, status STRING, streak INT", "seqs ARRAY<INT>, errors ARRAY<BOOLEAN>, given ARRAY<INT>, base INT, floor INT", "append", GroupStateTimeout.NoTimeout
    )


def changed_pages(stream: DataFrame, sources: DataFrame, feed: ChangeFeed, handle: Callable[[DataFrame], None]):
    """Start a stream that hands each batch's new or changed pages to handle and commits them after.

    A batch that is replayed after a death finds its pages in the ledger if they were committed, and handles
    them again if they were not: handle should be idempotent. Returns the writer, to be given a checkpoint
    folder and started.
    """

    def batch(rows: DataFrame, _: int) -> None:
        due = feed.pending(rows, sources).persist()
        handle(due)
        feed.commit(due)
        due.unpersist()

    return stream.writeStream.foreachBatch(batch)
