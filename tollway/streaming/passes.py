"""Streaming forms of the batch operators, an extension: dedup of passes, and trips as they close.

State per vehicle is the pass before, how many passes there were, and the points of the open trip; a trip is emitted
when the sequential rule closes it. A vehicle that is silent for longer than the cap can't continue its trip: the trip
is emitted then, as the vehicle's next pass would close it. Batch, which knows that no pass follows, loses that trip."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tollway.config import Segmentation

TRIP = "CLTMBH string, checkpoints array<string>, start timestamp, stop timestamp, travel double"
STATE = "before_id string, before_at double, ids array<string>, times array<double>, z long"


def dedup(passes: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The first of each (GCRQ, GCSJ, CLTMBH) that arrives within the delay; keys are forgotten behind the watermark."""
    return passes.withWatermark("GCSJ", delay).dropDuplicatesWithinWatermark(["GCRQ", "GCSJ", "CLTMBH"])


def step(state: tuple, kkbh: str, at: float, least: float, most: float, b: float, s: Segmentation):
    """(state, closed trip or None) after one pass. state: id and time of the pass before, ids and times kept, passes seen."""
    before_id, before_at, ids, times, z = state
    if z == 0:
        return (kkbh, at, ids, times, 1), None
    ti = at - (times[-1] if times else before_at)
    closed = None
    if kkbh != before_id and ti != 0 and least <= ti <= most:
        if z == 1:
            ids, times = [before_id], [before_at]
        ids, times = [*ids, kkbh], [*times, at]
    elif ti > (most if kkbh != before_id else b):
        if len(ids) > 1 and times[-1] - times[0] > s.min_trip_seconds:
            closed = (ids, times)
        ids, times = [kkbh], [at]
    return (kkbh, at, ids, times, z + 1), closed


def trips(passes: DataFrame, bounds: dict[tuple[str, str], tuple[float, float]], b: float, s: Segmentation, delay: str = "1 hour") -> DataFrame:
    """Closed trips of a stream of passes (CLTMBH, KKBH, GCSJ as timestamp), in the order of each vehicle's times.

    bounds: least and most seconds by pair of checkpoints (a table of checkpoints, not of passes); other pairs take 1
    and the cap. A batch's passes are put in order; later ones that are older than what was seen are dropped."""
    cap = float(round(s.cap_scale * b))

    def follow(key: tuple, batches: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        state = group.get if group.exists else (None, None, [], [], 0)
        out = []
        if group.hasTimedOut:
            ids, times = list(state[2]), list(state[3])
            if len(ids) > 1 and times[-1] - times[0] > s.min_trip_seconds:
                out.append((ids, times))
            group.remove()
        else:
            rows = pd.concat(list(batches)).sort_values("GCSJ", kind="stable")
            for kkbh, stamp in zip(rows["KKBH"], rows["GCSJ"], strict=True):
                at = stamp.timestamp()
                if state[1] is not None and at < state[1]:
                    continue
                least, most = bounds.get((state[0], kkbh), (1.0, cap))
                state, closed = step((state[0], state[1], list(state[2]), list(state[3]), state[4]), kkbh, at, least, min(most, cap), b, s)
                if closed:
                    out.append(closed)
            group.update(state)
            group.setTimeoutTimestamp(max(int((state[1] + cap) * 1000), group.getCurrentWatermarkMs() + 1))
        if out:
            stamp = lambda x: pd.to_datetime([t[1][x] for t in out], unit="s")
            yield pd.DataFrame({"CLTMBH": key[0], "checkpoints": [t[0] for t in out], "start": stamp(0), "stop": stamp(-1), "travel": [t[1][-1] - t[1][0] for t in out]})

    x = passes.select("CLTMBH", "KKBH", F.col("GCSJ").cast("timestamp").alias("GCSJ")).withWatermark("GCSJ", delay)
    return x.groupBy("CLTMBH").applyInPandasWithState(follow, TRIP, STATE, "append", GroupStateTimeout.EventTimeTimeout)
