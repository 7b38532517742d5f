"""Attribution on streams: actions meet searches of the same user within a window."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def attribute_stream(events: DataFrame, queries: DataFrame, within: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Stream-stream join of events (talent_key, job_id, event_time) with searches (talent_key, query_id, query_time,
    exposed_jobs) that showed the job at most `within` before. Watermarks bound the state: a search is dropped once
    no event in its window can come any more. Each matching search gives a row; `last_touch_stream` gives the last alone."""
    e = events.withWatermark("event_time", late).alias("e")
    q = queries.withWatermark("query_time", late).alias("q")
    same = F.expr(f"e.talent_key = q.talent_key AND e.event_time BETWEEN q.query_time AND q.query_time + INTERVAL {within}")
    return e.join(q, same).where(F.array_contains(F.split("q.exposed_jobs", ","), F.col("e.job_id"))).select("e.talent_key", "e.job_id", "e.event_time", "q.query_id", "q.query_time")


def activity(events: DataFrame, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts by window and event type, with a watermark for late rows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"))


LOG = "kind string, talent_key string, at timestamp, query_id string, exposed_jobs string, job_id string"


MATCHED = "talent_key string, job_id string, event_time timestamp, query_id string, query_time timestamp"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _LastTouch(StatefulProcessor):
    """A user's open searches, a map by time and id, and actions that wait, a list. Timers in event time let actions go once the
    watermark has passed them, and take searches away that nothing can refer to any more."""

    def __init__(self, within_ms: int):
        self.within = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.searches = handle.getMapState("searches", "at long, id string", "query_id string, shown string")
        self.waiting = handle.getListState("waiting", "at long, job string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        due = []
        for pdf in rows:
            times = pdf["at"].astype("datetime64[ms]").astype("int64").tolist()
            actions = []
            for kind, at, query, shown, job in zip(pdf["kind"], times, pdf["query_id"], pdf["exposed_jobs"], pdf["job_id"]):
                if kind == "query":
                    self.searches.updateValue((at, query or ""), (query, shown))
                    due.append(at + self.within + 1)
                else:
                    actions.append((at, job))
            if actions:
                self.waiting.appendList(actions)
                due.append(min(actions)[0])
        for at in {f(due) for f in (min, max) if due}:  # when the first of these rows can go, and when all can
            self.handle.registerTimer(max(at, timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        searches = sorted((at, id_, query, shown) for (at, id_), (query, shown) in self.searches.iterator())
        waiting = list(self.waiting.get()) if self.waiting.exists() else []
        out = []
        for at, job in sorted((w for w in waiting if w[0] <= mark), key=lambda w: (w[0], w[1] or "")):
            i = bisect_right(searches, at, key=lambda q: q[0])
            last = searches[i - 1] if i else None
            if last and at - last[0] <= self.within and job in (last[3] or "").split(","):
                out.append((key[0], job, pd.Timestamp(at, unit="ms"), last[2], pd.Timestamp(last[0], unit="ms")))
        left = [w for w in waiting if w[0] > mark]
        self.waiting.put(left) if left else self.waiting.clear()
        closed = bisect_right(searches, mark, key=lambda q: q[0])
        for n, (at, id_, _, _) in enumerate(searches[:closed]):
            if n < closed - 1 or at + self.within < mark:  # not the last of the closed ones, or out of its window
                self.searches.removeKey((at, id_))
        kept = [at + self.within + 1 for at, *_ in searches if at + self.within >= mark]
        for at in {*([min(left)[0]] if left else []), *kept[:1]}:
            self.handle.registerTimer(max(at, mark + 1))
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in MATCHED.split(", ")])

    def close(self) -> None:
        pass


def last_touch_stream(log: DataFrame, within: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Last-touch attribution on one stream of searches (kind query) and actions (kind event) with the columns of LOG:
    talent_key, job_id, event_time, query_id, query_time.

    An action waits in its user's state until the watermark has passed it, so searches that come late but in time count; then
    the latest search at or before it is taken (ties: the largest id), and only that one is checked for window and exposure,
    as in the batch operator. A search is kept while its window is open, so a user's state holds what came in the last `within` and
    `late` and is gone after that, however long the stream runs. Rows later than `late` behind the newest are
    dropped by the watermark; rows without a user never match. State is kept per row in RocksDB, which this sets for the session."""
    log.sparkSession.conf.set(PROVIDER, ROCKS)
    rows = log.where("talent_key is not null").withWatermark("at", late).select(*(c.split()[0] for c in LOG.split(", ")))
    processor = _LastTouch(int(pd.Timedelta(within).total_seconds() * 1000))
    return rows.groupBy("talent_key").transformWithStateInPandas(processor, MATCHED, "Append", "EventTime")
