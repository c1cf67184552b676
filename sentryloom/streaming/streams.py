"""Structured Streaming forms of the operators: the same transformations on unbounded tables.

Expiry and lateness follow the event-time watermark.  Sinks that write more than once per
batch do it in ``foreachBatch`` and are idempotent by batch id.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.relations import validate_messages
from .graph_store import merge_into, read_graph

DLQ_TTL = 604_800


def micro_batch(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, seconds: int = 30, once: bool = False) -> StreamingQuery:
    """Batches by time (rows a batch are limited at the source, e.g. ``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``)."""
    trigger = {"availableNow": True} if once else {"processingTime": f"{seconds} seconds"}
    return df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def dead_letter(df: DataFrame, topic: Column, payload: Column, error: Column, kind: str, stage: str, now: Column) -> DataFrame:
    """The envelope of messages that failed: id, where from, what, why, when, and how long it is kept."""
    return df.select(F.md5(F.concat(topic, payload)).alias("dlq_id"), F.concat(topic, F.lit(".dlq")).alias("topic"), topic.alias("original_topic"), payload.alias("original_payload"), F.struct(error.alias("message"), F.lit(kind).alias("error_type")).alias("error"), F.struct(F.lit(stage).alias("stage")).alias("metadata"), now.alias("timestamp"), F.lit(DLQ_TTL).alias("ttl_seconds"))


def validate_stream(df: DataFrame, rules: Sequence[tuple[str, str, Column]], topic: str, good: str, bad: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Valid rows to one table and envelopes of the others to a dead-letter table, from one pass over each batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        checked = validate_messages(batch, rules).persist()
        try:
            split(checked, batch, batch_id)
        finally:
            checked.unpersist()

    def split(checked: DataFrame, batch: DataFrame, batch_id: int) -> None:
        checked.filter(F.size("errors") == 0).drop("errors").withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(good)
        wrong = checked.filter(F.size("errors") > 0)
        out = dead_letter(wrong, F.lit(topic), F.to_json(F.struct(*batch.columns)), F.to_json("errors"), "schema_validation", "consumer", F.current_timestamp())
        out.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(bad)

    return micro_batch(df, sink, checkpoint, once=once)


def stream_first(df: DataFrame, keys: Sequence[str], ts: str, late: str = "1 day") -> DataFrame:
    """The first row of each key within the watermark; its state is dropped as the watermark passes."""
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def stream_dedupe(df: DataFrame, keys: Sequence[str], ts: str, order: str, ttl_seconds: int = 86_400, late: str = "1 hour") -> DataFrame:
    """Rows that pass a set-if-absent key with expiry, as ``dedupe_ttl`` gives them, however the rows are cut into batches.

    A row waits until the watermark (``late`` behind the newest time) is past it, so rows of a
    key are taken in order of time, then ``order`` (a whole number; null before 0), also where
    one batch holds rows further apart than the ttl.  The state of a key is the time of its
    last passing row and the rows that wait; timers release these and drop the state once
    the ttl is over.  Rows older than the watermark come too late and are left out.  Columns travel
    as JSON text, so whole numbers of any size stay as they are; null keys are a key.
    """
    micro = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}
    ttl = ttl_seconds * 1_000_000
    names = [f"_k{i}" for i in range(len(keys))]

    def step(key: tuple, frames, state):
        last, waiting = state.get if state.exists else (None, [])
        waiting = [tuple(x) for x in waiting]
        for f in frames:
            waiting += [(int(us), int(i), row) for us, i, row in f[["_us", "_i", "_row"]].itertuples(index=False)]
        mark = state.getCurrentWatermarkMs() * 1000
        waiting.sort(key=lambda x: x[:2])
        passed = []
        ready = sum(us <= mark for us, _, _ in waiting)
        for us, _, row in waiting[:ready]:
            if last is None or us - last >= ttl:
                last = us
                passed.append(row)
        waiting = waiting[ready:]
        if not waiting and (last is None or mark >= last + ttl):
            state.remove()
        else:
            state.update((last, waiting))
            next_time = waiting[0][0] if waiting else last + ttl
            state.setTimeoutTimestamp(max(next_time, mark) // 1000 + 1)
        if passed:
            yield pd.DataFrame({"_row": passed})

    rows = df.withWatermark(ts, late).select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], ts, F.unix_micros(ts).alias("_us"), F.coalesce(F.col(order).cast("long"), F.lit(-1)).alias("_i"), F.to_json(F.struct(*df.columns), micro).alias("_row"))
    kept = rows.filter(F.col("_us").isNotNull()).groupBy(*names).applyInPandasWithState(step, "_row string", "last long, waiting array<struct<us:long,i:long,row:string>>", "append", "EventTimeTimeout")
    return kept.select(F.from_json("_row", df.schema, micro).alias("_row")).select("_row.*")


def stream_counters(df: DataFrame, ts: str, labels: Sequence[str], window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts by tumbling window and labels."""
    return df.withWatermark(ts, late).groupBy(F.window(ts, window), *labels).agg(F.count(F.lit(1)).alias("n"))


def link_health_stream(probes: DataFrame, late: str = "1 day", most_waiting: int = 10_000, keep_days: int = 90) -> DataFrame:
    """``url, run, health, status, due`` of each link after each batch, and again when its next check is due.

    ``probes`` has ``url, ts`` (a timestamp), ``event_id, success, failure_type, status_code``;
    all but the first two may be null (a name that does not resolve has no status code).
    Batches may come in any time order within ``late``: probes younger than the watermark are
    kept and taken again in time order with what comes later; older ones are settled into
    the state, with the failures and the last success of the last day.  At most ``most_waiting``
    probes of a link wait; of more, the oldest are settled before the watermark is past
    them.  A probe that is older than what is settled comes too late and is passed over.

    Timers: when no probe has come by the next check of its status the link is given again
    with ``due``, by which a quarantined link may be tried again; a link without probes for
    ``keep_days`` is forgotten.
    """
    from ..operators.windows import CHECK_HOURS, DAY, HOUR, PERMANENT_CODES, PERMANENT_TYPES, link_step

    def advance(link: tuple, rows: list[tuple]) -> tuple:
        """The link after the rows, given in order; as in the batch form, rows of one time all count in the last day of each."""
        score, run, status, success, failed, last = link
        failed, at = list(failed), 0
        while at < len(rows):
            us, stop = rows[at][0], at
            while stop < len(rows) and rows[stop][0] == us:
                _, _, ok, kind, code = rows[stop]
                success = us if ok == 1 else success
                failed += [(us, kind, code)] if ok == 0 else []
                stop += 1
            failed = [x for x in failed if x[0] > us - DAY]
            hard = sum(k in PERMANENT_TYPES for _, k, _ in failed)
            any_hard = any(k in PERMANENT_TYPES or c in PERMANENT_CODES for _, k, c in failed)
            change = (10 if success > us - DAY else 0) - 50 * hard - 20 * (len(failed) - hard)
            for _, _, ok, _, _ in rows[at:stop]:
                score, run, status = link_step((score, run, status), change, {1: True, 0: False}.get(ok), any_hard)
            at, last = stop, max(last, us)
        return score, run, status, success, failed, last

    def step(key: tuple, frames, state):
        *link, waiting, settled = state.get if state.exists else (100, 0, "healthy", -DAY, [], 0, [], -DAY)
        link[4] = [tuple(x) for x in link[4]]
        mark = state.getCurrentWatermarkMs() * 1000
        fresh = [(int(us), int(i), int(ok), kind, int(code)) for f in frames for us, i, ok, kind, code in f[["us", "event_id", "success", "failure_type", "status_code"]].itertuples(index=False) if us > settled]
        rows = sorted([tuple(x) for x in waiting] + fresh, key=lambda x: x[:2])
        settled = max(settled, mark)
        if len(rows) > most_waiting:
            settled = max(settled, rows[-most_waiting - 1][0])
        link = advance(tuple(link), [x for x in rows if x[0] <= settled])
        waiting = [x for x in rows if x[0] > settled]
        score, run, status, _, _, last = advance(link, waiting)
        due_at, end = last + CHECK_HOURS[status] * HOUR, last + keep_days * DAY
        if state.hasTimedOut and mark >= end:
            state.remove()
            return
        state.update((*link, waiting, settled))
        state.setTimeoutTimestamp(max(due_at if mark < due_at else end, mark) // 1000 + 1)
        if fresh or mark >= due_at:
            yield pd.DataFrame({"url": [key[0]], "run": [run], "health": [score / 100], "status": [status], "due": [mark >= due_at]})

    whole = lambda c, kind, other: F.coalesce(F.col(c).cast(kind), F.lit(other))
    rows = probes.withWatermark("ts", late).select("url", "ts", F.unix_micros("ts").alias("us"), whole("event_id", "long", -1).alias("event_id"), whole("success", "int", -1).alias("success"), "failure_type", whole("status_code", "int", 0).alias("status_code"))
    shape = "score int, run int, status string, success long, failed array<struct<us:long,kind:string,code:int>>, last long, waiting array<struct<us:long,id:long,ok:int,kind:string,code:int>>, settled long"
    return rows.filter("us IS NOT NULL").groupBy("url").applyInPandasWithState(step, "url string, run int, health double, status string, due boolean", shape, "update", "EventTimeTimeout")


def upsert_graph(nodes: DataFrame, target: str, checkpoint: str, key: Sequence[str] = ("id",), version: str = "version", once: bool = True) -> StreamingQuery:
    """Node versions of each batch added to a table of versions, one folder a batch; ``latest`` reads the merged state."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        newest = batch.groupBy(*key).agg(F.max_by(F.struct(*[c for c in batch.columns if c not in key]), version).alias("_v")).select(*key, "_v.*")
        newest.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(target)

    return micro_batch(nodes, sink, checkpoint, once=once)


def latest(versions: DataFrame, key: Sequence[str] = ("id",), version: str = "version") -> DataFrame:
    """The newest version of each key."""
    rest = [c for c in versions.columns if c not in key and c != "batch_id"]
    return versions.groupBy(*key).agg(F.max_by(F.struct(*rest), version).alias("_v")).select(*key, "_v.*")


def ingest_stream(raw: DataFrame, target: str, checkpoint: str, now: Column, late: str = "1 day", once: bool = True, **enrichment) -> StreamingQuery:
    """``ingest`` on each batch of ``url, fetched_at`` (a timestamp) ``, payload``, merged into the graph under ``target``/graph.

    A payload seen within ``late`` of event time is passed over, as is one that comes later than
    that.  Relations may end in nodes of earlier batches.  Dead letters and the account of each
    batch are added under ``target``, one folder a batch.  A batch that runs again replaces
    those folders and finds itself in the graph.  ``read_graph`` of ``graph_store`` reads it.
    """
    from ..operators.ingest import ingest

    fresh = stream_first(raw.withColumn("_h", F.sha2(F.coalesce("payload", F.lit("")), 256)), ["_h"], "fetched_at", late).drop("_h")

    def sink(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            out = ingest(kept, now, known=read_graph(batch.sparkSession, f"{target}/graph")[0], **enrichment)
            for name, part in (("dead", out.dead), ("account", out.account)):
                part.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{target}/{name}")
            merge_into(f"{target}/graph", out.nodes, out.edges, batch_id, source=checkpoint)
        finally:
            kept.unpersist()

    return micro_batch(fresh, sink, checkpoint, once=once)


def merge_stream(changes: DataFrame, folder: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """A stream of changesets (``nodes`` and ``edges``, arrays of structs) merged into the graph under ``folder`` batch by batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        merge_into(folder, batch.select(F.inline("nodes")), batch.select(F.inline("edges")), batch_id, source=checkpoint)

    return micro_batch(changes, sink, checkpoint, once=once)
