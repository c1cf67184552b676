"""Link health, limits and folds: window and per-key ordered operators."""

from __future__ import annotations

import pickle
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..tables import small, written

# What counts as permanent, and the thresholds and check intervals (hours) of a link.
PERMANENT_TYPES = ("http_404", "http_410", "dns_error")
PERMANENT_CODES = (403, 404, 410)
SUSPICIOUS, QUARANTINED, DEAD = 3, 5, 10
CHECK_HOURS = {"healthy": 24, "suspicious": 12, "quarantined": 168, "dead": 720}
DAY, HOUR = 86_400_000_000, 3_600_000_000
#: Rows of a key that one task folds in a row, before the key is cut into slices of whole hours.
SLICE_ROWS = 100_000
#: Rounds after which slices that have not settled are run two in a row.
SLICE_ROUNDS = 4


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def consecutive_failures(probes: DataFrame, key: str = "url", ts: str = "ts", order: str = "event_id") -> DataFrame:
    """Adds ``run``: failures of the key since its last success."""
    w = Window.partitionBy(key).orderBy(ts, order)
    island = F.sum(F.col("success").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = probes.withColumn("_island", island)
    inside = Window.partitionBy(key, "_island").orderBy(ts, order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("run", F.sum((~F.col("success")).cast("int")).over(inside)).drop("_island")


def recent_failures(probes: DataFrame, hours: int = 24, key: str = "url", ts: str = "ts") -> DataFrame:
    """Adds counts over the last hours: ``failures``, ``permanent`` by type, ``permanent_any`` by type or code, ``successes``.

    The span before a row is the hours between, counted once for each key and hour, and two
    parts of an hour.  Those follow from the rows of the hour and the rows of the hour that
    the span begins in, moved forward by its length.  So rows are dealt by key and hour, and
    a key that has most of them is spread.  A null key or time has no span and counts nothing
    but 0; nulls in flags count as false.
    """
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    failed = ~F.col("success")
    by_type = failed & F.col("failure_type").isin(*PERMANENT_TYPES)
    counts = {"failures": flag(failed), "permanent": flag(by_type), "permanent_any": flag(failed & (F.col("failure_type").isin(*PERMANENT_TYPES) | F.col("status_code").isin(*PERMANENT_CODES))), "successes": flag(F.col("success"))}
    rows = probes.withColumn("_us", micros(ts)).withColumns({f"_{c}": v for c, v in counts.items()})
    rows = rows.withColumn("_hour", F.floor(F.col("_us") / HOUR))
    cells = rows.groupBy(F.col(key).alias("_key"), "_hour").agg(*[F.sum(f"_{c}").alias(f"_{c}") for c in counts])
    # For each hour that has rows: the sums of the hours strictly between, and of the one in which the span begins.
    by_hour = Window.partitionBy("_key").orderBy("_hour")
    full = {f"_full_{c}": F.coalesce(F.sum(f"_{c}").over(by_hour.rangeBetween(-hours, -1)), F.lit(0)) for c in counts}
    full = cells.withColumns(full).select("_key", F.col("_hour").alias("_cell"), *full)
    moved = rows.select(F.col(key), (F.col("_us") + hours * HOUR).alias("_us"), (F.col("_hour") + hours).alias("_hour"), *[(-F.col(f"_{c}")).alias(f"_{c}") for c in counts], F.lit(True).alias("_old"))
    both = rows.withColumn("_old", F.lit(False)).unionByName(moved, allowMissingColumns=True)
    inside = Window.partitionBy(key, "_hour").orderBy("_us").rangeBetween(Window.unboundedPreceding, 0)
    both = both.withColumns({f"_in_{c}": F.sum(f"_{c}").over(inside) for c in counts}).filter("NOT _old")
    out = both.join(full, F.col(key).eqNullSafe(F.col("_key")) & F.col("_hour").eqNullSafe(F.col("_cell")), "left")
    return out.select(*probes.columns, *[F.when(F.col("_us").isNull(), 0).otherwise(F.col(f"_in_{c}") + F.coalesce(f"_full_{c}", F.lit(0))).alias(c) for c in counts])


def failure_history(probes: DataFrame, n: int = 10, key: str = "url", ts: str = "ts", order: str = "event_id") -> DataFrame:
    """The last n failures of each key, newest first."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(ts), F.desc(order)))
    last = probes.filter(~F.col("success")).withColumn("_n", nth).filter(F.col("_n") <= n)
    return last.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("_n", "failure_type"))), lambda x: x["failure_type"]).alias("history"))


def link_step(link: tuple[int, int, str], change: int, success: bool | None, hard: bool) -> tuple[int, int, str]:
    """Health in hundredths, run of failures and status after a probe; ``hard`` says whether the last day has a permanent failure."""
    x, run, status = link
    x, run = max(0, min(100, x + change)), 0 if success else run + (success is False)
    if hard and run >= DEAD:
        status = "dead"
    elif run >= QUARANTINED:
        status = "quarantined"
    elif run >= SUSPICIOUS:
        status = "suspicious"
    elif x > 80 and run == 0:
        status = "healthy"
    return x, run, status


def _link_fold(probes: DataFrame, key: str, ts: str, order: str, slice_rows: int) -> DataFrame:
    """Adds the counts of the last day and ``_link`` with health, run of failures and status after each probe."""
    rows = recent_failures(probes, 24, key, ts).withColumn("_v", F.struct((F.when(F.col("successes") > 0, 10).otherwise(0) - 50 * F.col("permanent") - 20 * (F.col("failures") - F.col("permanent"))).alias("d"), "success", (F.col("permanent_any") >= 1).alias("hard")))

    def step(link: tuple[int, int, str], _, v: dict) -> tuple[dict, tuple[int, int, str]]:
        x, run, status = link_step(link, v["d"], v["success"], v["hard"])
        return {"health": x / 100, "run": run, "status": status}, (x, run, status)

    return fold_in_order(rows, key, ts, order, lambda: (100, 0, "healthy"), step, "_link", "struct<health: double, run: int, status: string>", "_v", slice_rows).drop("_v")


def health_score(probes: DataFrame, key: str = "url", ts: str = "ts", order: str = "event_id", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds ``health`` after each probe: from 1, plus .1 if a success lies in the last day, minus .5 or .2 for each permanent or other failure of the last day, held in [0, 1].

    The clamp makes this a fold in time order over the key's probes, in whole hundredths.
    """
    return _link_fold(probes, key, ts, order, slice_rows).withColumn("health", F.col("_link.health")).drop("_link")


def link_status(probes: DataFrame, key: str = "url", ts: str = "ts", order: str = "event_id", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds ``health``, ``run`` and ``status`` after each probe, carried on where no rule applies (healthy at first), and ``next_check_hours``."""
    rows = _link_fold(probes, key, ts, order, slice_rows).select("*", "_link.*").drop("_link")
    hours = F.element_at(F.create_map(*[F.lit(x) for p in CHECK_HOURS.items() for x in p]), F.col("status"))
    return rows.withColumn("next_check_hours", hours)


def usable_links(status: DataFrame, now: Column, override: str = "override", ts: str = "ts") -> DataFrame:
    """Adds ``usable`` to the last status of each link: a manual override decides; dead or disabled links are not used, quarantined ones once their next check is due.

    ``override`` is a nullable boolean column, ``ts`` the time of the last probe, from which
    ``next_check_hours`` counts.  With an override the status says so.
    """
    manual, s = F.col(override), F.col("status")
    due = F.unix_micros(now) >= micros(ts) + F.col("next_check_hours") * 3_600_000_000
    named = F.when(manual, "manually_enabled").when(~manual, "manually_disabled").otherwise(s)
    usable = F.coalesce(manual, F.when(s.isin("dead", "manually_disabled"), False).when(s == "quarantined", F.coalesce(due, F.lit(False))).otherwise(True))
    return status.withColumns({"usable": usable, "status": named})


def fold_in_order(df: DataFrame, key: str, ts: str, order: str, start: Callable[[], object], step: Callable, out: str, kind: str, value: str | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds ``out`` (of type ``kind``): what ``step(state, time, value)`` gives for each row of a key in time order, beside the next state.

    Rows stream sorted through Arrow batches; a task holds one batch and one state.  A key of
    more than ``slice_rows`` rows is cut into slices of whole hours that are folded side by
    side.  The first time every slice begins with the start state; then each slice whose
    predecessor ended in another state than it began with is run again, until none is left,
    which is the fold over all rows.  States that forget where they began (full buckets,
    clamped scores, rows that pass in any case) settle in two or three rounds; slices that
    have not settled in ``SLICE_ROUNDS`` rounds are run two in a row, then four, so the
    number of rounds grows with the logarithm of the number of slices, whatever the data.
    Only slices that changed are run again.  An hour with more rows of a key is one slice.
    """
    rows = df.withColumns({"_us": micros(ts), "_kh": F.xxhash64(key)})
    hot = rows.groupBy("_kh").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > slice_rows).select("_kh")
    field = T.StructField(out, T.StructType.fromDDL(f"x {kind}")[0].dataType)
    run = lambda slices, emit: _folded(slices, key, order, start, step, field, value, emit)
    hot = written(hot)
    if not hot.limit(1).count():
        return run(rows.withColumns({"_slice": F.lit(0).cast("long"), "_enter": F.lit(None).cast("binary")}), True).drop("_us", "_kh", "_slice", "_enter")
    rows = rows.withColumn("_cell", F.floor(F.col("_us") / HOUR))
    cells = rows.join(small(hot), "_kh", "left_semi").groupBy("_kh", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_kh").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_slice", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / slice_rows))
    # Slices are numbered without gaps, so that the one before is the number before.
    cells = written(cells.withColumn("_slice", F.dense_rank().over(Window.partitionBy("_kh").orderBy("_slice")).cast("long")).drop("_n"))
    staged = rows.join(small(cells), ["_kh", "_cell"], "left").drop("_cell").withColumns({"_slice": F.coalesce("_slice", F.lit(0)), "_enter": F.lit(None).cast("binary")})
    staged = written(staged)
    states, again, level = None, None, 0
    while True:
        many = staged.filter("_slice > 0").withColumn("_slice", F.shiftright("_slice", level))
        for _ in range(SLICE_ROUNDS):
            part = many if again is None else many.join(again.select("_kh", "_slice").distinct(), ["_kh", "_slice"], "left_semi")
            ended = written(run(_with_states(part, again if again is not None else states, key), False))
            if again is not None:
                done = ended.select(F.col(key).alias("_key"), F.col("_slice").alias("_s"))
                ended = written(ended.unionByName(states.join(done, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_s")), "left_anti")))
            states = ended
            follows = states.select(F.col(key).alias("_key"), (F.col("_slice") + 1).alias("_s"), F.col("_exit").alias("_should"))
            changed = states.join(follows, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_s"))).filter(~F.col("_enter").eqNullSafe(F.col("_should")))
            again = written(changed.select(key, "_kh", "_slice", F.col("_should").alias("_enter")))
            if not again.limit(1).count():
                break
        else:
            level += 1
            last = F.max_by("_exit", "_slice").alias("_enter")
            states = written(states.groupBy(key, "_kh", (F.shiftright("_slice", 1) + 1).alias("_slice")).agg(last))
            again = None
            continue
        break
    final = staged.withColumn("_slice", F.shiftright("_slice", level))
    return run(_with_states(final, states.filter("_enter IS NOT NULL"), key), True).drop("_us", "_kh", "_slice", "_enter")


def _with_states(rows: DataFrame, states: DataFrame | None, key: str) -> DataFrame:
    """The rows, and before each slice that has one a row with the state to begin with."""
    return rows if states is None else rows.unionByName(states.select(key, "_kh", "_slice", "_enter"), allowMissingColumns=True)


def _folded(rows: DataFrame, key: str, order: str, start: Callable[[], object], step: Callable, field: T.StructField, value: str | None, emit: bool) -> DataFrame:
    """The rows with ``field``, or (``emit`` false) ``key, _kh, _slice, _enter, _exit`` of each slice."""
    rows = rows.repartition(key, "_slice").sortWithinPartitions(key, "_slice", F.col("_enter").isNull(), "_us", order)
    ends = T.StructType([*[rows.schema[c] for c in (key, "_kh", "_slice", "_enter")], T.StructField("_exit", T.BinaryType())])
    kind = to_arrow_type(field.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, entered, done = None, None, None, []

        def flush(types: pa.Schema) -> pa.RecordBatch:
            columns = [pa.array([x[i] for x in done], t) for i, t in enumerate([*[types.field(c).type for c in (key, "_kh", "_slice")], pa.binary(), pa.binary()])]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=[f.name for f in ends])

        schema = None
        for batch in batches:
            schema, found, real = batch.schema, [], []
            keys = zip(batch.column(key).to_pylist(), batch.column("_kh").to_pylist(), batch.column("_slice").to_pylist(), strict=True)
            times, enters = batch.column("_us").to_pylist(), batch.column("_enter").to_pylist()
            values = batch.column(value).to_pylist() if value else [None] * len(times)
            for i, (k, t, v, e) in enumerate(zip(keys, times, values, enters, strict=True)):
                if k != at:
                    if at is not None and not emit:
                        done.append((*at, entered, pickle.dumps(state, 4)))
                    at, state, entered = k, start(), None
                if e is not None:
                    state, entered = pickle.loads(e), e
                    continue
                said, state = step(state, t, v)
                found.append(said)
                real.append(i)
            if emit:
                kept = batch if len(real) == batch.num_rows else batch.take(pa.array(real, pa.int64()))
                yield kept.append_column(field.name, pa.array(found, kind))
            elif len(done) > 10_000:
                yield flush(schema)
        if not emit and at is not None:
            done.append((*at, entered, pickle.dumps(state, 4)))
            yield flush(schema)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, field]) if emit else ends)


def dedupe_ttl(df: DataFrame, key: str, ts: str, order: str, ttl_seconds: int = 86_400, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Rows that pass a set-if-absent key with expiry: no passing row of the key is younger than the ttl.

    The age counts from the last row that passed, so this is a fold and not a gap between rows.
    """

    def step(last: int | None, t: int, _) -> tuple[bool, int]:
        ok = last is None or t - last >= ttl_seconds * 1_000_000
        return ok, t if ok else last

    return fold_in_order(df, key, ts, order, lambda: None, step, "_ok", "boolean", slice_rows=slice_rows).filter("_ok").drop("_ok")


def rate_limit_sliding(df: DataFrame, key: str, ts: str, order: str, limit: int, window_seconds: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds ``allowed``: fewer than ``limit`` allowed requests of the key in the last seconds; denied ones do not count."""

    def step(times: deque, t: int, _) -> tuple[bool, deque]:
        while times and times[0] <= t - window_seconds * 1_000_000:
            times.popleft()
        ok = len(times) < limit
        if ok:
            times.append(t)
        return ok, times

    return fold_in_order(df, key, ts, order, deque, step, "allowed", "boolean", slice_rows=slice_rows)


def rate_limit_fixed(df: DataFrame, key: str, ts: str, order: str, budget: int, unit: str = "minute") -> DataFrame:
    """Adds ``allowed``: among the first ``budget`` requests of the key in its clock unit."""
    slot = F.date_trunc(unit, F.col(ts).cast("timestamp"))
    nth = F.row_number().over(Window.partitionBy(key, slot).orderBy(ts, order))
    return df.withColumn("allowed", nth <= budget)


def token_bucket(df: DataFrame, key: str, ts: str, order: str, capacity: int, per_seconds: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds ``allowed``: a bucket of ``capacity`` tokens refilled evenly over ``per_seconds``; in whole micro-tokens, so exact."""
    one = per_seconds * 1_000_000  # units of a token; ``capacity`` units come back each microsecond
    full = capacity * one

    def step(state: tuple[int, int | None], t: int, _) -> tuple[bool, tuple[int, int]]:
        level, last = state
        level = min(full, level + (t - last) * capacity) if last is not None else full
        ok = level >= one
        return ok, (level - one if ok else level, t)

    return fold_in_order(df, key, ts, order, lambda: (full, None), step, "allowed", "boolean", slice_rows=slice_rows)


def best_so_far(df: DataFrame, group: str, order: str, score: str, name: str) -> DataFrame:
    """Adds the best score and its name up to each row, and the gain in percent over the group's first score."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    best = F.max(F.struct(F.col(score), (-F.col(order)).alias("o"), F.col(name))).over(w)
    first = F.first(score).over(w)
    return df.withColumn("_b", best).withColumns({"best": F.col(f"_b.{score}"), "best_name": F.col(f"_b.{name}"), "gain_pct": F.when(first != 0, (F.col(f"_b.{score}") - first) / first * 100)}).drop("_b")


def plateau(df: DataFrame, group: str, order: str, score: str, window: int = 3, eps: float = 0.01) -> DataFrame:
    """Adds ``flat``: the last ``window`` scores lie within ``eps``."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(-(window - 1), 0)
    return df.withColumn("flat", (F.count(score).over(w) == window) & (F.max(score).over(w) - F.min(score).over(w) < eps))


def running_mean(df: DataFrame, group: str, order: str, value: str) -> DataFrame:
    return df.withColumn("running_mean", F.avg(value).over(Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def radar_normalize(df: DataFrame, value: Column, low: float, high: float) -> DataFrame:
    """Adds ``scaled``: the value's place between two bounds, held in [0, 1]."""
    return df.withColumn("scaled", F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value - low) / (high - low))))
