"""The live basket as a stream."""

from __future__ import annotations

from datetime import datetime
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfline.session import ensure_checkpoint_dir

LATE = "4 hours"


def stream_itb_summary(basket: DataFrame, now: datetime | None = None, late: str = LATE, exact_sessions: bool = False) -> DataFrame:
    """Product totals per day of ``added_at`` from a stream of basket rows.

    Works on a batch frame too. State is one row per product and open day:
    the watermark closes days and drops rows that come later than ``late``.
    Sessions are counted by sketch, as an exact distinct count has to keep every
    session of an open product-day in state; ``exact_sessions`` does that.

    A day is the calendar day of the session's time zone, as in the batch views: the
    clock reading is taken as if it were UTC, where Spark cuts its windows.
    """
    live = F.col("status") == "ACTIVE"
    if now is not None:
        live = live & (F.col("expires_at").isNull() | (F.col("expires_at") > F.lit(now)))
    zone = F.current_timezone()
    sessions = F.size(F.collect_set("session_id")).cast("long") if exact_sessions else F.approx_count_distinct("session_id", 0.02)
    return (
        basket.filter(live)
        .withColumn("added_at", F.col("added_at").cast("timestamp"))
        .withColumn("_clock", F.from_utc_timestamp("added_at", zone))
        .withWatermark("_clock", late)
        .groupBy(F.window("_clock", "1 day").alias("_w"), "productId")
        .agg(
            sessions.alias("active_sessions"),
            F.sum("quantity").alias("total_quantity"),
            F.count(F.lit(1)).alias("basket_rows"),
            F.min("added_at").alias("earliest_add"),
            F.max("added_at").alias("latest_add"),
        )
        .select(F.date_from_unix_date(F.floor(F.unix_seconds("_w.start") / 86400).cast("int")).alias("basket_day"), "productId", "active_sessions", "total_quantity", "basket_rows", "earliest_add", "latest_add")
    )


def run_available(summary: DataFrame, sink: str, checkpoint: str | None = None) -> StreamingQuery:
    """Process what is available, keeping the latest totals per product and day in parquet batches.

    Update mode emits a product-day again whenever it changes; ``batch_id``
    tells a reader which version is newest. Each sink has a checkpoint of its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    where = checkpoint or f"{ensure_checkpoint_dir(summary.sparkSession)}/itb-summary-{sha256(sink.rstrip('/').encode()).hexdigest()[:16]}"
    return (
        summary.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", where)
        .trigger(availableNow=True)
        .start()
    )


def latest_totals(changes: DataFrame) -> DataFrame:
    """Newest version of each product-day among the written changes."""
    rest = [c for c in changes.columns if c not in ("basket_day", "productId", "batch_id", "batch")]
    return (
        changes.groupBy("basket_day", "productId")
        .agg(F.max_by(F.struct(*rest), "batch_id").alias("s"))
        .select("basket_day", "productId", *[F.col(f"s.{c}").alias(c) for c in rest])
    )


_HELD = "products array<string>, sessions array<string>, ids array<string>, expiry array<long>, quantity array<long>, added array<long>, closes long"
_HOLDING = "basket_day date, productId string, session_id string, total_quantity long, basket_rows long, earliest_add timestamp, latest_add timestamp"
_NEVER = np.iinfo("int64").min  # no time


def _clock(micros: list[int]) -> pd.Series:
    return pd.Series(np.array(micros, dtype="int64").view("datetime64[us]")).dt.tz_localize("UTC")


def _hold(key: tuple, batches, state: GroupState):
    """The sessions of a day and bucket: new rows come in, expired ones go when a timer fires, and what changed of a session and product is told."""
    now = max(state.getCurrentWatermarkMs(), 0) * 1000
    held, closes = {}, None
    if state.exists:
        *columns, closes = state.get
        for product, session, *row in zip(*columns, strict=True):
            held.setdefault((product, session), {})[row[0]] = tuple(row)
    before = {group: set(rows) for group, rows in held.items()}
    for batch in [] if state.hasTimedOut else batches:
        for row in batch.itertuples(index=False):
            closes = row.closes
            rows = held.setdefault((row.productId, row.session_id), {})
            if row.id not in rows:
                rows[row.id] = (row.id, None if pd.isna(row.expiry) else int(row.expiry), int(row.quantity), int(row.added))
    kept, timers, changes = [], [], []
    for group, rows in held.items():
        left = sorted((r for r in rows.values() if r[1] is None or r[1] >= now), key=lambda r: (r[3], r[0]))
        ends = [r[1] for r in left if r[1] is not None]
        if not ends and left and closes >= now:
            ends = [closes]  # rows that never expire are forgotten, not emptied, once the day is closed
        if ends:
            timers.append(min(ends))
            kept += [(*group, *r) for r in left]
        if {r[0] for r in left} != before.get(group, set()):
            changes.append((*group, sum(r[2] for r in left), len(left), left[0][3] if left else _NEVER, left[-1][3] if left else _NEVER))
    if timers:
        state.update((*(list(c) for c in zip(*kept, strict=True)), int(closes)))
        state.setTimeoutTimestamp(min(timers) // 1000)
    elif state.exists:
        state.remove()
    if changes:
        products, sessions, quantity, count, earliest, latest = (list(c) for c in zip(*changes, strict=True))
        yield pd.DataFrame({
            "basket_day": [key[0]] * len(changes), "productId": products, "session_id": sessions, "total_quantity": quantity, "basket_rows": count,
            "earliest_add": _clock(earliest), "latest_add": _clock(latest),
        })


def stream_live_basket(basket: DataFrame, late: str = LATE, buckets: int = 64) -> DataFrame:
    """What each session holds of a product, by day of ``added_at``, as it changes: rows come in when added and go when they expire.

    The stream's clock is its watermark, ``late`` behind the newest ``added_at``. A row leaves
    when the clock passes its ``expires_at``: an event-time timer emits the session's new, lower total, zero for
    none, though no row of it arrives. Rows older than the clock, those expired on arrival and repeats of a
    ``basket_id`` are left out; a null quantity counts as 0. Rows without ``added_at`` or ``basket_id`` are left out.

    State is keyed by day and bucket, ``buckets`` a day by the hash of product and session, so a product that a third of
    all rows hold is spread over its sessions, and Python is called for a bucket, not for each session's product. It holds the
    unexpired rows of its sessions; a session's are dropped when the last one expires or, for rows that never do, when
    the day is closed. A stream that goes on keeps its ``buckets``. Write it with ``run_available``; ``live_totals`` reads it.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    rows = basket.filter((F.col("status") == "ACTIVE") & F.col("basket_id").isNotNull() & F.col("added_at").isNotNull())
    return (
        rows.withColumn("added_at", F.col("added_at").cast("timestamp"))
        .withWatermark("added_at", late)
        .select(
            F.to_date("added_at").alias("basket_day"), F.pmod(F.xxhash64("productId", "session_id"), F.lit(buckets)).alias("bucket"), "productId", "session_id", "added_at", F.col("basket_id").cast("string").alias("id"),
            micros("expires_at").alias("expiry"), F.coalesce(F.col("quantity").cast("long"), F.lit(0)).alias("quantity"), micros("added_at").alias("added"),
            F.unix_micros(F.date_add(F.to_date("added_at"), 1).cast("timestamp")).alias("closes"),
        )
        .groupBy("basket_day", "bucket")
        .applyInPandasWithState(_hold, _HOLDING, _HELD, "update", GroupStateTimeout.EventTimeTimeout)
    )


def live_totals(changes: DataFrame) -> DataFrame:
    """Product totals per day of what is held now, from the written changes of ``stream_live_basket``; sessions are counted exactly."""
    rest = ["total_quantity", "basket_rows", "earliest_add", "latest_add"]
    newest = changes.groupBy("basket_day", "productId", "session_id").agg(F.max_by(F.struct(*rest), "batch_id").alias("s")).filter("s.basket_rows > 0")
    return newest.groupBy("basket_day", "productId").agg(
        F.count("session_id").alias("active_sessions"),
        F.sum("s.total_quantity").alias("total_quantity"),
        F.sum("s.basket_rows").alias("basket_rows"),
        F.min("s.earliest_add").alias("earliest_add"),
        F.max("s.latest_add").alias("latest_add"),
    )
