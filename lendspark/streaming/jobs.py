"""Streaming forms: drift per window, against a reference or the window before, live scoring, outcomes of decisions, and segment rates with late data."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import constants as K
from ..functions import bin_index
from ..operators.drift import Edges, drift_alert, drift_verdict, edges_frame, psi_from_counts
from ..operators.scoring import score


def read_arrivals(spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files as they land in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def windowed_bin_counts(
    events: DataFrame, edges: Edges, ts: str = "ts", window: str = "7 days", watermark: str = "1 day",
    start_offset: str = "4 days", feature: str = "feature", value: str = "x",
) -> DataFrame:
    """(window_start, feature, bin, n): state is windows x features x bins counters, whatever the traffic.

    The edges are a broadcast table with one row per feature.  Values outside them, and those of features without edges, are counted
    under a NULL bin.
    """
    table = edges_frame(events.sparkSession, edges)
    binned = events.withWatermark(ts, watermark).where(F.col(value).isNotNull()).join(table.withColumnRenamed("feature", "_f"),
                                                                                        F.col(feature) == F.col("_f"), "left")
    binned = binned.withColumn("bin", bin_index(F.col(value), F.col("edges"), closed="left"))
    w = F.window(ts, window, startTime=start_offset)
    return binned.groupBy(w.alias("w"), F.col(feature).alias("feature"), "bin").agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), "feature", "bin", "n"
    )


def stream_drift(
    events: DataFrame, edges: Edges, reference_counts: DataFrame, counts_path: str, checkpoint: str,
    on_alert: Callable[[DataFrame, int], None] | None = None, alert_at: int = 3, **window_options,
) -> StreamingQuery:
    """Keep the bin counts of all closed windows and raise alerts.

    Append mode emits a window once, when the watermark has passed it, so every emitted window is complete.  Each micro-batch
    is written under its own id: a replayed batch overwrites itself.  PSI is a small aggregate over the written counts.
    """
    counts = windowed_bin_counts(events, edges, **window_options)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{counts_path}/batch={batch_id}")
        if on_alert is not None:
            psi = psi_from_counts(batch, "window_start", edges, reference_counts)
            on_alert(drift_alert(psi, "window_start", alert_at), batch_id)

    return counts.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(
        keep).start()


_STEPS = "window_start timestamp, feature string, previous timestamp, n long, psi double"
_KEPT = "starts array<long>, counts array<array<long>>, last_start long, last_counts array<long>"


def psi_value(before: np.ndarray, now: np.ndarray) -> float:
    r, c = before / before.sum(), now / now.sum()
    return float(((r - c) * np.log(np.maximum(r, K.PSI_FLOOR) / np.maximum(c, K.PSI_FLOOR))).sum())


def successive_drift(
    events: DataFrame, edges: Edges, ts: str = "ts", window_days: int = 7, watermark: str = "1 day", offset_days: int = 4, feature: str = "feature", value: str = "x",
) -> DataFrame:
    """(window_start, feature, previous, n, psi, drift_verdict) of a stream, each window against the feature's last window before it.

    State per feature: the counters of its open windows and of its last closed one, so its size follows the edges and not the traffic.  An
    event-time timer closes a window when the watermark passes its end, also if the feature has no more events.  Rows later than
    the watermark are dropped; values outside the edges and features without bins count nowhere.
    """
    step, shift = window_days * 86_400_000, offset_days * 86_400_000
    known = {f: np.asarray(e, dtype=float) for f, e in edges.items() if len(e) > 1}

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        own = known.get(key[0])
        starts, counts, last_start, last_counts = state.get if state.exists else ([], [], None, None)
        held = {int(s): np.asarray(c, dtype=np.int64) for s, c in zip(starts, counts)}
        last = None if last_start is None else (int(last_start), np.asarray(last_counts, dtype=np.int64))
        if own is None:
            return
        for pdf in batches:
            x = pdf["x"].to_numpy(dtype=float)
            inside = (x >= own[0]) & (x <= own[-1])
            at = np.minimum(np.searchsorted(own, x[inside], side="right") - 1, len(own) - 2)  # left-closed, the last bin closed
            start = (pdf["ms"].to_numpy()[inside] - shift) // step * step + shift
            for s in np.unique(start):
                held[int(s)] = held.get(int(s), np.zeros(len(own) - 1, dtype=np.int64)) + np.bincount(at[start == s], minlength=len(own) - 1)
        out = []
        now = state.getCurrentWatermarkMs()
        for s in sorted(held):
            if s + step > now:
                break
            c = held.pop(s)
            out.append((s, key[0], None if last is None else last[0], int(c.sum()), None if last is None else psi_value(last[1], c)))
            last = s, c
        state.update((list(held), [c.tolist() for c in held.values()], None if last is None else last[0], None if last is None else last[1].tolist()))
        if held:
            state.setTimeoutTimestamp(max(min(held) + step, now + 1))
        if out:
            frame = pd.DataFrame(out, columns=["window_start", "feature", "previous", "n", "psi"])
            for c in ("window_start", "previous"):
                frame[c] = pd.to_datetime(frame[c], unit="ms")
            yield frame

    rows = events.withWatermark(ts, watermark).where(F.col(value).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(feature).alias("feature"), F.col(value).cast("double").alias("x"), F.unix_millis(ts).alias("ms"), F.col(ts))
    steps = rows.groupBy("feature").applyInPandasWithState(update, _STEPS, _KEPT, "append", GroupStateTimeout.EventTimeTimeout)
    return steps.withColumn("drift_verdict", drift_verdict("psi"))


def decision_outcomes(
    decisions: DataFrame, outcomes: DataFrame, key: str, ts: str = "ts", outcome_ts: str = "at", target: str = K.TARGET, horizon: str = "90 days",
    watermarks: tuple[str, str] = ("1 day", "1 day"),
) -> DataFrame:
    """Every decision with the outcome that came within ``horizon`` of it, NULL if none did; batch or stream alike.

    In a stream both sides have watermarks, so that state is dropped once no match can come: a decision without an outcome is
    emitted when the outcomes' watermark has passed its horizon, an outcome later than that is ignored.  Columns of ``decisions``, then ``target``.
    """
    left = decisions.withWatermark(ts, watermarks[0])
    right = outcomes.select(F.col(key).alias("_key"), F.col(outcome_ts).alias("_at"), F.col(target).alias(target)).withWatermark("_at", watermarks[1])
    near = (F.col(key) == F.col("_key")) & (F.col("_at") >= F.col(ts)) & (F.col("_at") <= F.col(ts) + F.expr(f"INTERVAL {horizon}"))
    return left.drop(target).join(right, near, "left").drop("_key", "_at")


def outcome_rates(joined: DataFrame, ts: str = "ts", target: str = K.TARGET, window: str = "7 days", start_offset: str = "4 days") -> DataFrame:
    """(window_start, recommendation, n_decided, n_known, defaults, default_rate) of decisions with their outcomes."""
    w = F.window(ts, window, startTime=start_offset)
    return joined.groupBy(w.alias("w"), "recommendation").agg(
        F.count("*").alias("n_decided"), F.count(target).alias("n_known"), F.count_if(F.col(target) == 1).alias("defaults"), F.avg(target).alias("default_rate"),
    ).select(F.col("w.start").alias("window_start"), "recommendation", "n_decided", "n_known", "defaults", "default_rate")


def append_to(df: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    """Run a stream over what has arrived and append its rows; the file sink commits each batch once, a restart goes on from the checkpoint."""
    return df.writeStream.format("parquet").outputMode("append").option("path", out_path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_psi(spark: SparkSession, counts_path: str, edges: Edges, reference_counts: DataFrame) -> DataFrame:
    """(window_start, feature, psi, drift_verdict) of everything the stream has closed so far."""
    return psi_from_counts(spark.read.parquet(counts_path).drop("batch"), "window_start", edges, reference_counts)


def stream_scores(
    applicants: DataFrame, model: Transformer | PipelineModel, out_path: str, checkpoint: str, required: Sequence[str] = (),
    keep: Sequence[str] = (K.ID,), **policy,
) -> StreamingQuery:
    """Score arriving applicants and append the decisions; the file sink commits each batch once."""
    scored = score(applicants, model, required, **policy).select(*keep, "probability_of_default", "recommendation")
    return scored.writeStream.format("parquet").outputMode("append").option("path", out_path).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_rates(
    rows: DataFrame, segment: Column | str, ts: str = "ts", target: str = K.TARGET, window: str = "7 days",
    slide: str | None = None, watermark: str = "1 day", start_offset: str | None = None, min_n: int = 100,
) -> DataFrame:
    """Default rate with interval per window and segment; rows later than the watermark are dropped.

    Tumbling weeks start on Monday (4 days after the epoch's Thursday) unless told otherwise.
    """
    start_offset = start_offset or ("0 days" if slide else "4 days")
    seg = F.col(segment) if isinstance(segment, str) else segment
    w = F.window(ts, window, slide or window, startTime=start_offset)
    agg = rows.withWatermark(ts, watermark).groupBy(w.alias("w"), seg.alias("segment")).agg(
        F.count("*").alias("n"), F.sum(F.col(target).cast("long")).alias("defaults")
    ).where(F.col("n") >= min_n)
    rate = F.col("defaults") / F.col("n")
    half = K.Z_ROUNDED * F.sqrt(rate * (1 - rate) / F.col("n"))
    return agg.select(
        F.col("w.start").alias("window_start"), "segment", "n", rate.alias("default_rate"),
        F.greatest(rate - half, F.lit(0.0)).alias("ci_lo"), F.least(rate + half, F.lit(1.0)).alias("ci_hi"),
    )


def stream_windowed_rates(rates: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    return rates.writeStream.format("parquet").outputMode("append").option("path", out_path).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
