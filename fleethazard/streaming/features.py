"""The batch features on a stream: each micro-batch runs through the batch operator, led by the rows its frames reach back to.

The last rows of every engine are a table in the shared folder, with one version per micro-batch. A version is made from
those before it alone, so a micro-batch that is run again after a failure gives the same features and the same version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleethazard.functions.columns import signal_columns
from fleethazard.functions.scalar import nonfinite_to_null
from fleethazard.operators.features import feature_frame
from fleethazard.params import FeatureSpec
from fleethazard.session import folder_names, remove, scratch

Sink = Callable[[DataFrame, int], None]


def parquet_sink(path: str) -> Sink:
    """A folder per micro-batch; one that is run again replaces its own."""
    return lambda features, batch_id: features.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


class EngineRows:
    """The newest rows of every engine, in versions under ``path``: what a micro-batch changed (``changed=N``), and now and then
    all engines (``all=N``), so that a reader needs the last such and the changes since."""

    def __init__(self, spark: SparkSession, path: str, signals: list[str], rows: int, all_every: int):
        self.spark, self.path, self.rows, self.all_every = spark, path, max(rows, 1), all_every
        self.schema = ("engine_id long, cycle long, " + "".join(f"`{s}` double, " for s in signals)
                       + "last_cycle long, dropped long, version long")
        self.columns = ["engine_id", "cycle", *signals, "last_cycle", "dropped", "version"]

    def before(self, batch_id: int, engines: DataFrame | None = None, all_before: int | None = None) -> DataFrame:
        """Each engine's newest version older than ``batch_id``, of the given ``engines`` or all; ``all_before`` leaves out later
        versions of all engines."""
        names = folder_names(self.spark, self.path)
        ids = lambda kind: sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}="))
        full = max((i for i in ids("all") if i < (batch_id if all_before is None else all_before)), default=-1)
        parts = [f"{self.path}/all={full}"] * (full >= 0) + [f"{self.path}/changed={i}" for i in ids("changed") if full < i < batch_id]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        found = self.spark.read.schema(self.schema).parquet(*parts)
        if engines is not None:
            found = found.join(engines, "engine_id", "left_semi")
        if len(parts) == 1:
            return found
        newest = found.groupBy("engine_id").agg(F.max("version").alias("version"))
        return found.join(newest, ["engine_id", "version"]).select(*found.columns)

    def save(self, batch_id: int, rows: DataFrame) -> None:
        """The engines of a micro-batch: key, signals, ``last_cycle`` and ``dropped`` of their rows."""
        back = F.row_number().over(Window.partitionBy("engine_id").orderBy(F.desc("cycle")))
        # a rank filter this small is applied per task before the shuffle
        kept = rows.withColumn("_back", back).where(F.col("_back") <= self.rows).withColumn("version", F.lit(batch_id).cast("long"))
        kept.select(*self.columns).write.mode("overwrite").parquet(f"{self.path}/changed={batch_id}")
        if self.all_every and (batch_id + 1) % self.all_every == 0:
            # a first attempt may have left this very version: it is written anew, and not from itself
            self.before(batch_id + 1, all_before=batch_id).write.mode("overwrite").parquet(f"{self.path}/all={batch_id}")


def _at_rest(df: DataFrame, what: str, kept: list[str]) -> DataFrame:
    """``df`` written to the shared folder, at a path that is added to ``kept``."""
    kept.append(scratch(df.sparkSession, what))
    df.write.parquet(kept[-1])
    return df.sparkSession.read.parquet(kept[-1])


def batch_features(batch: DataFrame, batch_id: int, spec: FeatureSpec, state: EngineRows, sink: Sink) -> None:
    """Features of one micro-batch into ``sink``, and the engines' new version."""
    signals = signal_columns(batch)
    values = F.struct(*[nonfinite_to_null(F.col(s).cast("double")).alias(s) for s in signals])
    arrived = batch.groupBy("engine_id", "cycle").agg(F.min(values).alias("row"), F.count(F.lit(1)).alias("n"))
    # both are read more than once and written before, so that no task holds the sorts and hash tables of all these steps at a time
    spark, kept = batch.sparkSession, []
    past = _at_rest(state.before(batch_id, batch.select("engine_id").distinct()), "stream-past", kept)
    heads = past.groupBy("engine_id").agg(F.max("last_cycle").alias("last"), F.max("dropped").alias("dropped_before"))
    judged = arrived.join(heads, "engine_id", "left").withColumn("late", F.coalesce(F.col("cycle") <= F.col("last"), F.lit(False)))
    judged = _at_rest(judged, "stream-judged", kept)
    totals = judged.groupBy("engine_id").agg(
        F.greatest(F.max("last"), F.max(F.when(~F.col("late"), F.col("cycle")))).alias("last_cycle"),
        (F.coalesce(F.max("dropped_before"), F.lit(0)) + F.sum("n") - F.count_if(~F.col("late"))).alias("dropped"))
    fresh = judged.where("NOT late").select("engine_id", "cycle", "row.*", F.lit(False).alias("_old"))
    rows = fresh.unionByName(past.select("engine_id", "cycle", *signals, F.lit(True).alias("_old")))
    # read by the features and by the new version; the wide plan then begins here
    rows = rows.join(totals, "engine_id").persist()
    try:
        features = feature_frame(rows, spec, keep=["_old", "dropped"]).where("NOT _old")
        sink(features.select(*[c for c in features.columns if c not in ("_old", "dropped")], "dropped"), batch_id)
        state.save(batch_id, rows)
    finally:
        rows.unpersist()
        for path in kept:
            remove(spark, path)


def stream_features(stream: DataFrame, spec: FeatureSpec, sink: Sink, state_path: str, checkpoint: str,
                    trigger: dict | None = None, all_every: int = 20) -> StreamingQuery:
    """Start a stream that hands ``engine_id, cycle``, the features of `feature_frame` and ``dropped`` (rows of the engine dropped
    so far) to ``sink``, micro-batch by micro-batch.

    A cycle that is not above the engine's last one is dropped and counted; of rows that share a cycle in one micro-batch,
    the one with the smallest signals stays. Rows are cut into blocks as in the batch operator, so no engine, however
    many rows it sends, is one task. Between micro-batches an engine keeps the rows its frames reach back to. ``state_path`` and
    ``checkpoint`` belong together: neither is used without the other.
    """
    spark = stream.sparkSession
    signals = signal_columns(stream)
    state = EngineRows(spark, state_path, signals, spec.history(), all_every)

    def run(batch: DataFrame, batch_id: int) -> None:
        batch_features(batch.select("engine_id", "cycle", *signals), batch_id, spec, state, sink)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
