"""Registries as keyed tables: document versions, runs, drift of canonical hashes, artifacts with a lifetime."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Lifetimes in seconds: inspection artifacts, drift entries.
INSPECTION_TTL, DRIFT_TTL = 2 * 3600, 30 * 86400
LIST_LIMIT = 100


def last_wins(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row a key: the last by ``order`` (columns, ascending)."""
    newest = F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), F.struct(*order) if len(order) > 1 else order[0])
    return rows.groupBy(*keys).agg(newest.alias("__v")).select(*keys, "__v.*").select(*rows.columns)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], at: str = "updated_at") -> DataFrame:
    """A keyed table after an upsert: new rows replace old ones of their key, the newest of several new ones."""
    both = old.withColumn("__n", F.lit(0)).unionByName(new.withColumn("__n", F.lit(1)))
    return last_wins(both, keys, ["__n", at]).drop("__n")


def create_or_get(registry: DataFrame, requests: DataFrame, keys: list[str]) -> DataFrame:
    """The registry with rows for requests that have none; existing rows stay as they are."""
    first = requests.dropDuplicates(keys).join(registry.select(*keys), keys, "left_anti")
    return registry.unionByName(first, allowMissingColumns=True)


def set_status(registry: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Status, error and time of registered rows from (keys, status, error, updated_at); unknown keys are ignored."""
    u = updates.select(*keys, *[F.col(c).alias(f"__{c}") for c in ("status", "error", "updated_at")])
    j = registry.join(u, keys, "left")
    return j.withColumns({c: F.coalesce(f"__{c}", c) for c in ("status", "error", "updated_at")}).drop("__status", "__error", "__updated_at")


def by_status(registry: DataFrame, status: str, limit: int = LIST_LIMIT) -> DataFrame:
    """The newest rows of a status: a bounded listing."""
    return registry.where(F.col("status") == status).orderBy(F.desc("updated_at"), "document_id").limit(limit)


def by_run(registry: DataFrame, run_id: str) -> DataFrame:
    return registry.where(F.col("ingest_run_id") == run_id)


def _micros(at: Column) -> Column:
    """A time to the microsecond; whole seconds would end a lifetime up to a second early."""
    return F.unix_micros(at.cast("timestamp"))


def drift(runs: DataFrame) -> DataFrame:
    """Each run (document_id, pdf_hash, pipeline_version, canonical_hash, run_ts) against the one before it of the same source and version.

    Entries older than the lifetime do not count.
    """
    w = Window.partitionBy("pdf_hash", "pipeline_version").orderBy("run_ts", "document_id")
    before, then = F.lag("canonical_hash").over(w), F.lag("run_ts").over(w)
    fresh = before.isNotNull() & (_micros(F.col("run_ts")) - _micros(then) <= DRIFT_TTL * 1_000_000)
    previous = F.when(fresh, before)
    state = F.when(previous.isNull(), "first_run").when(previous == F.col("canonical_hash"), "deterministic").otherwise("drifted")
    return runs.select("*", previous.alias("previous_hash"), state.alias("state"))


def register_run(registry: DataFrame, runs: DataFrame) -> DataFrame:
    """The drift registry after runs: the newest entry of each source and version."""
    return last_wins(registry.unionByName(runs), ["pdf_hash", "pipeline_version"], ["run_ts", "document_id"])


def alive(rows: DataFrame, now, ttl: int = INSPECTION_TTL, at: str = "saved_at") -> DataFrame:
    """Rows younger than a lifetime in seconds."""
    return rows.where(_micros(now) - _micros(F.col(at)) < ttl * 1_000_000)


def recent_inspections(artifacts: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row a task, newest first: VLM artifacts override regex ones; tasks without metadata are left out."""
    rank = F.when(F.col("stage") == "vlm", 1).otherwise(0)
    pick = artifacts.groupBy("task_id").agg(F.max_by(F.struct("stage", "saved_at"), F.struct(rank, "saved_at")).alias("x"))
    return pick.select("task_id", "x.*").join(metadata, "task_id").orderBy(F.desc("saved_at"), "task_id")


#: Logarithm of the registers of a sketch; estimates are off by about 0.8 % as a rule.
SKETCH_BITS = 14


def sketches(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A sketch of the distinct values of each key, to be stored with a run: (keys, sketch)."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(value, SKETCH_BITS).alias("sketch"))


def merged(stored: DataFrame, keys: list[str]) -> DataFrame:
    """Estimates of distinct values over stored sketches of any runs: (keys, distinct_values). Their rows are not read again."""
    return stored.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))
