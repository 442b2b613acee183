"""Group-relative advantages of scored completions as they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallymark.fixed import ADVANTAGE_EPS, GENERATIONS

SCORED = "id string, gen long, total_reward double"
_OUTPUT = "id string, gen long, total_reward double, advantage double, reason string"
_STATE = "groups binary"
# Seconds that a group waits for the rest of its completions.
DELAY = 3_600
# Groups are kept in as many buckets by a hash of their id: Python is called once for a bucket of a micro-batch, which costs
# far more than a group. A checkpoint keeps to the number that it was begun with.
BUCKETS = 8_192
_BUCKET = "__bucket"
_TIME = "__time"
_NO_GEN = "__no_gen"


def _advantages(owner: np.ndarray, rewards: np.ndarray, eps: float) -> np.ndarray:
    """As :func:`tallymark.operators.advantage.group_advantage`; ``owner`` is the number of each row's group."""
    there = ~np.isnan(rewards)
    low, high = np.full(owner.max(initial=0) + 1, np.inf), np.full(owner.max(initial=0) + 1, -np.inf)
    np.minimum.at(low, owner[there], rewards[there])
    np.maximum.at(high, owner[there], rewards[there])
    with np.errstate(all="ignore"):
        number = np.bincount(owner, there, len(low))
        away = rewards - (np.bincount(owner, np.where(there, rewards, 0.0), len(low)) / number)[owner]
        spread = np.sqrt(np.bincount(owner, np.where(there, away * away, 0.0), len(low)) / (number - 1))
        spread[number < 2] = np.nan
        out = np.where(((high > low) & (spread > 0))[owner], away / (spread[owner] + eps), 0.0)
    return np.where(there, out, np.nan)


def _packed(ids, due, done, sizes, gens, no_gen, rewards) -> bytes:
    """Groups of a bucket as an Arrow stream, the rows of a group after those of the one before. Done groups keep no rewards."""
    def lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)

    open_ = ~np.repeat(done, sizes)
    columns = {
        "id": pa.array(ids, pa.string()),
        "due": pa.array(due, pa.int64()),
        "done": pa.array(done, pa.bool_()),
        "gens": lists(pa.array(gens, pa.int64(), mask=no_gen), sizes),
        "rewards": lists(pa.array(rewards[open_], pa.float64()), np.where(done, 0, sizes)),
    }
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(groups: bytes | None) -> tuple[np.ndarray, ...]:
    """What :func:`_packed` was given. Rewards of done groups are NaN, numbers that are null are 0."""
    if groups is None:
        return (np.zeros(0, object), *(np.zeros(0, kind) for kind in (np.int64, bool, np.int64, np.int64, bool, float)))
    batch = pa.ipc.open_stream(groups).read_next_batch()
    ids, due, done = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("id", "due", "done"))
    sizes = batch.column("gens").value_lengths().to_numpy().astype(np.int64)
    gens = batch.column("gens").flatten()
    rewards = np.full(len(gens), np.nan)
    rewards[~np.repeat(done, sizes)] = batch.column("rewards").flatten().to_numpy(zero_copy_only=False)
    return ids, due, done, sizes, gens.fill_null(0).to_numpy(), gens.is_null().to_numpy(zero_copy_only=False), rewards


def with_advantages(
    scored: DataFrame, time: Column, delay: int = DELAY, generations: int = GENERATIONS, eps: float = ADVANTAGE_EPS
) -> DataFrame:
    """A stream of ``id, gen, total_reward`` as one of ``id, gen, total_reward, advantage, reason``.

    A group is sent on when ``generations`` different completions of it are there, or when the watermark (``delay`` seconds behind
    the latest ``time``) has passed the time of its last one; then ``reason`` is ``incomplete``. A completion that arrives again
    counts once, also after its group was sent. One that is new after that has no advantage and the reason ``late``; one
    without an id has the reason ``no_group`` and is kept apart from all others.

    The state of a group is the numbers and rewards of its completions, about ``generations`` of them; it goes when its time
    is up, and completions that arrive again after that make a group of their own. Groups are kept and looked at by the bucket.
    """
    def update(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        ids, due, done, sizes, gens, no_gen, rewards = _unpacked(bytes(state.get[0]) if state.exists else None)
        arrived = [] if state.hasTimedOut else [chunk for chunk in chunks if len(chunk)]
        if arrived:
            rows = pd.concat(arrived, ignore_index=True)
            named = rows["id"].notna().to_numpy()
            if not named.all():
                lost = rows[~named]
                gone = lost[_NO_GEN].to_numpy(bool)
                yield _rows([None] * len(lost), lost["gen"].to_numpy(), gone, lost["total_reward"].to_numpy(), np.nan, ["no_group"] * len(lost))
                rows = rows[named]
            new = rows["id"].to_numpy(object), rows["gen"].to_numpy(), rows[_NO_GEN].to_numpy(bool), rows["total_reward"].to_numpy()
            times = rows[_TIME].to_numpy("datetime64[ms]").astype(np.int64)
        else:
            new, times = (np.zeros(0, object), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0)), np.zeros(0, np.int64)
        before = len(ids)
        group, ids = pd.factorize(np.concatenate([ids, new[0]]))
        group, added = group[before:], len(ids) - before
        done = np.concatenate([done, np.zeros(added, bool)])
        touched = np.zeros(len(ids), bool)
        touched[group] = True
        latest = np.full(len(ids), max(0, now))
        np.maximum.at(latest, group, times)
        due = np.where(touched, latest + 1_000 * delay + 1, np.concatenate([due, np.zeros(added, np.int64)]))

        owner = np.concatenate([np.repeat(np.arange(before), sizes), group])
        fresh = np.arange(len(owner)) >= len(gens)
        gens, no_gen, rewards = (np.concatenate(pair) for pair in zip((gens, no_gen, rewards), new[1:]))
        # What is known comes first, so that of completions with the same number the first stays.
        kept = np.flatnonzero(~pd.DataFrame({"owner": owner, "gen": gens, "no_gen": no_gen}).duplicated().to_numpy())
        kept = kept[np.argsort(owner[kept], kind="stable")]
        owner, fresh, gens, no_gen, rewards = (values[kept] for values in (owner, fresh, gens, no_gen, rewards))
        sizes = np.bincount(owner, minlength=len(ids))

        complete = touched & ~done & (sizes >= generations)
        over = ~touched & (due < now)
        late = done[owner] & fresh
        sent = np.flatnonzero(late | complete[owner] | (over & ~done)[owner])
        if len(sent):
            advantages = np.where(late[sent], np.nan, _advantages(owner[sent], rewards[sent], eps))
            reasons = np.where(late[sent], "late", np.where(over[owner[sent]], "incomplete", None))
            yield _rows(ids[owner[sent]], gens[sent], no_gen[sent], rewards[sent], advantages, reasons)

        if over.all():
            if state.exists:
                state.remove()
            return
        stays = ~over[owner]
        groups = ids[~over], due[~over], (done | complete)[~over], sizes[~over]
        state.update((_packed(*groups, gens[stays], no_gen[stays], rewards[stays]),))
        state.setTimeoutTimestamp(int(due[~over].min()))

    gen = F.col("gen").cast("long")
    rows = scored.select(
        F.col("id").cast("string").alias("id"),
        F.coalesce(gen, F.lit(0)).alias("gen"),
        gen.isNull().alias(_NO_GEN),
        F.col("total_reward").cast("double").alias("total_reward"),
        time.cast("timestamp").alias(_TIME),
    )
    spread = F.when(F.col("id").isNull(), F.xxhash64("gen", _NO_GEN, "total_reward")).otherwise(F.xxhash64("id"))
    rows = rows.withColumn(_BUCKET, F.pmod(spread, F.lit(BUCKETS)))
    keyed = rows.withWatermark(_TIME, f"{delay} seconds").groupBy(_BUCKET)
    return keyed.applyInPandasWithState(update, _OUTPUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def _rows(ids, gens: np.ndarray, no_gen: np.ndarray, rewards: np.ndarray, advantages, reasons) -> pd.DataFrame:
    # One call: a column that is added later costs as much as all of this.
    return pd.DataFrame(
        {
            "id": pd.Series(ids, dtype="object"),
            "gen": pd.arrays.IntegerArray(gens.astype(np.int64), no_gen.copy()),
            "total_reward": np.asarray(rewards, float),
            "advantage": np.broadcast_to(np.asarray(advantages, float), len(gens)),
            "reason": pd.Series(reasons, dtype="object"),
        }
    )


def advantage_stream(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    delay: int = DELAY,
    generations: int = GENERATIONS,
    eps: float = ADVANTAGE_EPS,
    time: str | None = None,
    schema: str = SCORED,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Advantages of the scored rows in new Parquet files of ``source``, as :func:`score_stream` writes them, then stop.

    The time of a row is its column ``time``, by default the time at which its file was written. Groups that are not complete
    stay in the state below ``checkpoint`` for the next call, until their time is up.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    scored = reader.parquet(source)
    when = F.col(time) if time else F.col("_metadata.file_modification_time")
    rows = with_advantages(scored, when, delay, generations, eps)
    writer = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()
