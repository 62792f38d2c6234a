"""Results of micro-batches, published batch by batch.

A batch writes all its results at once, as one long table, into a folder of its own attempt, and
then puts an entry into the manifest. Readers see the attempts that the manifest names, so a batch
becomes visible whole or not at all, and one delivered again replaces its first attempt.

A *run* is a streaming query with its checkpoint. A new query counts its batches from 0 again;
they stand next to those of older runs, behind them in order.

Folding sums up finished batches by the rule of each result. Its entry names the batches it covers and the entry up to
which it has read, so a batch that is published meanwhile stays as it is. The newest
batch of a run stays out, because a restart may deliver it again; older ones that come again
are ignored. What folds have replaced is removed by ``prune`` after a time of grace.

Entries are numbered and never replaced: whoever comes second takes the next number.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.sinks.entries import Entries
from orderflow.sources.tables import JdbcTable

#: Order of batches over runs: tenths of a second at the run's begin, then the batch.
BATCHES_PER_RUN = 1 << 28
#: Folds whose rows are all kept are merged when there are so many of a level.
FAN = 10
_PLACES = {"result", "run", "batch", "attempt", "fold"}


@dataclass
class Published:
    """What the manifest says: the newest fold and the batches behind it."""

    position: int = 0  # of the last entry that is taken in
    fold: int = 0  # how many folds there were
    parts: dict[str, list[list]] = field(default_factory=dict)  # [level, folder] of each result's folds
    covers: dict[str, int] = field(default_factory=dict)  # last folded batch of each run
    begun: dict[str, int] = field(default_factory=dict)
    live: dict[tuple[str, int], str] = field(default_factory=dict)
    replaced: list[str] = field(default_factory=list)  # folders of attempts that a later one replaced
    results: dict[str, str] = field(default_factory=dict)  # schema of each result

    def order(self, run: str, batch: int) -> int:
        return self.begun[run] * BATCHES_PER_RUN + batch

    def take(self, number: int, entry: dict) -> None:
        """Take in the next entry."""
        if "fold" in entry:
            kept = entry["fold"]
            self.fold, self.parts, self.covers = kept["number"], kept["parts"], kept["covers"]
            self.begun, self.results = {**kept["begun"], **self.begun}, {**kept["results"], **self.results}
            self.live = {k: v for k, v in self.live.items() if k[1] > self.covers.get(k[0], -1)}
            self.replaced = [x for x in self.replaced if x not in set(kept["gone"])]
        else:
            run, batch = entry["run"], entry["batch"]
            # Runs that begin together are one behind the other.
            self.begun.setdefault(run, max([entry["at"] // 100, *[x + 1 for x in self.begun.values()]]))
            self.results |= entry["results"]
            folder = _attempt(run, batch, entry["attempt"])
            if batch <= self.covers.get(run, -1):
                self.replaced.append(folder)
            else:
                if (run, batch) in self.live:
                    self.replaced.append(_attempt(run, batch, self.live[run, batch]))
                self.live[run, batch] = entry["attempt"]
        self.position = number


def _attempt(run: str, batch: int, attempt: str) -> str:
    return f"data/run={run}/batch={batch}/attempt={attempt}"


class Manifest:
    """The entries of a result folder and the state they give, read on from where this process was."""

    def __init__(self, spark: SparkSession, folder: str):
        self.entries = Entries(spark, f"{folder}/manifest")
        self.state = Published()

    def refresh(self) -> Published:
        if self.state.position and not self.entries.has(self.state.position):
            self.state = Published()  # another folder by now, or pruned
        numbers = self.entries.numbers(self.state.position)
        if self.state.position == 0 and numbers:
            numbers = self._from_newest_fold(numbers)
        for number in numbers:
            if (entry := self.entries.read(number)) is not None:
                self.state.take(number, entry)
        return self.state

    def _from_newest_fold(self, numbers: list[int]) -> list[int]:
        """The newest fold, and the entries that it hasn't read."""
        for number in reversed(numbers):
            entry = self.entries.read(number)
            if entry and "fold" in entry:
                kept = entry["fold"]
                for run, batch, attempt in kept["live"]:
                    self.state.live[run, batch] = attempt
                self.state.begun, self.state.replaced = dict(kept["begun"]), list(kept["replaced"])
                self.state.results = dict(kept["results"])
                return [x for x in numbers if x > kept["upto"]]
        return numbers

    def append(self, entry: dict) -> None:
        """Put an entry behind all others; what others have put meanwhile is taken in first."""
        if not self.entries.has(max(1, self.state.position)):
            self.refresh()  # others have pruned what this process had read last
        while not self.entries.put_if_absent(self.state.position + 1, entry):
            self.refresh()
        self.state.take(self.state.position + 1, entry)

    def append_fold(self, entry: dict) -> bool:
        """Put a fold behind all others, unless another fold has come between."""
        while not self.entries.put_if_absent(self.state.position + 1, entry):
            before = self.state.fold
            self.refresh()
            if self.state.fold != before:
                return False
        self.state.take(self.state.position + 1, entry)
        return True


_known: dict[str, Manifest] = {}


def manifest(spark: SparkSession, folder: str) -> Manifest:
    """This process's manifest of a folder; a publisher needs no second look at what it has written itself."""
    key = f"{spark.sparkContext.applicationId} {folder}"
    return _known.setdefault(key, Manifest(spark, folder))


def current_run(spark: SparkSession) -> str:
    """The id of the streaming query whose batch this is; it stays with the checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def published(spark: SparkSession, folder: str) -> Published:
    return manifest(spark, folder).refresh()


def _together(results: dict[str, DataFrame]) -> DataFrame:
    """Results as one table with a column for each name; a name has one type."""
    kinds: dict[str, str] = {}
    for name, rows in results.items():
        for column, kind in rows.dtypes:
            if column in _PLACES:
                raise ValueError(f"{name}: a result can't have a column {column}")
            if kinds.setdefault(column, kind) != kind:
                raise ValueError(f"{name}: {column} is {kind} here and {kinds[column]} elsewhere")
    marked = [rows.withColumn("result", F.lit(name)) for name, rows in results.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)


def publish(results: dict[str, DataFrame], folder: str, batch_id: int, run: str | None = None) -> None:
    """Write a batch's results in one job and make them visible."""
    spark = next(iter(results.values())).sparkSession
    run = run or current_run(spark)
    attempt = uuid.uuid4().hex
    _together(results).write.partitionBy("result").parquet(f"{folder}/{_attempt(run, batch_id, attempt)}")
    schemas = {name: frame.schema.json() for name, frame in results.items()}
    entry = {"run": run, "batch": batch_id, "attempt": attempt, "at": time.time_ns() // 1_000_000, "results": schemas}
    manifest(spark, folder).append(entry)


def write_batch(rows: DataFrame, folder: str, batch_id: int, run: str | None = None) -> None:
    publish({"rows": rows}, folder, batch_id, run)


def _read(
    spark: SparkSession, state: Published, name: str, folder: str, live: dict | None = None, parts: Iterable[str] | None = None
) -> DataFrame:
    """Rows of a result in live batches and in folders of folds, all of them or those given."""
    if name not in state.results:
        raise ValueError(f"no batch has published {name} in {folder}")
    schema = T.StructType.fromJson(json.loads(state.results[name]))
    ordered = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    live = state.live if live is None else live
    parts = [x for _, x in state.parts.get(name, [])] if parts is None else list(parts)
    found = []
    if live:
        paths = [f"{folder}/{_attempt(r, b, a)}" for (r, b), a in live.items()]
        places = T.StructType([T.StructField(c, T.LongType() if c == "batch" else T.StringType()) for c in ("result", "run", "batch")])
        rows = (
            spark.read.option("basePath", f"{folder}/data").schema(T.StructType([*schema.fields, *places.fields])).parquet(*paths)
        )
        begun = F.create_map(*[F.lit(x) for r in {r for r, _ in live} for x in (r, state.begun[r])])
        order = begun[F.col("run")] * BATCHES_PER_RUN + F.col("batch")
        found.append(rows.where(F.col("result") == name).withColumn("batch_id", order).drop(*places.names, "attempt"))
    if parts:
        marked = T.StructType([*ordered.fields, T.StructField("result", T.StringType())])
        folded = spark.read.option("basePath", f"{folder}/folded").schema(marked).parquet(*[f"{folder}/folded/{x}" for x in parts])
        found.append(folded.where(F.col("result") == name).select(*ordered.names))
    if not found:
        return spark.createDataFrame([], ordered)
    return reduce(DataFrame.unionByName, found)


def read_batches(spark: SparkSession, folder: str, name: str = "rows") -> DataFrame:
    """Every published row, with ``batch_id``, the order of its batch over all runs."""
    return _read(spark, published(spark, folder), name, folder)


def newest_snapshot(spark: SparkSession, folder: str, name: str = "rows") -> DataFrame:
    """All rows of the last batch, for results that are written whole each time."""
    state = published(spark, folder)
    last = max(state.live, key=lambda k: state.order(*k), default=None)
    # The newest batch of the newest run is never folded.
    only = {last: state.live[last]} if last else {}
    return _read(spark, state, name, folder, only, parts=()).drop("batch_id")


def newest_snapshots(spark: SparkSession, folder: str, name: str = "rows") -> DataFrame:
    """All rows of the last batch of every run."""
    state = published(spark, folder)
    last = {run: max(b for r, b in state.live if r == run) for run in {r for r, _ in state.live}}
    only = {(run, batch): state.live[run, batch] for run, batch in last.items()}
    return _read(spark, state, name, folder, only, parts=()).drop("batch_id")


def newest_per_key(history: DataFrame, *keys: str) -> DataFrame:
    """Keyed upsert: the row of each key from the last batch that wrote the key.

    A batch holds a key once. The values are picked column by column, because
    numbers then stay in a hash aggregate and a struct of them would not.
    """
    values = [c for c in history.columns if c not in (*keys, "batch_id")]
    return history.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in values])


def counter_sums(history: DataFrame, *keys: str) -> DataFrame:
    """Additive counters: the batches hold increments, the view adds them up."""
    counters = [c for c in history.columns if c not in (*keys, "batch_id")]
    return history.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counters])


def running_totals(history: DataFrame, *keys: str) -> DataFrame:
    """Running sums over several runs, each of which began from nothing: the newest of every run, added up."""
    newest = newest_of_runs(history, *keys)
    return counter_sums(newest, *keys)


def newest_of_runs(history: DataFrame, *keys: str) -> DataFrame:
    """The row of each key from the last batch of each run that wrote the key."""
    values = [c for c in history.columns if c not in (*keys, "batch_id")]
    run = F.expr(f"batch_id div {BATCHES_PER_RUN}").alias("_run")
    newest = [F.max_by(c, "batch_id").alias(c) for c in values]
    return history.groupBy(*keys, run).agg(*newest, F.max("batch_id").alias("batch_id")).drop("_run")


@dataclass(frozen=True)
class Fold:
    """How finished batches of a result become fewer rows: ``sum``, ``newest``, ``running``, ``last`` or ``all``."""

    rule: str
    keys: tuple[str, ...] = ()

    def apply(self, history: DataFrame) -> DataFrame:
        values = [c for c in history.columns if c not in (*self.keys, "batch_id")]
        last = F.max("batch_id").alias("batch_id")
        if self.rule == "sum":
            return history.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in values], last)
        if self.rule == "newest":
            return history.groupBy(*self.keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in values], last)
        if self.rule == "running":
            return newest_of_runs(history, *self.keys)
        if self.rule == "last":
            return history.limit(0)
        return history


def fold(spark: SparkSession, folder: str, rules: dict[str, Fold], at_least: int = 1) -> bool:
    """Fold all batches but the newest of each run, if there are ``at_least`` so many.

    Results that keep all their rows (``all``, or no rule) keep their folders too; ``FAN`` of a level are merged
    into one of the next, so a row is written again a few times only, however long the history. Other
    results are written anew, as few rows as they have keys. What is replaced stays for readers.
    """
    held = manifest(spark, folder)
    state = held.refresh()
    newest: dict[str, int] = {}
    for run, batch in state.live:
        newest[run] = max(batch, newest.get(run, -1))
    done = {k: v for k, v in state.live.items() if k[1] < newest[k[0]]}
    if len(done) < at_least:
        return False
    name_of_fold, folded, parts, gone = f"fold={uuid.uuid4().hex}", {}, {}, []
    for name in state.results:
        rule, old = rules.get(name, Fold("all")), state.parts.get(name, [])
        level, merged = 0, []
        if rule.rule == "all":
            while len(same := [x for x in old if x[0] == level]) >= FAN - 1:
                merged, level = merged + same, level + 1
        else:
            merged = old
        rows = _read(spark, state, name, folder, done, parts=[x for _, x in merged])
        folded[name] = rule.apply(rows)
        parts[name] = [x for x in old if x not in merged] + [[level, f"{name_of_fold}/result={name}"]]
        gone += [f"folded/{x}" for _, x in merged]
    # An attempt to fold that broke off leaves a folder that no manifest names.
    _together(folded).write.partitionBy("result").parquet(f"{folder}/folded/{name_of_fold}")
    made = set(_written(spark, f"{folder}/folded/{name_of_fold}"))
    parts = {name: [x for x in held_parts if not x[1].startswith(name_of_fold) or name in made] for name, held_parts in parts.items()}
    covers = {**state.covers, **{r: max(b for x, b in done if x == r) for r, _ in done}}
    gone += [_attempt(r, b, a) for (r, b), a in done.items()] + state.replaced
    live = [[r, b, a] for (r, b), a in state.live.items() if (r, b) not in done]
    entry = {"number": state.fold + 1, "upto": state.position, "parts": parts, "covers": covers, "begun": state.begun, "live": live}
    entry |= {"results": state.results, "replaced": [], "gone": gone}
    return held.append_fold({"fold": entry, "at": time.time_ns() // 1_000_000})


def _written(spark: SparkSession, folder: str) -> list[str]:
    """Names of the results in a folder; a result without rows has no folder."""
    entries = Entries(spark, folder)
    return [x.removeprefix("result=") for x in entries.names() if x.startswith("result=")]


def prune(spark: SparkSession, folder: str, grace_seconds: float = 24 * 3600) -> int:
    """Remove what folds older than the time of grace have replaced, and the entries before them.

    A reader that took its plan within that time finds all its files. Returns how many folders and entries went.
    """
    entries = Entries(spark, f"{folder}/manifest")
    before = time.time_ns() // 1_000_000 - int(grace_seconds * 1000)
    folds = [(n, e) for n in entries.numbers() if (e := entries.read(n)) and "fold" in e and e["at"] <= before]
    if not folds:
        return 0
    number, newest = folds[-1]
    removed = 0
    for _, old in folds:
        for place in old["fold"]["gone"]:
            entries.remove_beside(place)
            removed += 1
    for old in entries.numbers():
        if old <= newest["fold"]["upto"] and old != number:
            entries.remove(old)
            removed += 1
    return removed


def with_row_key(rows: DataFrame, *keys: str) -> DataFrame:
    """Add ``row_key``, the same for the same keys in every run."""
    parts = [F.coalesce(F.col(key).cast("string"), F.lit("\\N")) for key in keys]
    return rows.withColumn("row_key", F.sha2(F.to_json(F.array(*parts)), 256))


def append_to_store(rows: DataFrame, target: JdbcTable, batch_id: int) -> None:
    """Append a batch to a relational table, marked with its ``batch_id``.

    The store cannot replace a batch; read it through ``without_replays``.
    """
    marked = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    marked.write.format("jdbc").options(**target.options()).mode("append").save()


def without_replays(history: DataFrame, *keys: str) -> DataFrame:
    """One row per key and batch, however often the batch was delivered."""
    return history.dropDuplicates([*keys, "batch_id"])
