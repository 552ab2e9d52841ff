"""Tables that change by whole versions.

Every change writes new folders that no reader knows, checks the new contents
there, and then publishes them with one commit (``playstats.storage``): all tables
of a load appear together, or none does. A run that fails or dies before its
commit leaves the last version as it was.

A commit names, for every table and bucket, the folders that hold its rows, so a
change rewrites only what it touches and the other folders stay as they are:

* ``publish`` replaces whole tables;
* ``upsert`` rewrites the buckets that hold keys of the batch;
* ``delete`` rewrites nothing: it stores the places (file, row number) of the
  deleted rows, which reads leave out, and ``compact`` folds them in;
* ``vacuum`` removes folders that no kept version names.

A table has buckets when its :class:`Layout` names a key. A row lies in the bucket of
its key's hash; rows without a key are spread by their contents. The driver handles
bucket numbers and folder names only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playstats.operators.bloom import filter_words
from playstats.scratch import stored
from playstats.sinks import dml
from playstats.storage import CommitLog, Folder

BUCKET = "__bucket"

Check = Callable[[dict[str, DataFrame]], None]


@dataclass(frozen=True)
class Layout:
    """``key`` and ``buckets``: the table can be changed by key. ``filters``: each bucket also
    stores a filter of its keys, by which a batch is checked (``sinks.constraints``).
    ``partition_by``: plain partition folders instead."""

    key: str | None = None
    buckets: int = 0
    partition_by: tuple[str, ...] = ()
    filters: bool = False


class VersionedTables:
    """The tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/_commits")

    # ------------------------------------------------------------ reading

    def version(self) -> int:
        """Number of the published version; 0: nothing is published."""
        return self.log.last()[0]

    def manifest(self, version: int | None = None) -> dict:
        return (self.log.last()[1] if version is None else self.log.get(version)).get("tables", {})

    def names(self) -> list[str]:
        return sorted(self.manifest())

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The table as published, or as it was in an older version."""
        return self._rows(self.manifest(version)[name])

    def tables(self) -> dict[str, DataFrame]:
        """All tables of one version."""
        return self._frames(self.manifest())

    def _frames(self, manifest: dict) -> dict[str, DataFrame]:
        return {name: self._rows(entry) for name, entry in manifest.items()}

    def _rows(self, entry: dict, buckets: list[str] | None = None, places: bool = False) -> DataFrame:
        """Rows of a table or of some of its buckets; with ``places`` also ``_file`` and
        ``_row``, which name a row as long as its file exists."""
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        use = entry["parts"] if buckets is None else {b: entry["parts"][b] for b in buckets if b in entry["parts"]}
        plain = [p for b, paths in use.items() if places or b not in entry["deletes"] for p in paths]
        holed = [] if places else [b for b in use if b in entry["deletes"]]
        # Spark reads partition folders below one root at a time; ``compact`` makes one of many
        groups = [[p] for p in plain] if entry["partition_by"] and plain else [plain]
        out = self._scan(schema, groups[0], places)
        for group in groups[1:]:
            out = out.unionByName(self._scan(schema, group, places))
        if holed or (places and any(b in entry["deletes"] for b in use)):
            dead = self.spark.read.schema("_file string, _row bigint").parquet(
                *[self._path(p) for b in (holed or use) for p in entry["deletes"].get(b, [])])
            if places:
                return out.join(dead, ["_file", "_row"], "left_anti")
            # only these buckets pay for the anti join; a place is unique, so no key is hot
            alive = self._scan(schema, [p for b in holed for p in use[b]], True).join(dead, ["_file", "_row"], "left_anti")
            out = out.unionByName(alive.drop("_file", "_row"))
        return out

    def _scan(self, schema: T.StructType, paths: list[str], places: bool) -> DataFrame:
        names = [F.col(f"`{n}`") for n in schema.names]
        if not paths:
            empty = self.spark.createDataFrame([], schema)
            return empty.select(*names, F.lit("").alias("_file"), F.lit(0).cast("long").alias("_row")) if places else empty
        rows = self.spark.read.schema(schema).parquet(*[self._path(p) for p in paths])
        if places:  # file names are unique in a job, folder and name among all jobs
            names += [F.substring_index("_metadata.file_path", "/", -3).alias("_file"), F.col("_metadata.row_index").alias("_row")]
        return rows.select(*names)

    def _path(self, relative: str) -> str:
        return f"{self.root}/{relative}"

    # ------------------------------------------------------------ writing

    def stage(self) -> Stage:
        """A new folder for the next version; nothing in it is visible before its commit."""
        number, last = self.log.last()
        return Stage(self, number, last.get("tables", {}))

    def publish(self, frames: Mapping[str, DataFrame], layouts: Mapping[str, Layout] | None = None,
                check: Check | None = None) -> int:
        """Replaces these tables by these rows, all at once. ``check`` gets every table as it
        will be and raises to refuse."""
        stage = self.stage()
        for name, df in frames.items():
            stage.write(name, df, (layouts or {}).get(name, Layout()))
        return stage.commit(check)

    def upsert(self, name: str, batch: DataFrame, update_cols: list[str], order_by: list[str],
               check: Check | None = None) -> int:
        """:meth:`Stage.upsert` as a version of its own; the number of the version in force."""
        stage = self.stage()
        stage.upsert(name, batch, update_cols, order_by)
        return stage.commit(check)

    def delete(self, name: str, keys: DataFrame | object, check: Check | None = None) -> int:
        """:meth:`Stage.delete` as a version of its own."""
        stage = self.stage()
        stage.delete(name, keys)
        return stage.commit(check)

    def compact(self, name: str) -> int:
        """Writes the buckets that have deleted rows, or several folders, anew."""
        stage = self.stage()
        entry = stage.entry(name)
        touched = [b for b, paths in entry["parts"].items() if len(paths) > 1 or b in entry["deletes"]]
        if touched:
            stage.rewrite(name, self._rows(entry, touched), touched)
        return stage.commit()

    def vacuum(self, keep: int = 2, older_than_hours: float = 24.0) -> list[str]:
        """Removes the folders that none of the last ``keep`` versions names, and the older
        commits. Folders younger than ``older_than_hours`` may belong to a running change
        and stay."""
        numbers = self.log.numbers()
        kept = [self.log.get(n) for n in numbers[-keep:]]
        used = {p.split("/")[1] for c in kept for e in c["tables"].values()
                for d in (e["parts"], e["deletes"], e["filters"] or {}) for paths in d.values() for p in paths}
        data = Folder(self.spark, f"{self.root}/data")
        gone = [n for n in data.names() if n not in used and data.age_seconds(n) >= older_than_hours * 3600]
        for number in numbers[:-keep]:  # first, so that no commit names a folder that is gone
            self.log.forget(number)
        for n in gone:
            data.remove(n)
        return gone


class Stage:
    """A change that is not yet published."""

    def __init__(self, store: VersionedTables, base: int, manifest: dict):
        self.store, self.base, self.folder = store, base, f"data/{uuid.uuid4().hex}"
        self.manifest = json.loads(json.dumps(manifest))
        self.changed = False

    def path(self, name: str) -> str:
        return self.store._path(f"{self.folder}/{name}")

    def entry(self, name: str) -> dict:
        if name not in self.manifest:
            raise KeyError(f"no table {name} in version {self.base}")
        return self.manifest[name]

    def write(self, name: str, df: DataFrame, layout: Layout = Layout()) -> None:
        """All rows of a table."""
        self.manifest[name] = {"schema": df.schema.json(), "key": layout.key, "buckets": layout.buckets,
                               "partition_by": list(layout.partition_by), "parts": {}, "deletes": {},
                               "filters": {} if layout.filters and layout.buckets else None}
        self.manifest[name]["parts"] = self._write(name, df, self.manifest[name])
        self._write_filters(name, name, [])
        self.changed = True

    def adopt(self, name: str, schema: T.StructType) -> None:
        """A table that the caller has written to :meth:`path` itself."""
        self.manifest[name] = {"schema": schema.json(), "key": None, "buckets": 0, "partition_by": [], "deletes": {},
                               "filters": None, "parts": {"": [f"{self.folder}/{name}"]}}
        self.changed = True

    def rewrite(self, name: str, df: DataFrame, buckets: list[str]) -> None:
        """``df`` holds all rows of these buckets from now on."""
        entry = self.entry(name)
        new = self._write(name, df, entry)
        for b in buckets:
            entry["parts"].pop(b, None)
            entry["deletes"].pop(b, None)
        entry["parts"] |= new
        self._write_filters(name, name, buckets)
        self.changed = True

    def append(self, name: str, df: DataFrame) -> None:
        """Further rows, in folders of their own."""
        entry = self.entry(name)
        for b, paths in self._write(f"{name}-more", df.select(*[F.col(f"`{c}`") for c in self._names(name)]), entry).items():
            entry["parts"][b] = entry["parts"].get(b, []) + paths
        self._write_filters(name, f"{name}-more", [])
        self.changed = True

    def upsert(self, name: str, batch: DataFrame, update_cols: list[str], order_by: list[str]) -> None:
        """``sinks.dml.upsert`` of the batch. Buckets without a key of the batch are neither
        read nor written; an empty batch changes nothing."""
        entry, field = self.entry(name), self._key(name)
        key = F.col(f"`{field.name}`")
        batch = stored(batch.withColumn(field.name, key.cast(field.dataType)), "upsert-batch")
        known, unknown = batch.filter(key.isNotNull()), batch.filter(key.isNull())
        touched = self._buckets_of(name, known)
        if touched:
            self.rewrite(name, dml.upsert(self.store._rows(entry, touched), known, field.name, update_cols, order_by), touched)
        if not unknown.isEmpty():  # they never conflict
            self.append(name, unknown)

    def insert_if_absent(self, name: str, batch: DataFrame, order_by: list[str]) -> None:
        """Appends the rows whose keys the table lacks (``sinks.dml.new_rows_if_absent``);
        only the buckets of the batch's keys are read."""
        entry, field = self.entry(name), self._key(name)
        batch = stored(batch.withColumn(field.name, F.col(f"`{field.name}`").cast(field.dataType)), "insert-batch")
        touched = self._buckets_of(name, batch.filter(F.col(f"`{field.name}`").isNotNull()))
        new = stored(dml.new_rows_if_absent(self.store._rows(entry, touched), batch, field.name, order_by), "insert-new")
        if not new.isEmpty():
            self.append(name, new)

    def delete(self, name: str, keys: DataFrame | object) -> None:
        """``DELETE WHERE key = k`` for one value, or for every value of a one-column
        DataFrame. Stores one row per deleted row. Rows without a key stay; without a match
        nothing changes."""
        entry, field = self.entry(name), self._key(name)
        if not isinstance(keys, DataFrame):
            keys = self.store.spark.range(1).select(F.lit(keys).alias(field.name))
        keys = keys.select(F.col(f"`{keys.columns[0]}`").cast(field.dataType).alias(field.name))
        keys = stored(keys.filter(F.col(f"`{field.name}`").isNotNull()).distinct(), "deleted-keys")
        touched = self._buckets_of(name, keys)
        if not touched:
            return
        hit = self.store._rows(entry, touched, places=True).join(keys, field.name, "left_semi")
        (hit.select(self._bucket(name).alias(BUCKET), "_file", "_row")
         .write.partitionBy(BUCKET).parquet(self.path(f"{name}-deletes")))
        for b, paths in self._folders(f"{name}-deletes").items():
            entry["deletes"][b] = entry["deletes"].get(b, []) + paths
            self.changed = True

    def _names(self, name: str) -> list[str]:
        return T.StructType.fromJson(json.loads(self.entry(name)["schema"])).names

    def _key(self, name: str) -> T.StructField:
        entry = self.entry(name)
        if not entry["buckets"]:
            raise ValueError(f"{name} was published without a key and buckets")
        return T.StructType.fromJson(json.loads(entry["schema"]))[entry["key"]]

    def _bucket(self, name: str) -> Column:
        """Bucket of a row that has a key."""
        entry = self.entry(name)
        return F.pmod(F.xxhash64(F.col(f"`{entry['key']}`")), F.lit(entry["buckets"])).cast("int")

    def _buckets_of(self, name: str, keyed: DataFrame) -> list[str]:
        """Buckets of the keys: at most as many rows as the table has buckets."""
        return sorted(str(r[0]) for r in keyed.select(self._bucket(name)).distinct().collect())

    def _write(self, name: str, df: DataFrame, entry: dict) -> dict[str, list[str]]:
        """Bucket -> folders of the rows written to the stage."""
        if not entry["buckets"]:
            writer = df.write.partitionBy(*entry["partition_by"]) if entry["partition_by"] else df.write
            writer.parquet(self.path(name))
            return {"": [f"{self.folder}/{name}"]}
        n, key = entry["buckets"], F.col(f"`{entry['key']}`")
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])  # a missing key may be frequent
        bucket = F.pmod(F.when(key.isNull(), spread).otherwise(F.xxhash64(key)), F.lit(n)).cast("int")
        (df.withColumn(BUCKET, bucket).repartitionById(n, F.col(BUCKET))
         .sortWithinPartitions(BUCKET, key).write.partitionBy(BUCKET).parquet(self.path(name)))
        return self._folders(name)

    def _write_filters(self, name: str, written: str, replaced: list[str]) -> None:
        """The key filters of the folders just written; those of replaced buckets go."""
        entry = self.entry(name)
        if entry["filters"] is None:
            return
        for b in replaced:
            entry["filters"].pop(b, None)
        if self._folders(written):
            key = self._key(name)
            keys = self.store.spark.read.schema(T.StructType([key, T.StructField(BUCKET, T.IntegerType())])).parquet(self.path(written))
            filter_words(keys.select(F.col(f"`{key.name}`").alias("key"), BUCKET), BUCKET).write.partitionBy(BUCKET).parquet(
                self.path(f"{written}-keys"))
            for b, paths in self._folders(f"{written}-keys").items():
                entry["filters"][b] = entry["filters"].get(b, []) + paths

    def _folders(self, name: str) -> dict[str, list[str]]:
        found = Folder(self.store.spark, self.path(name)).names()
        return {n.split("=")[1]: [f"{self.folder}/{name}/{n}"] for n in found if n.startswith(f"{BUCKET}=")}

    def tables(self) -> dict[str, DataFrame]:
        """Every table as it will be."""
        return self.store._frames(self.manifest)

    def commit(self, check: Check | None = None) -> int:
        """Checks the tables where they lie, then publishes them; the number of the version
        in force. A stage without a change publishes nothing."""
        if not self.changed:
            self.discard()
            return self.base
        try:
            if check is not None:
                check(self.tables())
            self.store.log.add(self.base + 1, {"tables": self.manifest})
        except BaseException:
            self.discard()
            raise
        return self.base + 1

    def discard(self) -> None:
        Folder(self.store.spark, self.store.root).remove(self.folder)
