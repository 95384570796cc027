"""A keyed store of Parquet tables: posts, comments, entities and progress, with merges that rewrite what they touch.

Rows lie in buckets by a hash of their key. A bucket has base files and, after merges, files of changes: rows that are
newer than the base's rows with the same keys. A merge writes the changes of the buckets that its rows fall in; a bucket
whose changes have grown to a part of its base is written anew, so that reads stay scans and what a merge writes follows
what it brings. Readers see a bucket's base without the keys of its changes, and the changes.

Manifests, small numbered JSON files, name the files of each bucket; the highest number counts. A manifest is published
by giving a finished file the next number's name, which fails if another writer has that number: then the change starts
again from the new state, and nothing is lost. So readers see all tables before a change or all after it, and a change
that stops half-way leaves files that `vacuum` takes away. That needs an atomic create or rename (local disks, HDFS).
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_s, _l, _d, _i = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()
SCHEMAS = {
    "entities": {"id": _s, "last_name": _s, "first_name": _s, "campus": _s},
    "posts": {"post_id": _s, "title": _s, "campus": _s, "course": _s, "professor_id": _s, "url": _s, "score": _l, "num_comments": _l, "created_utc": _d, "author": _s, "selftext": _s, "scraped_at": _d, "is_review": _i},
    "comments": {"comment_id": _s, "post_id": _s, "parent_id": _s, "author": _s, "body": _s, "score": _l, "created_utc": _d, "depth": _i, "scraped_at": _d, "is_review": _i},
    "progress": {"task": _s, "state": _s, "attempt": _i, "at": _d},
}
KEYS = {"entities": "id", "posts": "post_id", "comments": "comment_id", "progress": "task"}
#: What a column that an older table lacks is filled with.
DEFAULTS = {"is_review": 1, "score": 0, "num_comments": 0, "depth": 0, "selftext": ""}
#: Of several new rows with one key the one with the greatest of these counts.
LATEST = ["scraped_at", "created_utc"]

#: The layout that this library writes. Older ones are brought up to it once, step by step: see `migrate`.
SCHEMA = 3
LEAST_BUCKETS, BUCKET_BYTES = 16, 128 << 20
#: A bucket is written anew when its changes have more than this part of its base's bytes.
REWRITE_AT = 0.25
TRIES = 8


class Conflict(RuntimeError):
    """Another writer published first."""


def schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(c, t) for c, t in SCHEMAS[name].items()])


def conform(df: DataFrame, name: str) -> DataFrame:
    """The table's columns in order; absent ones with their default or null."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(DEFAULTS.get(c))).cast(t).alias(c) for c, t in SCHEMAS[name].items()])


def first_by(rows: DataFrame, key: str, order: list) -> DataFrame:
    """Of rows with one key the first."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__r = 1").drop("__r")


def insert_absent(old: DataFrame, new: DataFrame, key: str, order: list) -> DataFrame:
    """Insert if absent: what is there stays; of new rows with one key the first counts."""
    return old.unionByName(first_by(new, key, order).join(old.select(key), key, "left_anti"))


def replace_by_key(old: DataFrame, new: DataFrame, key: str, order: list) -> DataFrame:
    """Replace by key: new rows win whole; of those with one key the first in order counts."""
    last = first_by(new, key, order)
    return old.join(last.select(key), key, "left_anti").unionByName(last)


def unseen(rows: DataFrame, stored: DataFrame, key: str = "post_id") -> DataFrame:
    """Rows whose key isn't stored yet."""
    return rows.join(stored.select(key), key, "left_anti")


def latest(name: str) -> list[Column]:
    """The order of rows of one key: the last scraped first."""
    return [F.desc(c) for c in LATEST if c in SCHEMAS[name]] or [F.desc("at")]


@dataclass
class Table:
    """The files of a table: by bucket, path to bytes. `changes` are newer than `base`."""

    buckets: int = LEAST_BUCKETS
    base: dict[int, dict[str, int]] = field(default_factory=dict)
    changes: dict[int, dict[str, int]] = field(default_factory=dict)

    def bytes(self) -> int:
        return sum(n for part in (self.base, self.changes) for files in part.values() for n in files.values())

    def paths(self) -> set[str]:
        return {f for part in (self.base, self.changes) for files in part.values() for f in files}

    def as_json(self) -> dict:
        return {"buckets": self.buckets, "base": self.base, "changes": self.changes}

    @staticmethod
    def of(x: dict) -> Table:
        files = lambda part: {int(b): f for b, f in x[part].items()}
        return Table(x["buckets"], files("base"), files("changes"))


@dataclass
class Change:
    """New rows of a table. replace: they take the place of rows with their keys. insert: those whose keys aren't there
    are added. rewrite: they are the table now."""

    name: str
    rows: DataFrame
    how: str = "replace"


class Snapshot:
    """The store's tables as one manifest has them."""

    def __init__(self, store: Store, number: int, manifest: dict):
        self.store, self.number, self.manifest = store, number, manifest
        self.tables = {n: Table.of(t) for n, t in manifest.get("tables", {}).items()}

    def exists(self, name: str) -> bool:
        return name in self.tables

    def read(self, name: str, only: set[int] | None = None) -> DataFrame:
        """The table, or its rows of some buckets, in the declared schema; an empty table where there is none."""
        t = self.tables.get(name, Table())
        inside = lambda files, dirty: [f for b, fs in sorted(files.items()) if (only is None or b in only) and (b in t.changes) == dirty for f in fs]
        clean = self.store.scan(name, inside(t.base, False))
        changes = inside(t.changes, True)
        if not changes:
            return clean
        new, key = self.store.scan(name, changes), KEYS[name]
        old = self.store.scan(name, inside(t.base, True)).join(new.select(key), key, "left_anti")
        return clean.unionByName(old).unionByName(new)


class Store:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    # --- files -------------------------------------------------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def scan(self, name: str, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema(name))
        return self.spark.read.schema(schema(name)).parquet(*[f"{self.folder}/{f}" for f in files])

    def _files(self, folder: str) -> dict[str, tuple[int, float]]:
        """Data files below a folder of the store: path to bytes and time of change."""
        top, fs = self._fs(f"{self.folder}/{folder}" if folder else self.folder)
        if not fs.exists(top):
            return {}
        root, out, it = self._fs(self.folder)[1].makeQualified(self._fs(self.folder)[0]).toString(), {}, fs.listFiles(top, True)
        while it.hasNext():
            f = it.next()
            if f.getPath().getName().endswith(".parquet"):
                out[f.getPath().toString()[len(root) + 1 :]] = (f.getLen(), f.getModificationTime() / 1000)
        return out

    def put(self, name: str, rows: DataFrame, buckets: int) -> dict[int, dict[str, int]]:
        """Writes rows by bucket; their files, which no manifest names yet."""
        folder = f"{name}-{uuid.uuid4().hex}"
        bucket = F.pmod(F.xxhash64(KEYS[name]), F.lit(buckets)).cast("int")
        conform(rows, name).withColumn("bucket", bucket).repartition(F.col("bucket")).write.partitionBy("bucket").parquet(f"{self.folder}/{folder}")
        out: dict[int, dict[str, int]] = {}
        for path, (size, _) in self._files(folder).items():
            out.setdefault(int(re.search(r"/bucket=(\d+)/", path)[1]), {})[path] = size
        return out

    # --- manifests ---------------------------------------------------------------------------------------------------

    def _manifests(self) -> list[int]:
        """Numbers of the manifests, ascending."""
        folder, fs = self._fs(self.folder)
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"manifest-(\d{12})\.json", n)))

    def _at(self, number: int) -> str:
        return f"{self.folder}/manifest-{number:012d}.json"

    def _load(self, number: int) -> dict:
        p, fs = self._fs(self._at(number))
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def snapshot(self) -> Snapshot:
        """The newest state, brought up to this library's layout if it is older."""
        numbers = self._manifests()
        if not numbers:
            return Snapshot(self, 0, {"schema": SCHEMA})
        manifest = self._load(numbers[-1])
        return Snapshot(self, numbers[-1], manifest) if manifest.get("schema") == SCHEMA else self.migrate()

    def exists(self, name: str) -> bool:
        return self.snapshot().exists(name)

    def read(self, name: str) -> DataFrame:
        return self.snapshot().read(name)

    def _publish(self, number: int, manifest: dict) -> None:
        """Gives the manifest its number, or raises Conflict if that is taken."""
        jvm = self.spark.sparkContext._jvm
        (part, fs), (final, _) = self._fs(f"{self.folder}/_part-{uuid.uuid4().hex}"), self._fs(self._at(number))
        out = fs.create(part)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        try:
            if fs.getUri().getScheme() == "file":  # a link is made only where nothing is
                plain = lambda p: jvm.java.nio.file.Paths.get(unquote(urlparse(fs.makeQualified(p).toString()).path), self.spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
                jvm.java.nio.file.Files.createLink(plain(final), plain(part))
                fs.delete(part, False)
            else:  # without the option to overwrite
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
                context.rename(part, final, self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            fs.delete(part, False)
            raise Conflict(f"another writer was first: {self._at(number)}") from e

    # --- changes -----------------------------------------------------------------------------------------------------

    def update(self, plan: Callable[[Snapshot], list[Change]], tries: int = TRIES) -> int:
        """Publishes what `plan` makes of the newest state, all tables at once, and returns the manifest's number.

        If another writer is first, the plan is made again from the new state. No changes publish nothing.
        """
        for left in range(tries - 1, -1, -1):
            snap = self.snapshot()
            tables = dict(snap.tables)
            for change in plan(snap):
                changed = self._changed(snap, change)
                if changed is not None:
                    tables[change.name] = changed
            if all(tables.get(n) is t for n, t in snap.tables.items()) and len(tables) == len(snap.tables):
                return snap.number
            try:
                self._publish(snap.number + 1, snap.manifest | {"schema": SCHEMA, "tables": {n: t.as_json() for n, t in tables.items()}})
                return snap.number + 1
            except Conflict:
                if not left:
                    raise
        raise AssertionError

    def _changed(self, snap: Snapshot, change: Change) -> Table | None:
        """The table after a change, none if nothing changes. Its files are written, and not published."""
        name, key, old = change.name, KEYS[change.name], snap.tables.get(change.name)
        if change.how == "rewrite" or old is None:
            rows = conform(change.rows, name)
            n = max(LEAST_BUCKETS, 1 << (old.bytes() // BUCKET_BYTES).bit_length()) if old else LEAST_BUCKETS
            return Table(n, self.put(name, rows if change.how == "rewrite" else first_by(rows, key, _order(name)), n))
        new = self.put(name, first_by(conform(change.rows, name), key, _order(name)), old.buckets)
        if change.how == "insert" and new:
            fresh = self.scan(name, [f for fs in new.values() for f in fs]).join(snap.read(name, set(new)).select(key), key, "left_anti")
            new = self.put(name, fresh, old.buckets)
        if not new:
            return None
        if old.bytes() > 4 * BUCKET_BYTES * old.buckets:  # grown: more buckets
            return self._changed(snap, Change(name, replace_by_key(snap.read(name), self.scan(name, [f for fs in new.values() for f in fs]), key, _order(name)), "rewrite"))
        size = lambda files: sum(files.values())
        base, changes = dict(old.base), dict(old.changes)
        grown, whole = set(), set()
        for b, files in new.items():
            if b not in base:
                base[b] = files
            elif size(files) + size(changes.get(b, {})) > REWRITE_AT * size(base[b]):
                whole.add(b)
            elif b in changes:
                grown.add(b)
            else:
                changes[b] = files
        some = lambda part, which: [f for b in which for f in part.get(b, {})]
        if grown:
            rows = self.scan(name, some(new, grown))
            changes |= self.put(name, self.scan(name, some(changes, grown)).join(rows.select(key), key, "left_anti").unionByName(rows), old.buckets)
        if whole:
            rows = self.scan(name, some(new, whole))
            base |= self.put(name, snap.read(name, whole).join(rows.select(key), key, "left_anti").unionByName(rows), old.buckets)
            for b in whole:
                changes.pop(b, None)
        return Table(old.buckets, base, changes)

    def write(self, **tables: DataFrame) -> int:
        """The named tables as they are now, all at once. What these were made from may have changed meanwhile: whoever
        reads before writing uses `update`."""
        return self.update(lambda _: [Change(n, df, "rewrite") for n, df in tables.items()])

    def merge(self, posts: DataFrame | None = None, comments: DataFrame | None = None, entities: DataFrame | None = None) -> int:
        """Entities are inserted if absent; posts and comments are replaced by key, which sets is_review back to 1. All
        change together."""
        changes = [Change(n, conform(df, n).withColumn("is_review", F.lit(1))) for n, df in (("posts", posts), ("comments", comments)) if df is not None]
        if entities is not None:
            changes.append(Change("entities", entities, "insert"))
        return self.update(lambda _: changes)

    # --- upkeep ------------------------------------------------------------------------------------------------------

    def migrate(self) -> Snapshot:
        """Brings an older store up to this layout, once: each step is recorded in the manifest. Layout 1 has a folder a
        table, in which columns may be missing that came later; they get their defaults. Layout 2 lacks progress."""
        numbers = self._manifests()
        manifest = self._load(numbers[-1])
        steps = list(manifest.get("steps", []))
        if "schema" not in manifest:
            tables = {}
            for name, folder in manifest.items():
                old = self.spark.read.parquet(f"{self.folder}/{folder}")
                lacking = [c for c in SCHEMAS[name] if c not in old.columns]
                steps.append(f"1: {name} by bucket" + "".join(f", {c} = {DEFAULTS.get(c)}" for c in lacking))
                tables[name] = Table(LEAST_BUCKETS, self.put(name, old, LEAST_BUCKETS)).as_json()
            manifest = {"schema": 2, "tables": tables}
        if manifest["schema"] == 2:
            steps.append("2: progress")
            manifest["tables"].setdefault("progress", Table().as_json())
        try:
            self._publish(numbers[-1] + 1, manifest | {"schema": SCHEMA, "steps": steps})
        except Conflict:  # another one has migrated it
            pass
        return self.snapshot()

    def vacuum(self, keep: int = 10, older_than: float = 86_400.0) -> int:
        """Deletes all but the last manifests, and data files that none of these names and that are older than so many
        seconds: younger ones may be a writer's. The number of files deleted."""
        numbers = self._manifests()
        gone, kept = numbers[: -max(1, keep)], [self._load(n) for n in numbers[-max(1, keep) :]]
        named: set[str] = set()
        folders: set[str] = set()
        for m in kept:
            if "schema" in m:
                named |= {f for t in m["tables"].values() for f in Table.of(t).paths()}
            else:
                folders |= set(m.values())
        n, now = 0, time.time()
        for path, (_, at) in self._files("").items():
            if path not in named and path.partition("/")[0] not in folders and at <= now - older_than:
                p, fs = self._fs(f"{self.folder}/{path}")
                n += bool(fs.delete(p, False))
        for number in gone:
            p, fs = self._fs(self._at(number))
            n += bool(fs.delete(p, False))
        return n


def _order(name: str) -> list:
    """Which of new rows with one key counts: for entities the first by name, else the last scraped."""
    return ["last_name", "first_name", "campus"] if name == "entities" else latest(name)
