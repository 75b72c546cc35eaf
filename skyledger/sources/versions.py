"""Tables of a warehouse folder, published as whole versions.

Data folders are written once and never changed. A *version* is one small manifest that names, for every table, the
folders that make it up; it becomes visible by a single rename that fails if another writer was there first. A reader
resolves the latest manifest once and keeps reading its folders while later versions are published. So a job that is lost
between writing and committing changes nothing, several tables change together or not at all, and a partition or bucket
that a commit does not touch is neither read nor written again.

Layout below the root: ``_manifest/<number>.json`` and ``data/<table>/_v=<id>/<column>=<value>/...``.

A commit whose tables were changed by another one in between raises ``Conflict``; appends and changes of other tables are
carried over to the newer version. A commit with a label that a version already holds is done: nothing is committed
again, so a rerun of the same load gives the same table. ``vacuum`` removes what no kept version names.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import keep_first
from ..operators.incremental import insert_missing, upsert
from .tables import written

BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another commit has changed a table that this one is built on."""


@dataclass(frozen=True)
class Table:
    """What a version says of a table: its schema, the columns its folders are cut by, and the folders."""

    schema: str
    parts: list[str] = field(default_factory=list)
    folders: list[str] = field(default_factory=list)
    keys: list[str] = field(default_factory=list)
    buckets: int = 0

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")


def _part(folder: str) -> str:
    """The partition of a data folder: its path without the version."""
    return folder.partition("/")[2]


def _value(part: str) -> str | None:
    """The text of a partition's value."""
    text = unquote(part.partition("=")[2])
    return None if text == "__HIVE_DEFAULT_PARTITION__" else text


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    # Files ------------------------------------------------------------------------------------

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self):
        return self._path(self.root).getFileSystem(self._conf)

    def _children(self, path: str) -> list:
        fs, at = self._fs(), self._path(path)
        return list(fs.listStatus(at)) if fs.exists(at) else []

    def _read_text(self, path: str) -> str:
        stream = self._fs().open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create(self, path: str, text: str) -> bool:
        """A whole file under a name that nothing has yet; False if another writer has it."""
        hadoop, draft = self._jvm.org.apache.hadoop.fs, f"{self.root}/_manifest/.draft-{uuid.uuid4().hex}"
        stream = self._fs().create(self._path(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        how = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
        how[0] = getattr(hadoop, "Options$Rename").NONE
        context = hadoop.FileContext.getFileContext(self._fs().getUri(), self._conf)
        try:
            context.rename(self._path(draft), self._path(path), how)
        except Exception as failure:
            self._fs().delete(self._path(draft), False)
            if "FileAlreadyExistsException" in str(failure):
                return False
            raise
        return True

    # Versions -----------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self._children(f"{self.root}/_manifest")]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> tuple[int, dict]:
        """Number and content of a version, the latest one if none is named; before the first commit there is 0."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return 0, {"tables": {}, "labels": {}, "progress": {}}
        return version, json.loads(self._read_text(f"{self.root}/_manifest/{version:010d}.json"))

    def table(self, name: str, version: int | None = None) -> Table | None:
        held = self.manifest(version)[1]["tables"].get(name)
        return Table(**held) if held else None

    def holds(self, label: str) -> bool:
        return label in self.manifest()[1]["labels"]

    def progress(self, stream: str) -> int:
        """The last batch that a stream has committed, or -1."""
        return self.manifest()[1]["progress"].get(stream, -1)

    def read(self, name: str, version: int | None = None, where: Callable[[str], bool] | None = None) -> DataFrame:
        """A table as one version has it; ``where`` names the partitions that are read, as ``column=value``."""
        held = self.table(name, version)
        if held is None:
            raise ValueError(f"no table {name} in {self.root}")
        return self._rows(name, held, [f for f in held.folders if where is None or where(_part(f))])

    def _rows(self, name: str, held: Table, folders: list[str]) -> DataFrame:
        schema = held.struct()
        if not folders:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/data/{name}"
        reader = self.spark.read.schema(schema).option("basePath", base)
        return reader.parquet(*[f"{base}/{f}" for f in folders]).select(*schema.names)

    def _stage(self, name: str, df: DataFrame, parts: list[str]) -> list[str]:
        """Write rows to a folder of their own; the folders that hold them, below the table's."""
        version = f"_v={uuid.uuid4().hex}"
        path = f"{self.root}/data/{name}/{version}"
        if parts:
            df.hint("rebalance", *parts).write.partitionBy(*parts).parquet(path)
        else:
            df.write.parquet(path)
        found = [version]
        for _ in parts:
            found = [f"{f}/{s.getPath().getName()}" for f in found for s in self._children(f"{self.root}/data/{name}/{f}") if s.isDirectory()]
        return found

    def begin(self) -> Transaction:
        return Transaction(self)

    def vacuum(self, keep: int = 2, older_than: float = 7 * 24 * 3600) -> int:
        """Forget all but the last ``keep`` versions, and delete data that these do not name and that is older.

        The age keeps what a running job has written and not yet committed. Returns the number of folders deleted.
        """
        known = self.versions()
        for old in known[: max(len(known) - keep, 0)]:
            self._fs().delete(self._path(f"{self.root}/_manifest/{old:010d}.json"), False)
        named = set()
        for version in known[-keep:]:
            for name, held in self.manifest(version)[1]["tables"].items():
                named |= {f"{name}/{f.partition('/')[0]}" for f in held["folders"]}
        gone, limit = 0, (time.time() - older_than) * 1000
        for name in self._names():
            for status in self._children(f"{self.root}/data/{name}"):
                if f"{name}/{status.getPath().getName()}" not in named and status.getModificationTime() <= limit:
                    self._fs().delete(status.getPath(), True)
                    gone += 1
        return gone

    def _names(self, below: str = "") -> list[str]:
        """Tables with data: folders that hold versions."""
        out = []
        for status in self._children(f"{self.root}/data/{below}".rstrip("/")):
            name = status.getPath().getName()
            if name.startswith("_v="):
                return [below]
            out += self._names(f"{below}/{name}".lstrip("/"))
        return out


class Transaction:
    """Changes of some tables, staged one by one and committed together."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse
        self.base, self.content = warehouse.manifest()
        self.changed: dict[str, tuple[bool, Callable[[Table | None], Table]]] = {}
        self.staged: dict[str, Table] = {}
        self.written_folders = 0

    def table(self, name: str) -> Table | None:
        held = self.content["tables"].get(name)
        return self.staged.get(name) or (Table(**held) if held else None)

    def read(self, name: str) -> DataFrame:
        """A table as this transaction sees it."""
        held = self.table(name)
        if held is None:
            raise ValueError(f"no table {name} in {self.warehouse.root}")
        return self.warehouse._rows(name, held, held.folders)

    def _change(self, name: str, change: Callable[[Table | None], Table], free: bool = False) -> None:
        earlier = self.changed.get(name)
        if earlier:
            before, free = earlier[1], free and earlier[0]
            self.changed[name] = (free, lambda held: change(before(held)))
        else:
            self.changed[name] = (free, change)
        self.staged[name] = change(self.table(name))

    def _new(self, df: DataFrame, parts: list[str], folders: list[str]) -> Table:
        return Table(df.schema.json(), parts, folders)

    def replace(self, name: str, df: DataFrame, parts: list[str] | None = None) -> None:
        """The whole table anew."""
        folders = self._write(name, df, parts or [])
        self._change(name, lambda _: self._new(df, parts or [], folders))

    def append(self, name: str, df: DataFrame) -> DataFrame:
        """Add rows; no other append stands in the way. The rows as they were written."""
        held = self.table(name)
        parts = held.parts if held else []
        rows = df if held is None else df.select(*held.struct().names)
        folders = self._write(name, self._bucketed(held, rows), self._cut(held))
        self._change(name, lambda t: Table(**{**asdict(t), "folders": t.folders + folders}) if t else self._new(df, parts, folders), free=True)
        return self.warehouse._rows(name, self.table(name), folders)

    def read_parts(self, name: str, values: list) -> DataFrame:
        """The partitions of these values, as text; no other is listed or read."""
        held, wanted = self.table(name), set(values)
        return self.warehouse._rows(name, held, [f for f in held.folders if _value(_part(f)) in wanted])

    def read_keys(self, name: str, keys: DataFrame) -> DataFrame:
        """The buckets that the keys are in, as whole as they are."""
        held = self.table(name)
        found = {f"{BUCKET}={r[0]}" for r in keys.select(held.bucket().alias(BUCKET)).distinct().collect()}
        return self.warehouse._rows(name, held, [f for f in held.folders if _part(f) in found])

    def replace_parts(self, name: str, df: DataFrame, part: str, values: list | None = None) -> None:
        """The partitions that the rows hold, and those of ``values`` (as text), if need be by none; others stay."""
        held = self.table(name)
        if held is None:
            return self.replace(name, df, [part])
        folders = self._write(name, df.select(*held.struct().names), held.parts)
        touched = {_part(f) for f in folders} | {_part(f) for f in held.folders if values is not None and _value(_part(f)) in values}
        self._change(name, lambda t: Table(**{**asdict(t), "folders": [f for f in t.folders if _part(f) not in touched] + folders}))

    def delete_insert(self, name: str, new: DataFrame, part: str, keys: list[str]) -> None:
        """Replace the partitions that new rows touch, and take their keys out of all others.

        Of the partitions that new rows do not touch only the keys are read, and only those are written again that hold a
        key which moved. New rows without a partition value are added to those that the table has.
        """
        held = self.table(name)
        if held is None:
            return self.replace(name, new, [part])
        new = written(new.select(*held.struct().names), "new-rows")
        target, known = self.read(name), new.select(*keys).distinct()
        elsewhere = target.select(part, *keys).join(new.select(part).distinct(), part, "left_anti")
        moved = elsewhere.join(known, keys, "left_semi").select(part)
        without = new.where(F.col(part).isNull()).select(part)
        disturbed = moved.unionByName(without).distinct().withColumnRenamed(part, "_part")
        others = target.join(disturbed, F.col(part).eqNullSafe(F.col("_part")), "left_semi").join(known, keys, "left_anti")
        gone = {r[0] for r in disturbed.select(F.col("_part").cast("string")).collect()}
        folders = self._write(name, new.unionByName(others.select(*new.columns)), [part])
        # a partition whose last key has moved leaves no folder behind
        touched = {_part(f) for f in folders} | {_part(f) for f in held.folders if _value(_part(f)) in gone}
        self._change(name, lambda t: Table(**{**asdict(t), "folders": [f for f in t.folders if _part(f) not in touched] + folders}))

    def create(self, name: str, schema: str | T.StructType, keys: list[str], buckets: int) -> None:
        """An empty table whose rows are unique by key, cut into buckets by a hash of it."""
        struct = schema if isinstance(schema, T.StructType) else self.warehouse.spark.createDataFrame([], schema).schema
        self._change(name, lambda _: Table(struct.json(), [], [], keys, buckets))

    def merge(self, name: str, new: DataFrame, update: list[str], order: list[Column] | None = None, insert_only: bool = False) -> list[int]:
        """Insert new keys and update the given columns of known ones; only buckets with a new row are read and written.

        With ``insert_only`` known keys stay as they are, and the rows of the others are added without writing a bucket
        again. Returns the buckets that were touched.
        """
        held = self.table(name)
        if held is None or not held.buckets:
            raise ValueError(f"{name} is no table by key")
        names = held.struct().names
        rows = keep_first(new, held.keys, order) if order else new
        rows = written(rows.select(*names, held.bucket().alias(BUCKET)), "new-rows")
        touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
        mine = {f"{BUCKET}={b}" for b in touched}
        old = self.warehouse._rows(name, held, [f for f in held.folders if _part(f) in mine])
        if insert_only:
            added = self._write(name, self._bucketed(held, insert_missing(old, rows.select(*names), held.keys)), [BUCKET])
            self._change(name, lambda t: Table(**{**asdict(t), "folders": t.folders + added}))
            return touched
        folders = self._write(name, self._bucketed(held, upsert(old, rows.select(*names), held.keys, update)), [BUCKET])
        self._change(name, lambda t: Table(**{**asdict(t), "folders": [f for f in t.folders if _part(f) not in mine] + folders}))
        return touched

    def replace_keys(self, name: str, gone: DataFrame, new: DataFrame) -> list[int]:
        """Drop every row with one of the keys in ``gone``, then add rows; a key may have many of them.

        ``gone`` may hold more columns, of which all must be equal. Only buckets of these keys are read and written. Returns the buckets that were touched.
        """
        held = self.table(name)
        if held is None or not held.buckets:
            raise ValueError(f"{name} is no table by key")
        names = held.struct().names
        keys = written(gone.distinct(), "gone-keys")
        rows = written(new.select(*names), "new-rows")
        touched = sorted(r[0] for r in keys.select(*held.keys).unionByName(rows.select(*held.keys)).select(held.bucket().alias(BUCKET)).distinct().collect())
        mine = {f"{BUCKET}={b}" for b in touched}
        old = self.warehouse._rows(name, held, [f for f in held.folders if _part(f) in mine])
        folders = self._write(name, self._bucketed(held, old.join(keys, [old[c].eqNullSafe(keys[c]) for c in keys.columns], "left_anti").select(*names).unionByName(rows)), [BUCKET])
        self._change(name, lambda t: Table(**{**asdict(t), "folders": [f for f in t.folders if _part(f) not in mine] + folders}))
        return touched

    def compact(self, name: str) -> None:
        """The same rows in one folder per partition."""
        held = self.table(name)
        folders = self._write(name, self._bucketed(held, self.read(name)), self._cut(held))
        before = set(held.folders)
        # what others have added since stays beside it
        self._change(name, lambda t: Table(**{**asdict(t), "folders": folders + [f for f in t.folders if f not in before]}), free=True)

    def _cut(self, held: Table | None) -> list[str]:
        return [] if held is None else [BUCKET] if held.buckets else held.parts

    def _bucketed(self, held: Table | None, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, held.bucket()) if held is not None and held.buckets else df

    def _write(self, name: str, df: DataFrame, parts: list[str]) -> list[str]:
        folders = self.warehouse._stage(name, df, parts)
        self.written_folders += len(folders)
        return folders

    def commit(self, label: str | None = None, progress: tuple[str, int] | None = None) -> int:
        """Publish all changes as the next version; the number of the version that holds them.

        ``progress`` is a stream and its batch: batches come in order, so only the last one is kept.
        """
        house = self.warehouse
        while True:
            number, content = house.manifest()
            if label is not None and label in content["labels"]:
                return content["labels"][label]
            if progress is not None and content["progress"].get(progress[0], -1) >= progress[1]:
                return number
            tables = dict(content["tables"])
            for name, (free, change) in self.changed.items():
                now, then = tables.get(name), self.content["tables"].get(name)
                if now != then and not (free and now is not None and (then is None or set(then["folders"]) <= set(now["folders"]))):
                    raise Conflict(f"{name} has changed since version {self.base}")
                tables[name] = asdict(change(Table(**now) if now else None))
            labels = content["labels"] | ({label: number + 1} if label is not None else {})
            done = content["progress"] | ({progress[0]: progress[1]} if progress is not None else {})
            text = json.dumps({"tables": tables, "labels": labels, "progress": done})
            if house._create(f"{house.root}/_manifest/{number + 1:010d}.json", text):
                return number + 1
