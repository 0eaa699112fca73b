"""Files and folders of stored tables, through the path's own Hadoop file system.

Nothing here guesses: a path either exists, or does not, or the question fails
and the error reaches the caller. "Cannot be read" is never "is not there".
"""

from __future__ import annotations

import json
import threading
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Beside a table's folder, hidden from Spark's readers by the underscore: who is replacing partitions, and from what.
SWAP_NOTE = "_keelson_swap_"
#: In a table's folder: its declared schemas, the highest number being the one in force.
SCHEMA_NOTE = "_keelson_schema_"
#: In a table's folder: which partitions' files have which physical columns; one for each call that added some.
LAYOUT_NOTE = "_keelson_layout_"
#: A writer that lives renews its note this often; a note not renewed for LEASE seconds belongs to a dead one.
LEASE = 600.0


class TableBusy(RuntimeError):
    """Another load holds the table, or changed it faster than this one could merge."""


def _note(folder: str) -> str:
    parent, _, name = folder.rstrip("/").rpartition("/")
    return f"{parent}/{SWAP_NOTE}{name}"


def _resolve(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder. False if there was none; an error when it is still there afterwards."""
    fs, p = _resolve(spark, path)
    if not fs.exists(p):
        return False
    if not fs.delete(p, True) and fs.exists(p):
        raise OSError(f"could not delete {path}")
    return True


def holds_data(spark: SparkSession, path: str) -> bool:
    """Does a table folder hold anything but hidden files?"""
    fs, p = _resolve(spark, path)
    if not fs.exists(p):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def _write_new(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> bool:
    """Create a small file. False if it is there already: the file system lets one writer win."""
    fs, p = _resolve(spark, path)
    try:
        out = fs.create(p, overwrite)
    except Py4JJavaError as exc:
        if not overwrite and fs.exists(p):
            return False
        raise exc
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _read_small(spark: SparkSession, path: str) -> str | None:
    fs, p = _resolve(spark, path)
    if not fs.exists(p):
        return None
    into = fs.open(p)
    try:
        return bytes(into.readAllBytes()).decode()
    finally:
        into.close()


def _age(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written or renewed."""
    fs, p = _resolve(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000


class Claim:
    """The right to replace partitions of one table: a note that only one writer can create.

    As a context it is given up at the end; a swap that fails in between leaves the note, marked, for the next load to
    repeat. While it is held a thread renews it, so that a note grown old belongs to a writer that died.
    """

    def __init__(self, spark: SparkSession, folder: str, staged: str | None, added: str | None = None):
        self.spark, self.path = spark, _note(folder)
        self.text = {"owner": uuid.uuid4().hex, "staged": staged, "added": added, "state": "running"}
        self.over = threading.Event()

    def take(self) -> bool:
        if not _write_new(self.spark, self.path, json.dumps(self.text)):
            return False
        threading.Thread(target=self._renew, daemon=True).start()
        return True

    def _renew(self) -> None:
        while not self.over.wait(LEASE / 4):
            fs, p = _resolve(self.spark, self.path)
            fs.setTimes(p, int(time.time() * 1000), -1)

    def give_up(self) -> None:
        self.over.set()
        delete_path(self.spark, self.path)

    def leave(self) -> None:
        """The swap did not end: the next load is to repeat it."""
        self.over.set()
        _write_new(self.spark, self.path, json.dumps({**self.text, "state": "left"}), overwrite=True)


def read_note(spark: SparkSession, folder: str) -> dict | None:
    """Who holds the table: owner, staged (the copy being swapped in, if any), added (the files being appended, if any),
    dead (nobody works on it any more)."""
    text = _read_small(spark, _note(folder))
    if text is None:
        return None
    try:
        note = json.loads(text)
    except ValueError:  # being written just now, or by a writer that died while at it
        note = {"owner": None, "staged": None, "state": "running"}
    try:
        old = _age(spark, _note(folder)) > LEASE
    except Py4JJavaError:
        return None  # given up meanwhile
    return {**note, "dead": note["state"] == "left" or old}


def take_over(spark: SparkSession, folder: str) -> bool:
    """Among several loads that find a dead writer's note, one may finish its swap."""
    path = _note(folder) + "_next"
    if _write_new(spark, path, ""):
        return True
    try:
        if _age(spark, path) > LEASE:
            delete_path(spark, path)
            return _write_new(spark, path, "")
    except Py4JJavaError:
        pass
    return False


def drop_note(spark: SparkSession, folder: str) -> None:
    """After a take-over: the swap is done."""
    delete_path(spark, _note(folder))
    delete_path(spark, _note(folder) + "_next")


def data_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Names and sizes of the data files in one folder: Spark never writes a name twice, so equal lists are equal data."""
    fs, p = _resolve(spark, folder)
    if not fs.exists(p):
        return []
    found = [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(p) if s.isFile()]
    return sorted(f for f in found if not f[0].startswith(("_", ".")))


def files_below(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Full names and sizes of the data files in a folder and the folders below it."""
    fs, p = _resolve(spark, folder)
    if not fs.exists(p):
        return []
    out, found = [], fs.listFiles(p, True)
    while found.hasNext():
        status = found.next()
        if not status.getPath().getName().startswith(("_", ".")):
            out.append((status.getPath().toString(), status.getLen()))
    return out


def move_files(spark: SparkSession, staged: str, folder: str) -> int:
    """Move the data files below one folder to the same places below another, on the same file system.

    A file is moved as a whole, and its name is used once: doing it again moves what is left. Returns how many.
    """
    fs, top = _resolve(spark, staged)
    skip = len(fs.makeQualified(top).toString()) + 1
    names = [name for name, _ in files_below(spark, staged)]
    for name in names:
        to = _resolve(spark, f"{folder}/{name[skip:]}")[1]
        fs.mkdirs(to.getParent())
        if not fs.rename(_resolve(spark, name)[1], to):
            raise OSError(f"could not move {name} to {folder}")
    return len(names)


def declared_schema(spark: SparkSession, folder: str) -> tuple[int, StructType | None]:
    """The schema declared for a stored folder and its number (0: none)."""
    fs, p = _resolve(spark, folder)
    if not fs.exists(p):
        return 0, None
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    numbers = sorted((int(n.removeprefix(SCHEMA_NOTE)) for n in names if n.startswith(SCHEMA_NOTE)), reverse=True)
    for n in numbers:
        text = _read_small(spark, f"{folder}/{SCHEMA_NOTE}{n}")
        try:
            return numbers[0], StructType.fromJson(json.loads(text or ""))
        except ValueError:  # its writer is not done: the one before is in force
            continue
    return numbers[0] if numbers else 0, None


def declare_schema(spark: SparkSession, folder: str, schema: StructType) -> None:
    """Make ``schema`` the folder's. Columns another writer declared meanwhile stay, behind the given ones."""
    while True:
        n, now = declared_schema(spark, folder)
        more = [f for f in (now.fields if now else []) if f.name not in schema.names]
        full = StructType([*schema.fields, *more])
        if now == full or _write_new(spark, f"{folder}/{SCHEMA_NOTE}{n + 1}", full.json()):
            return


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Location").collect()
    if not rows:
        raise ValueError(f"table {table} has no location")
    return rows[0]["data_type"]


def spec_key(partition_cols: Sequence[str], row) -> str:
    """A partition's values as the catalog prints them."""
    return "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if row[c] is None else row[c]}" for c in partition_cols)


def partition_locations(spark, table: str, partition_cols: Sequence[str]) -> dict[str, str]:
    """Where the catalog says that each partition of a table is."""
    jvm, session = spark._jvm, spark._jsparkSession
    name = session.sessionState().sqlParser().parseTableIdentifier(table)
    found = session.sessionState().catalog().listPartitions(name, jvm.scala.Option.empty())
    out = {}
    for i in range(found.size()):
        part = found.apply(i)
        spec = part.spec()
        row = {c: spec.apply(c) for c in partition_cols}
        out[spec_key(partition_cols, row)] = part.location().toString()
    return out


def declare_layout(spark: SparkSession, folder: str, keys: Sequence[str], layout: StructType) -> None:
    """Note the physical columns of some partitions (as ``spec_key`` names them) in a table's folder."""
    note = {"layout": layout.jsonValue(), "partitions": list(keys)}
    _write_new(spark, f"{folder}/{LAYOUT_NOTE}{uuid.uuid4().hex}", json.dumps(note))


def declared_layouts(spark: SparkSession, folder: str) -> dict[str, StructType]:
    """Partition -> its noted physical columns. Two notes that differ about one partition are an error."""
    fs, p = _resolve(spark, folder)
    out: dict[str, StructType] = {}
    for status in fs.listStatus(p) if fs.exists(p) else ():
        name = status.getPath().getName()
        if not name.startswith(LAYOUT_NOTE):
            continue
        note = json.loads(_read_small(spark, f"{folder}/{name}"))
        layout = StructType.fromJson(note["layout"])
        for key in note["partitions"]:
            if out.setdefault(key, layout) != layout:
                raise ValueError(f"two layouts are declared for partition {key} of {folder}")
    return out


def read_stored(spark: SparkSession, path: str, partition_types: StructType) -> DataFrame | None:
    """A partitioned Parquet folder with its partition columns as declared (a hull ``0012`` stays a text).

    Its columns are those of its declared schema, or of all its files together where none was declared: a file that
    lacks a column reads NULL there, and no column is lost because one file happens to lack it. None only where there
    is no table: the folder is missing or holds hidden files alone.
    """
    if not holds_data(spark, path):
        return None
    found = declared_schema(spark, path)[1]
    if found is None:
        found = spark.read.option("mergeSchema", "true").parquet(path).schema
    declared = {f.name: f for f in partition_types.fields}
    schema = StructType([declared.get(f.name, f) for f in found.fields])
    return spark.read.schema(schema).parquet(path)


def add_stored_columns(spark: SparkSession, path: str, columns: StructType, partition_types: StructType) -> None:
    """ALTER TABLE ADD COLUMNS for a Parquet folder: stored rows read NULL there."""
    now = read_stored(spark, path, partition_types)
    if now is None:
        raise ValueError(f"{path} holds no table")
    twice = [f.name for f in columns.fields if f.name in now.columns]
    if twice:
        raise ValueError(f"{path} has columns {twice} already")
    parts = set(partition_types.names)
    plain = [f for f in now.schema.fields if f.name not in parts]
    declare_schema(spark, path, StructType([*plain, *columns.fields, *[f for f in now.schema.fields if f.name in parts]]))
