"""A sliced Parquet table: one folder per load and slice below a folder that one small file names.

A load is written aside, clustered by slice, checked, and then moved into place by one rename; the folders it replaces go
last.  Nothing lists loads or slices but the file system, so reading prunes by Spark's own partition filters.

What a load is about to do stands in one small file, written before its rename and gone after its last removal.
While it stands, readers leave out the load's folder; once that is in place a second file says so, and readers leave out
the replaced folders instead.  So a reader sees the rows before or after a load, never both.  A load that dies before the
first file leaves the table as it was; one that dies later is completed when a writer next opens the table.  One writer at
a time per table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.keyed import duplicate_keys, require_unique
from millrace.sources import files
from millrace.sources.feeds import ControlTotalError

NULL_SLICE = "__HIVE_DEFAULT_PARTITION__"
POINTER, INTENT, PLACED = "table.json", "intent.json", "placed.json"


class SliceTable:
    """``slice_by`` is the column that says which slice a row belongs to.

    The schema is stored with the pointer, so a table that exists can be opened without it.  Opening it as a writer completes
    a load that died; ``reading`` opens it beside a live writer.  ``on_step`` is called after every change of the file system
    that a load makes, with its name; tests raise there.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None, slice_by: str, reading: bool = False,
                 on_step: Callable[[str], None] = lambda _: None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.on_step = on_step
        if not reading:
            self.recover()
        self.schema = schema or self._stored_schema()
        self.slice_by = slice_by

    def _stored_schema(self) -> T.StructType:
        body = self._pointer()
        if body is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return T.StructType.fromJson(body["schema"])

    # ---- state

    def _pointer(self) -> dict | None:
        path = f"{self.path}/{POINTER}"
        return files.read_json(self.spark, path) if files.exists(self.spark, path) else None

    def _point(self, folder: str) -> None:
        files.publish_json(self.spark, f"{self.path}/{POINTER}", {"schema": self.schema.jsonValue(), "folder": folder}, replace=True)

    def exists(self) -> bool:
        return self._pointer() is not None

    def _folder(self) -> str | None:
        body = self._pointer()
        return f"{self.path}/{body['folder']}" if body else None

    def _placed(self, folder: str) -> list[tuple[str, str]]:
        """(slice, its path) of every load, from the names of folders."""
        return [(unquote(name.split("=", 1)[1]), f"{folder}/{load}/{name}")
                for load in files.child_names(self.spark, folder)
                for name in files.child_names(self.spark, f"{folder}/{load}") if "=" in name]

    def slices(self) -> set[str]:
        folder = self._folder()
        return {value for value, _ in self._seen(folder)} if folder else set()

    # ---- loads that have begun

    def _begun(self) -> tuple[dict | None, bool]:
        """What a load has announced, if it is not done, and whether all its folders are in place."""
        for name in (PLACED, INTENT):
            if files.exists(self.spark, f"{self.path}/{name}"):
                return files.read_json(self.spark, f"{self.path}/{name}"), name == PLACED
        return None, False

    def _seen(self, folder: str) -> list[tuple[str, str]]:
        """As ``_placed``, without the folders of an unfinished load or those that a placed one replaces."""
        load, placed = self._begun()
        out = self._placed(folder)
        if load is None:
            return out
        hidden = {f"{self.path}/{f}" for f in (load["replaced"] if placed else [load["load"]])}
        return [(value, path) for value, path in out if path not in hidden and path.rsplit("/", 1)[0] not in hidden]

    def recover(self) -> None:
        """Complete the load that died after it announced itself; without one nothing happens."""
        load, placed = self._begun()
        if load is not None:
            self._roll(load, placed)

    def _roll(self, load: dict, placed: bool) -> None:
        if not placed:
            waiting = f"{self.path}/{load['aside']}/{load['load'].rsplit('/', 1)[1]}"
            if load["any"] and files.exists(self.spark, waiting):
                files.move(self.spark, waiting, f"{self.path}/{load['load']}")
                self.on_step("moved")
            files.publish_json(self.spark, f"{self.path}/{PLACED}", load)
            self.on_step("placed")
        for target in load["replaced"]:
            files.remove(self.spark, f"{self.path}/{target}")
            files.remove_if_empty(self.spark, f"{self.path}/{target.rsplit('/', 1)[0]}")
            self.on_step("removed")
        files.remove(self.spark, f"{self.path}/{load['aside']}")
        files.remove(self.spark, f"{self.path}/{INTENT}")
        self.on_step("forgotten")
        files.remove(self.spark, f"{self.path}/{PLACED}")

    def _slice_text(self) -> Column:
        return F.coalesce(F.col(self.slice_by).cast("string"), F.lit(NULL_SLICE))

    # ---- reading

    def read(self, slices: Iterable[str] | None = None) -> DataFrame:
        """The table's rows; with ``slices`` only those folders are opened."""
        folder = self._folder()
        if folder is None:
            return self._no_rows()
        if slices is None and self._begun()[0] is None:
            return self._frame(folder)
        chosen = None if slices is None else set(slices)
        paths = [path for value, path in self._seen(folder) if chosen is None or value in chosen]
        return self._frame(folder, *paths) if paths else self._no_rows()

    def _no_rows(self) -> DataFrame:
        """A frame that the optimizer knows to be empty; one made of a Python list would start Python workers."""
        names = [f.name for f in self.schema.fields]
        nulls = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {name}" for f, name in zip(self.schema.fields, _quoted(names))]
        return self.spark.range(0).selectExpr(*nulls).limit(0)

    def _frame(self, folder: str, *paths: str) -> DataFrame:
        fields = T.StructType(list(self.schema.fields) + [T.StructField("load", T.StringType())])
        reader = self.spark.read.schema(fields).option("basePath", folder)
        # As text, since a name as a column costs several calls to the JVM and this is read often.
        return reader.parquet(*(paths or [folder])).selectExpr(*_quoted(self.schema.names))

    # ---- writing

    def commit(self, df: DataFrame, replacing: Iterable[str] = (), batch: str | None = None,
               order_by: Sequence[str] = (),
               guard: Callable[[set[str], DataFrame], None] | None = None, cluster: bool = True) -> None:
        """Add the rows of ``df`` and drop the earlier rows of the slices in ``replacing``.

        ``batch`` names the load: committing it again replaces all that it wrote.  ``guard`` sees the
        written slices and rows and may raise before they are moved into place.  Without ``cluster`` rows are written by
        the tasks that made them: right for rows of one slice, which need not be brought together.
        """
        self.stage(df, replacing, batch, order_by, guard, cluster).publish()

    def stage(self, df: DataFrame, replacing: Iterable[str] = (), batch: str | None = None, order_by: Sequence[str] = (),
              guard: Callable[[set[str], DataFrame], None] | None = None, cluster: bool = True) -> Staged:
        """As ``commit``, but the rows are only written: publish the result to place them, or discard it."""
        self.recover()
        aside, load = self._aside(df, batch, order_by, cluster)
        made = self._placed(f"{self.path}/{aside}")
        if guard is not None:
            guard({value for value, _ in made}, self._frame(f"{self.path}/{aside}"))
        folder, named = self._folder(), set(replacing)
        data = folder.rsplit("/", 1)[1] if folder else f"data-{uuid.uuid4().hex}"
        same = (lambda path: path.split("/")[-2].rsplit("~", 1)[0] == load.rsplit("~", 1)[0]) if batch else (lambda _: False)
        return Staged(self, {
            "aside": aside, "load": f"{data}/{load}", "any": bool(made),
            "replaced": [f"{data}/{'/'.join(path.split('/')[-2:])}" for value, path in (self._placed(folder) if folder else ())
                         if value in named or same(path)]}, None if folder else data, named if batch is None else None)

    def _aside(self, df: DataFrame, batch: str | None, order_by: Sequence[str], cluster: bool = True) -> tuple[str, str]:
        """Write the rows where no reader looks; the folder, and the load's own one in it, which no other attempt has."""
        aside, load = f"aside/{uuid.uuid4().hex}", f"load={quote(batch or '', safe='')}~{uuid.uuid4().hex}"
        rows = df.selectExpr(*_quoted(self.schema.names))
        (clustered(rows, self.slice_by, order_by) if cluster else rows).write.partitionBy(self.slice_by).parquet(f"{self.path}/{aside}/{load}")
        self.on_step("written")
        return aside, load

    def append(self, df: DataFrame, batch: str | None = None) -> None:
        self.commit(df, (), batch)

    def replace_slices(self, df: DataFrame, slices: Iterable[str], order_by: Sequence[str] = (),
                       expected_rows: int | None = None, cluster: bool = True,
                       require: Callable[[DataFrame], None] | None = None) -> None:
        """``stage_slices``, published at once."""
        self.stage_slices(df, slices, order_by, expected_rows, cluster, require).publish()

    def stage_slices(self, df: DataFrame, slices: Iterable[str], order_by: Sequence[str] = (),
                     expected_rows: int | None = None, cluster: bool = True,
                     require: Callable[[DataFrame], None] | None = None) -> Staged:
        """Idempotent reload: the named slices hold exactly the rows of ``df``, even none.

        ``expected_rows`` is a control total, compared with what was written (a footer count).  ``require`` sees the written
        rows and may raise before they are moved into place.
        """
        named = set(slices)

        def guard(written: set[str], rows: DataFrame) -> None:
            if not written <= named:
                raise ValueError(f"rows outside the reloaded slices: {sorted(written - named)}")
            if expected_rows is not None and rows.count() != expected_rows:
                raise ControlTotalError(f"{self.path}: wrote {rows.count()} rows, expected {expected_rows}")
            if require is not None:
                require(rows)

        return self.stage(df, named, None, order_by, guard, cluster)

    def overwrite(self, df: DataFrame, order_by: Sequence[str] = ()) -> None:
        """Create or replace the whole table: a new folder, then the pointer; the old folder goes last."""
        self.recover()
        was, folder = self._folder(), f"data-{uuid.uuid4().hex}"
        aside, _ = self._aside(df, None, order_by)
        files.move(self.spark, f"{self.path}/{aside}", f"{self.path}/{folder}")
        self._point(folder)
        if was:
            files.remove(self.spark, was)

    def touched_slices(self, source: DataFrame, keys: Sequence[str], slice_of_key: bool = False) -> set[str]:
        """Slices a keyed merge must rewrite: those of the source and those holding its keys.

        ``slice_of_key`` says that a key never changes its slice, as with a bucket of the key or a creation date: then the
        source alone tells.  Otherwise the key and slice columns of the table are read.  One entry per slice.
        """
        return {r["slice"] for r in self._touched(source, keys, slice_of_key).collect()}

    def _touched(self, source: DataFrame, keys: Sequence[str], slice_of_key: bool) -> DataFrame:
        named = source.select(self._slice_text().alias("slice"))
        if not slice_of_key:
            offered = source.select(*keys).dropna().distinct()
            named = named.union(self.read().join(offered, list(keys), "left_semi").select(self._slice_text().alias("slice")))
        return named.distinct()

    def merge(self, source: DataFrame, keys: Sequence[str],
              combine: Callable[[DataFrame, DataFrame], DataFrame], order_by: Sequence[str] = (),
              slice_of_key: bool = False) -> None:
        """``stage_merge``, published at once."""
        self.stage_merge(source, keys, combine, order_by, slice_of_key).publish()

    def stage_merge(self, source: DataFrame, keys: Sequence[str],
                    combine: Callable[[DataFrame, DataFrame], DataFrame], order_by: Sequence[str] = (),
                    slice_of_key: bool = False) -> Staged:
        """Rewrite the touched slices as ``combine(their rows, source)``.

        The merged rows are written before the old ones go, so reading and rewriting the same slices is safe.  The
        source is written once first, because it is read several times; one with repeated keys is refused.
        """
        self.recover()
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        source.write.parquet(staged)
        held = self.spark.read.schema(source.schema).parquet(staged)
        # The touched slices and whether a key comes twice, asked in one query.
        clash = duplicate_keys(held, keys).limit(1).select(F.lit(None).cast("string").alias("slice"))
        found = self._touched(held, keys, slice_of_key).select("slice", F.lit(False).alias("clash")).union(clash.select("slice", F.lit(True))).collect()
        if any(r["clash"] for r in found):
            require_unique(held, keys)
        touched = {r["slice"] for r in found}
        made = self.stage(combine(self.read(touched), held), touched, None, order_by)
        files.remove(self.spark, staged)
        return made

    def file_profile(self) -> DataFrame:
        """Path, size and rows of each file of the table."""
        return file_profile(self.spark.read.parquet(self._folder()))


class Staged:
    """Rows written beside a table, and the folders they will replace."""

    def __init__(self, table: SliceTable, load: dict, first_folder: str | None, slices: set[str] | None):
        self.table, self.load, self.first_folder = table, load, first_folder
        self.slices = slices  # those that are replaced whole, if no other folders are

    def written(self) -> DataFrame:
        """The rows that were written, without those of the table beside them."""
        return self.table._frame(f"{self.table.path}/{self.load['aside']}")

    def read(self, slices: Iterable[str] | None = None) -> DataFrame:
        """The table's rows as they will be once this is published."""
        table, folder = self.table, self.table._folder()
        out = table._frame(f"{table.path}/{self.load['aside']}") if self.load["any"] else table._no_rows()
        if folder and self.slices is not None:  # one listing, and partition filters
            out = out.unionByName(table._frame(folder).where(~table._slice_text().isin(sorted(self.slices))))
        elif folder:
            gone = {f"{table.path}/{path}" for path in self.load["replaced"]}
            kept = [path for _, path in table._seen(folder) if path not in gone]
            out = out.unionByName(table._frame(folder, *kept)) if kept else out
        return out if slices is None else out.where(table._slice_text().isin(sorted(set(slices))))

    def publish(self) -> None:
        """Place the rows; a table that did not exist appears with all of them."""
        table = self.table
        if self.first_folder is not None:
            files.move(table.spark, f"{table.path}/{self.load['aside']}", f"{table.path}/{self.first_folder}")
            table.on_step("moved")
            table._point(self.first_folder)
            return
        files.publish_json(table.spark, f"{table.path}/{INTENT}", self.load)
        table.on_step("announced")
        table._roll(self.load, False)

    def discard(self) -> None:
        files.remove(self.table.spark, f"{self.table.path}/{self.load['aside']}")


def file_profile(df: DataFrame) -> DataFrame:
    """Path, size and rows of every file a file-based frame reads."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
    ).agg(F.count(F.lit(1)).alias("record_count"))


def field_bytes(df: DataFrame) -> DataFrame:
    """Bytes of text per column, as a map aggregated once and then spread into rows."""
    sizes = df.agg(*[F.sum(F.octet_length(F.col(c).cast("string"))).alias(c) for c in df.columns])
    as_map = F.create_map(*[part for c in df.columns for part in (F.lit(c), F.col(c).cast("bigint"))])
    return (
        sizes.select(F.explode(as_map).alias("field", "bytes"))
        .groupBy("field").agg(F.sum("bytes").alias("total_bytes"))
    )


def _quoted(names: Iterable[str]) -> list[str]:
    return ["`" + name.replace("`", "``") + "`" for name in names]


def clustered(df: DataFrame, slice_by: str, order_by: Sequence[str]) -> DataFrame:
    """Rows brought together by slice and ordered inside it, ready to write.

    Rebalancing merges small slices into one task and splits a slice larger than the advisory
    partition size over several, whatever its share of the table.
    """
    return df.hint("rebalance", slice_by).sortWithinPartitions(slice_by, *order_by)
