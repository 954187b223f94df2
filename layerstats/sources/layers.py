"""Layered tables: where they live, how they are written and read.

Each version of a table has a folder of its own, ``base/layer/name/_versions/id``, that
is never changed once it is written. Which one is current is said in two places, each
changed at once: by an empty file ``base/layer/name/_current-number-id``, of which the
highest number counts, for who reads by path; and by the location in the catalog.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from layerstats.sources.shared import file_system, list_names, put_file, read_file, remove_dir

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
VERSIONS, CURRENT, SWITCHING = "_versions", "_current-", "_switching"
#: Endings of the names of catalog entries that come and go during a switch.
NEXT, LAST = "__next", "__last"


@dataclass(frozen=True)
class LayerConfig:
    """Tables live at ``base/layer/name`` and in the catalog as ``[database.]name``.

    ``provider`` is any file-based table format on the cluster. ``parquet`` and
    ``orc`` come with Spark; a new version is written beside the old one and
    becomes the current one when it is complete. ``delta`` has versions of its own
    where its package is installed.
    """

    base: str
    provider: str = "parquet"
    database: str | None = None

    def path(self, layer: str, name: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{name}"

    def table(self, name: str) -> str:
        return f"`{self.database}`.`{name}`" if self.database else f"`{name}`"


@dataclass(frozen=True)
class Staged:
    """A table that is written in full but not yet current."""

    cfg: LayerConfig
    layer: str
    name: str
    written: str
    columns: tuple[tuple[str, str], ...]
    partition_by: tuple[str, ...]

    @property
    def path(self) -> str:
        return self.cfg.path(self.layer, self.name)

    @property
    def version(self) -> str:
        return self.written.rsplit("/", 1)[-1]

    def ordered(self) -> list[tuple[str, str]]:
        """Partition columns come last, as a table that was written has them."""
        return sorted(self.columns, key=lambda c: c[0] in self.partition_by)


def stage(
    df: DataFrame,
    cfg: LayerConfig,
    layer: str,
    name: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    move: bool = False,
) -> Staged:
    """Write a new version of a layer's table that is not yet the current one; see :func:`publish`."""
    spark, path, table = df.sparkSession, cfg.path(layer, name), cfg.table(name)
    recover(spark, cfg, layer, name)
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType != "EXTERNAL":
            raise ValueError(f"{table} exists and is not a table published to a path")
        place, home = _described(spark, table)["location"], file_system(spark, path)[1].toString()
        if not move and place != home and not place.startswith(f"{home}/"):
            raise ValueError(f"{table} is published at {place}; move=True takes its name to {path}")
    if partition_by:
        if spark.conf.get("spark.sql.adaptive.enabled") != "true":
            raise ValueError("partition_by needs spark.sql.adaptive.enabled, which splits large partitions")
        df = df.hint("rebalance", *partition_by)
        if sort_by:
            df = df.sortWithinPartitions(*partition_by, *sort_by)
    elif sort_by:
        df = df.orderBy(*sort_by)
    columns = tuple((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    new = path if cfg.provider == "delta" else f"{path}/{VERSIONS}/{uuid.uuid4().hex[:12]}"
    writer = df.write.format(cfg.provider).mode("overwrite")
    if cfg.provider == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(new)
    except Exception:
        if new != path:
            remove_dir(spark, new)
        raise
    return Staged(cfg, layer, name, new, columns, tuple(partition_by))


def publish(
    df: DataFrame,
    cfg: LayerConfig,
    layer: str,
    name: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    move: bool = False,
) -> DataFrame:
    """Replace a layer's table, data and schema, and return it by name.

    The new version is written in full before it becomes the current one, so an error
    leaves the old table as it was, and a plan may read the table it replaces. The
    version before is kept for who still reads it; older ones are removed.

    Without new columns or partitions the switch is one change of the catalog entry's
    location. Otherwise a complete new entry takes over the name, by renaming; the old
    one is put back if that fails, or by :func:`recover` if the process ends meanwhile.

    ``partition_by`` lays the files out by those columns after an adaptive
    rebalance on them: without it every task writes a file per value it meets,
    and with a plain repartition one hot value is one task's work. It is refused
    where adaptive execution is off. Blank text in such a column reads back as
    NULL. ``sort_by`` puts the table in total order, at the price of a range
    shuffle; with ``partition_by``, each file. A table of that name at another
    path is refused unless ``move`` says that the name goes to the new one.
    """
    make = lambda: stage(df, cfg, layer, name, partition_by, sort_by, move)
    return publish_all(df.sparkSession, [make])[0]


def publish_all(spark: SparkSession, staged: Sequence[Callable[[], Staged]]) -> list[DataFrame]:
    """Stage all tables, and only then switch all: after an error, all are as they were.

    What is about to be switched is noted in the folder ``base/_switching`` until all of
    it is, so that a process that ends in between can be undone by :func:`recover`.
    """
    done: list[Staged] = []
    try:
        for make in staged:
            done.append(make())
    except Exception:
        for table in done:
            if table.written != table.path:
                remove_dir(spark, table.written)
        raise
    notes = {}
    for table in done:
        notes.setdefault(table.cfg.base.rstrip("/"), []).append(_note(spark, table))
    places = {base: f"{base}/{SWITCHING}/{uuid.uuid4().hex[:12]}" for base in notes}
    for base, place in places.items():
        put_file(spark, place, json.dumps(notes[base]))
    try:
        for table in done:
            _switch(spark, table)
    except Exception:
        for base, place in places.items():
            _undo(spark, done[0].cfg.provider, notes[base])
            remove_dir(spark, place)
        raise
    for place in places.values():
        remove_dir(spark, place)
    for table in done:
        _tidy(spark, table)
    return [spark.table(table.cfg.table(table.name)) for table in done]


def recover(spark: SparkSession, cfg: LayerConfig, layer: str | None = None, name: str | None = None) -> None:
    """Undo switches that a process began and never ended; publishing does so for its own table first.

    All tables that were to switch together go back together. With ``layer`` and ``name``
    only switches that this table is part of are looked at. Nobody may be publishing
    the tables meanwhile.
    """
    folder = f"{cfg.base.rstrip('/')}/{SWITCHING}"
    for file in list_names(spark, folder):
        notes = json.loads(read_file(spark, f"{folder}/{file}"))
        if name is None or any((note["layer"], note["name"]) == (layer, name) for note in notes):
            _undo(spark, cfg.provider, notes)
            remove_dir(spark, f"{folder}/{file}")
    if name is not None:
        for left in (NEXT, LAST):
            spark.sql(f"drop table if exists {cfg.table(name + left)}")


def read_layer(spark: SparkSession, cfg: LayerConfig, layer: str, name: str) -> DataFrame:
    """Read a layer's table by path, also where the catalog does not know it.

    File formats without a schema of their own type partition columns by their
    values; read by name, they have the types they were written with.
    """
    path = cfg.path(layer, name)
    marks = _marks(spark, path)
    return spark.read.format(cfg.provider).load(f"{path}/{VERSIONS}/{marks[-1][1]}" if marks else path)


# -- one table's switch ---------------------------------------------------------


def _described(spark: SparkSession, table: str) -> dict:
    """What the catalog says about a table."""
    return json.loads(spark.sql(f"describe table extended {table} as json").first()[0])


def _marks(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Numbers and versions that were made current, the current one last."""
    names = [n[len(CURRENT) :].split("-", 1) for n in list_names(spark, path) if n.startswith(CURRENT)]
    return sorted((int(number), version) for number, version in names)


def _mark_file(path: str, number: int, version: str) -> str:
    return f"{path}/{CURRENT}{number:012d}-{version}"


def _note(spark: SparkSession, staged: Staged) -> dict:
    table = staged.cfg.table(staged.name)
    before = _described(spark, table)["location"] if spark.catalog.tableExists(table) else None
    return {
        "layer": staged.layer,
        "name": staged.name,
        "database": staged.cfg.database,
        "path": staged.path,
        "version": staged.version,
        "before": before,
    }


def _create(spark: SparkSession, staged: Staged, table: str) -> None:
    columns = ", ".join(f"`{name}` {kind}" for name, kind in staged.ordered())
    parts = ", ".join(f"`{name}`" for name in staged.partition_by)
    spark.sql(
        f"create table {table} ({columns}) using {staged.cfg.provider}"
        + (f" partitioned by ({parts})" if parts else "")
        + f" location '{staged.written}'"
    )
    if parts:
        spark.catalog.recoverPartitions(table)


def _switch(spark: SparkSession, staged: Staged) -> None:
    cfg, name, path = staged.cfg, staged.name, staged.path
    table = cfg.table(name)
    if cfg.provider == "delta":
        spark.sql(f"drop table if exists {table}")
        spark.sql(f"create table {table} using delta location '{path}'")
        return
    marks = _marks(spark, path)
    put_file(spark, _mark_file(path, marks[-1][0] + 1 if marks else 1, staged.version), "")
    if not spark.catalog.tableExists(table):
        _create(spark, staged, table)
    elif _same_form(spark, staged):
        spark.sql(f"alter table {table} set location '{staged.written}'")
    else:
        _create(spark, staged, cfg.table(name + NEXT))
        spark.sql(f"alter table {table} rename to {cfg.table(name + LAST)}")
        spark.sql(f"alter table {cfg.table(name + NEXT)} rename to {table}")
    spark.catalog.refreshTable(table)


def _same_form(spark: SparkSession, staged: Staged) -> bool:
    """Whether only the location of the catalog entry has to change. Partitions have locations of their own."""
    table = staged.cfg.table(staged.name)
    said = _described(spark, table)
    plain = not staged.partition_by and not said.get("partition_columns") and said.get("provider", "").lower() == staged.cfg.provider.lower()
    columns = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields]
    return plain and columns == list(staged.columns)


def _undo(spark: SparkSession, provider: str, notes: Sequence[dict]) -> None:
    """Make tables what they were before their switch, wherever that stopped. Can itself be repeated."""
    for note in notes:
        if provider == "delta":
            continue
        cfg = LayerConfig("", provider, note["database"])
        table, coming, last = (cfg.table(note["name"] + end) for end in ("", NEXT, LAST))
        if spark.catalog.tableExists(last):
            spark.sql(f"drop table if exists {table}")
            spark.sql(f"alter table {last} rename to {table}")
        elif note["before"] is None:
            spark.sql(f"drop table if exists {table}")
        elif _described(spark, table)["location"] != note["before"]:
            spark.sql(f"alter table {table} set location '{note['before']}'")
        spark.sql(f"drop table if exists {coming}")
        if spark.catalog.tableExists(table):
            spark.catalog.refreshTable(table)
        for number, version in _marks(spark, note["path"]):
            if version == note["version"]:
                remove_dir(spark, _mark_file(note["path"], number, version))
        remove_dir(spark, f"{note['path']}/{VERSIONS}/{note['version']}")


def _tidy(spark: SparkSession, staged: Staged) -> None:
    """Remove what only switching needed, and all versions but the current one and the one before."""
    if staged.cfg.provider == "delta":
        return
    spark.sql(f"drop table if exists {staged.cfg.table(staged.name + LAST)}")
    marks = _marks(spark, staged.path)
    for number, version in marks[:-2]:
        remove_dir(spark, _mark_file(staged.path, number, version))
        remove_dir(spark, f"{staged.path}/{VERSIONS}/{version}")
