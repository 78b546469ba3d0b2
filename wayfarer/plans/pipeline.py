"""Batch rebuild of the production tables.

* ``BuildConfig``: where sources are read, where tables are written, name
  prefix/suffix, file format.
* ``Sources``: name -> DataFrame (parquet folder, catalog schema, or the test
  fixtures).
* ``run_pipeline``: checks everything first (inputs present, no output or
  keyed table in the place of an input, checkpoint folder known, ids unique),
  then rebuilds each output table in order.  A table is written beside its
  place and put there when it is complete, so a failed job leaves the old one.
  Zone indexes are built once and shared by the three tables that need them.
* Surrogate keys: keying the linked trips is a step of its own
  (``key_linked_trips``).  The keyed table is stored once; later builds reuse
  it, so ids of earlier outputs stay valid, unless ``rekey`` is set.

The tables do not read each other, so the order only matters for the keyed
linked-trip table, which must exist before ``trip_linked``.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.keys import with_surrogate_key
from ..operators.relational import assert_unique
from ..session import checkpoint_dir
from ..sources import fixtures, zones
from . import tables as T

TABLE_ORDER = ["day", "hh", "person", "trip_unlinked", "trip_linked", "vehicle"]
KEYED_LINKED = "trip_linked_with_uuid"

# inputs of each output table (source names)
TABLE_INPUTS = {
    "day": ["core_day"],
    "vehicle": ["core_vehicle"],
    "person": ["core_person", "core_trip"],
    "hh": ["core_hh", "core_person", "followon_hh", "taz_v3", "taz_v4"],
    "trip_unlinked": ["core_trip", "core_person", "taz_v3", "taz_v4"],
    "trip_linked": ["trip_linked", "core_trip", "taz_v3", "taz_v4"],
}


@dataclass
class BuildConfig:
    target: str                      # folder (path mode) or schema (catalog mode)
    prefix: str = ""
    suffix: str = ""
    format: str = "parquet"
    catalog: bool = False            # True: saveAsTable into schema ``target``
    key_method: str = "uuid"         # surrogate key of linked trips: uuid | hash
    key_cols: Sequence[str] = ("linked_trip_id",)
    rekey: bool = False              # True: draw new surrogate keys even if a keyed table is stored
    resume: bool = False             # True: keep tables whose inputs are those they were built from
    check_ids: bool = True           # fail if a trip id repeats (a zone belongs to an id)

    @classmethod
    def from_env(cls, env=None) -> "BuildConfig":
        """Build settings from the environment, with defaults.

        TARGET_DATASET (folder, or schema with TARGET_CATALOG=1), TABLE_PREFIX,
        TABLE_SUFFIX, TABLE_FORMAT, REKEY_LINKED, RESUME_BUILD.
        """
        env = os.environ if env is None else env
        return cls(target=env.get("TARGET_DATASET", "survey_tables"),
                   prefix=env.get("TABLE_PREFIX", ""), suffix=env.get("TABLE_SUFFIX", ""),
                   format=env.get("TABLE_FORMAT", "parquet"),
                   catalog=env.get("TARGET_CATALOG", "0") in ("1", "true", "yes"),
                   rekey=env.get("REKEY_LINKED", "0") in ("1", "true", "yes"),
                   resume=env.get("RESUME_BUILD", "0") in ("1", "true", "yes"))

    def table_name(self, base: str) -> str:
        return f"{self.prefix}{base}{self.suffix}"

    def location(self, base: str) -> str:
        name = self.table_name(base)
        return f"{self.target}.{name}" if self.catalog else os.path.join(self.target, name)


class Sources:
    """Named source tables."""

    def __init__(self, loader: Callable[[str], DataFrame], exists: Callable[[str], bool], where: str,
                 location: Callable[[str], str] | None = None):
        self._loader, self._exists, self.where = loader, exists, where
        self._location = location

    def location(self, name: str) -> str | None:
        """Where a source table is stored (a path, or schema.table); None if it is derived."""
        return self._location(name) if self._location else None

    def __call__(self, name: str) -> DataFrame:
        return self._loader(name)

    def exists(self, name: str) -> bool:
        return self._exists(name)

    @classmethod
    def parquet_folder(cls, spark: SparkSession, folder: str) -> "Sources":
        def path(n):
            return os.path.join(folder, f"{n}.parquet")

        def exists(n):
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path(n))
            return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

        def load(n):
            df = spark.read.parquet(path(n))
            return zones.with_rings(df) if n.startswith("taz_") else df
        return cls(load, exists, folder, path)

    @classmethod
    def catalog_schema(cls, spark: SparkSession, schema: str) -> "Sources":
        def load(n):
            df = spark.table(f"{schema}.{n}")
            return zones.with_rings(df) if n.startswith("taz_") else df

        return cls(load, lambda n: spark.catalog.tableExists(f"{schema}.{n}"), schema, lambda n: f"{schema}.{n}")

    @classmethod
    def fixtures(cls, spark: SparkSession, sf_dir: str) -> "Sources":
        def load(n):
            if n in ("taz_v3", "taz_v4"):
                return zones.load_zones(spark, sf_dir, n)
            if n == "trip_linked":
                return fixtures.load(spark, sf_dir, "trip_linked_src")
            return fixtures.load(spark, sf_dir, n)
        return cls(load, lambda n: n in fixtures.RELATIONS or n == "trip_linked", sf_dir)


@dataclass
class BuildResult:
    written: dict = field(default_factory=dict)   # table -> location
    kept: list = field(default_factory=list)      # with ``resume``: tables left as they were


def _fs_path(spark: SparkSession, path: str):
    """Hadoop file system and fully qualified path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def _exists(spark: SparkSession, cfg: BuildConfig, base: str) -> bool:
    loc = cfg.location(base)
    if cfg.catalog:
        return spark.catalog.tableExists(loc)
    fs, p = _fs_path(spark, loc)
    return fs.exists(p)


#: File in a table's folder (and table property) with the fingerprint of what the table was built from.
FINGERPRINT = "_wayfarer_inputs"


def _write(df: DataFrame, cfg: BuildConfig, base: str, fingerprint: str | None = None) -> str:
    """Write beside the place of the table, then swap: a failed write leaves the old table.

    The old table is moved aside and dropped only after the new one has its
    name; a run that breaks off in between is mended by ``recover``.
    """
    spark, loc, mark = df.sparkSession, cfg.location(base), uuid.uuid4().hex[:12]
    if cfg.catalog:
        new, old = f"{loc}__new_{mark}", f"{loc}__old_{mark}"
        try:
            df.write.format(cfg.format).saveAsTable(new)
            if fingerprint:
                spark.sql(f"ALTER TABLE {new} SET TBLPROPERTIES ('{FINGERPRINT}' = '{fingerprint}')")
        except BaseException:
            spark.sql(f"DROP TABLE IF EXISTS {new}")
            raise
        had = spark.catalog.tableExists(loc)
        if had:
            _rename_table(spark, loc, old)
        try:
            _rename_table(spark, new, loc)
        except BaseException:
            if had:
                _rename_table(spark, old, loc)
            raise
        if had:
            spark.sql(f"DROP TABLE IF EXISTS {old}")
        return loc
    fs, place = _fs_path(spark, loc)
    _, new = _fs_path(spark, os.path.join(cfg.target, f".new-{mark}-{cfg.table_name(base)}"))
    _, old = _fs_path(spark, os.path.join(cfg.target, f".old-{mark}-{cfg.table_name(base)}"))
    try:
        df.write.format(cfg.format).save(new.toString())
        if fingerprint:
            out = fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new, FINGERPRINT))
            out.writeBytes(fingerprint)
            out.close()
    except BaseException:
        fs.delete(new, True)
        raise
    if fs.exists(place) and not fs.rename(place, old):
        raise OSError(f"cannot move {place.toString()} aside")
    if not fs.rename(new, place):
        fs.rename(old, place)
        raise OSError(f"cannot move {new.toString()} into place")
    fs.delete(old, True)
    return loc


def _rename_table(spark: SparkSession, a: str, b: str) -> None:
    spark.sql(f"ALTER TABLE {a} RENAME TO {b}")


def recover(spark: SparkSession, cfg: BuildConfig, base: str) -> str | None:
    """Mend what a broken run left of a table: "restored" if its old state came back, "cleared" if only remains went.

    Must not run beside another build of the same target.
    """
    name, loc = cfg.table_name(base), cfg.location(base)
    if cfg.catalog:
        if not spark.catalog.databaseExists(cfg.target):
            return None
        found = [t.name for t in spark.catalog.listTables(cfg.target)]
        pattern = re.compile(re.escape(name.lower()) + r"__(new|old)_[0-9a-f]{12}")
        left = sorted(t for t in found if pattern.fullmatch(t.lower()))
        old = [t for t in left if "__old_" in t.lower()]
        restored = bool(old) and name.lower() not in [t.lower() for t in found]
        if restored:
            _rename_table(spark, f"{cfg.target}.{old[-1]}", loc)
        for t in left:
            if not (restored and t == old[-1]):
                spark.sql(f"DROP TABLE IF EXISTS {cfg.target}.{t}")
        return "restored" if restored else "cleared" if left else None
    fs, folder = _fs_path(spark, cfg.target)
    if not fs.exists(folder):
        return None
    pattern = re.compile(r"\.(new|old)-[0-9a-f]{12}-" + re.escape(os.path.basename(name)))
    _, place = _fs_path(spark, loc)
    left = sorted(((s.getModificationTime(), s.getPath()) for s in fs.listStatus(place.getParent() if fs.exists(place.getParent()) else folder)
                   if pattern.fullmatch(s.getPath().getName())), key=lambda x: x[0])
    old = [p for _, p in left if p.getName().startswith(".old-")]
    restored = bool(old) and not fs.exists(place)
    if restored and not fs.rename(old[-1], place):
        raise OSError(f"cannot move {old[-1].toString()} back")
    for _, p in left:
        if not (restored and p.getName() == old[-1].getName()):
            fs.delete(p, True)
    return "restored" if restored else "cleared" if left else None


def input_fingerprint(spark: SparkSession, sources: "Sources", cfg: BuildConfig, table: str) -> str | None:
    """Digest of the files (name, length, time) a table is built from and of its settings; None if a source has no files."""
    lines = [repr((table, cfg.format, cfg.key_method, tuple(cfg.key_cols)) if table == "trip_linked" else (table, cfg.format))]
    for n in TABLE_INPUTS[table]:
        place = sources.location(n)
        if place is None:
            return None
        if not ("/" in place or os.sep in place):
            place = _identity(spark, place, True)
            if "/" not in place:
                return None
        fs, p = _fs_path(spark, place)
        files = fs.listFiles(p, True)
        found = []
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath().toString()} {f.getLen()} {f.getModificationTime()}")
        lines += [n, *sorted(found)]
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def stored_fingerprint(spark: SparkSession, cfg: BuildConfig, base: str) -> str | None:
    if not _exists(spark, cfg, base):
        return None
    loc = cfg.location(base)
    if cfg.catalog:
        return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {loc}").collect()}.get(FINGERPRINT)
    fs, p = _fs_path(spark, os.path.join(loc, FINGERPRINT))
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(b & 255 for b in stream.readNBytes(64)).decode()
    finally:
        stream.close()


def _read(spark: SparkSession, cfg: BuildConfig, base: str) -> DataFrame:
    loc = cfg.location(base)
    return spark.table(loc) if cfg.catalog else spark.read.format(cfg.format).load(loc)


def check_inputs(sources: Sources, tables: Sequence[str]) -> None:
    """Fail before any work if a table is unknown or an input is missing."""
    for t in tables:
        if t not in TABLE_INPUTS:
            raise ValueError(f"unknown table {t!r}; known: {sorted(TABLE_INPUTS)}")
        missing = [n for n in TABLE_INPUTS[t] if not sources.exists(n)]
        if missing:
            raise FileNotFoundError(f"{t}: missing inputs {missing} in {sources.where}")


def _identity(spark: SparkSession, location: str, catalog: bool) -> str:
    """A table's place in comparable form: its storage path where it has one, else its full name."""
    if not catalog:
        return _fs_path(spark, location)[1].toString().rstrip("/")
    if spark.catalog.tableExists(location):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {location}").where("col_name = 'Location'").collect()
        if rows:
            return rows[0]["data_type"].rstrip("/")
    parts = location.lower().split(".")
    current = [spark.catalog.currentCatalog().lower(), spark.catalog.currentDatabase().lower()]
    return ".".join((current + parts)[-3:] if len(parts) < 3 else parts)


def check_targets(spark: SparkSession, sources: Sources, cfg: BuildConfig, tables: Sequence[str]) -> None:
    """Fail if a table to be written, or the keyed linked trips, is or contains an input of any table."""
    places = [(n, sources.location(n)) for n in sorted({n for t in tables for n in TABLE_INPUTS[t]})]
    inputs = {n: _identity(spark, loc, not ("/" in loc or os.sep in loc)) for n, loc in places if loc}
    outputs = [*tables, *([KEYED_LINKED] if "trip_linked" in tables else [])]
    for t in outputs:
        place = _identity(spark, cfg.location(t), cfg.catalog)
        for n, source in inputs.items():
            if place == source or source.startswith(place + "/") or place.startswith(source + "/"):
                raise ValueError(f"target {cfg.location(t)} differs from no source: it would replace the input {n}; "
                                 "the target must differ from the source location")


def check_ids(sources: Sources, tables: Sequence[str]) -> None:
    """Fail if a trip id repeats: zones are looked up per trip id."""
    for table, source, key in (("trip_unlinked", "core_trip", "trip_id"), ("trip_linked", "trip_linked", "linked_trip_id")):
        if table in tables:
            df = sources(source)
            if key in df.columns and not assert_unique(df.where(df[key].isNotNull()), [key]).isEmpty():
                raise ValueError(f"{source}.{key} repeats; {table} needs unique ids")


def _content(df: DataFrame) -> tuple:
    """Count and order-independent sum of row hashes."""
    r = df.agg(F.count("*"), F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(20,0)"))).first()
    return r[0], r[1]


def key_linked_trips(spark: SparkSession, sources: Sources, cfg: BuildConfig, log: Callable[[str], None] = lambda m: None) -> DataFrame:
    """The keyed linked trips, stored once and kept in step with their source.

    If the source has changed, trips whose ``key_cols`` are stored keep their ids (with the source's present values;
    the k-th of several trips with one key keeps the k-th id), new trips get new ones, trips gone from the source go.
    A trip with a NULL in its key is new each time.  ``cfg.rekey`` draws all ids anew.
    """
    source = sources("trip_linked")
    keyed = with_surrogate_key(source, "unique_id", cfg.key_method, cfg.key_cols)
    if cfg.rekey or not _exists(spark, cfg, KEYED_LINKED):
        _write(keyed, cfg, KEYED_LINKED)
        return _read(spark, cfg, KEYED_LINKED)
    stored = _read(spark, cfg, KEYED_LINKED)
    if sorted(stored.columns) == sorted(keyed.columns) and _content(stored.select(*source.columns)) == _content(source):
        return stored
    if cfg.key_method != "hash":      # hashed keys depend on the row alone
        whole = None
        for c in cfg.key_cols:
            whole = F.col(c).isNotNull() if whole is None else whole & F.col(c).isNotNull()

        def numbered(df: DataFrame, order: list) -> DataFrame:
            return df.withColumn("__k", F.row_number().over(Window.partitionBy(*cfg.key_cols).orderBy(*order)))
        known = numbered(stored.where(whole).select(*cfg.key_cols, F.col("unique_id").alias("__known")), ["__known"])
        present = numbered(source.where(whole), [F.xxhash64(*[F.col(f"`{c}`") for c in source.columns])])
        on = [*cfg.key_cols, "__k"]
        new, gone = present.join(known, on, "left_anti").count(), known.join(present, on, "left_anti").count()
        log(f"{KEYED_LINKED}: {new} new trips, {gone} gone")
        keyed = (present.join(known, on, "left").select(F.coalesce("__known", F.expr("uuid()")).alias("unique_id"), *source.columns)
                 .unionByName(with_surrogate_key(source.where(~whole), "unique_id", cfg.key_method, cfg.key_cols)))
    _write(keyed, cfg, KEYED_LINKED)
    return _read(spark, cfg, KEYED_LINKED)


def run_pipeline(spark: SparkSession, sources: Sources, cfg: BuildConfig,
                 tables: Sequence[str] = TABLE_ORDER, log: Callable[[str], None] = print) -> BuildResult:
    check_inputs(sources, tables)
    check_targets(spark, sources, cfg, tables)
    checkpoint_dir(spark)          # raises on a cluster without a shared folder, before any table is written
    if cfg.check_ids:
        check_ids(sources, tables)
    for t in [*tables, *([KEYED_LINKED] if "trip_linked" in tables else [])]:
        mended = recover(spark, cfg, t)
        if mended:
            log(f"{mended} {cfg.location(t)} after a broken run")
    result = BuildResult()
    idx = {}

    def zone(v):
        if v not in idx:
            idx[v] = zones.zone_index(sources(v), materialize=True)   # shared by three tables
        return idx[v]

    builders: dict[str, Callable[[], DataFrame]] = {
        "day": lambda: T.build_day(sources("core_day")),
        "vehicle": lambda: T.build_vehicle(sources("core_vehicle")),
        "person": lambda: T.build_person(sources("core_person"), sources("core_trip")),
        "hh": lambda: T.build_hh(sources("core_hh"), sources("core_person"), sources("followon_hh"),
                                 zone("taz_v3"), zone("taz_v4")),
        "trip_unlinked": lambda: T.build_trip_unlinked(sources("core_trip"), sources("core_person"),
                                                       zone("taz_v3"), zone("taz_v4")),
        "trip_linked": lambda: T.build_trip_linked(key_linked_trips(spark, sources, cfg, log), sources("core_trip"),
                                                   zone("taz_v3"), zone("taz_v4")),
    }
    for t in tables:
        mark = input_fingerprint(spark, sources, cfg, t)
        if cfg.resume and mark and not (cfg.rekey and t == "trip_linked") and stored_fingerprint(spark, cfg, t) == mark:
            log(f"kept {t}: its inputs have not changed")
            result.kept.append(t)
            continue
        log(f"building {t} -> {cfg.location(t)}")
        result.written[t] = _write(builders[t](), cfg, t, mark)
        log(f"done {t}")
    return result


def main(argv=None) -> None:
    """``python -m wayfarer.plans.pipeline SOURCE_DIR [TABLE ...]`` - rebuild the tables.

    Sources are ``SOURCE_DIR/<name>.parquet``; the target comes from the
    environment (``BuildConfig.from_env``).  The first missing input or failed
    table stops the run.
    """
    import sys

    from pyspark.sql import SparkSession

    from ..session import apply_cluster_defaults
    args = list(sys.argv[1:] if argv is None else argv)
    if not args:
        raise SystemExit(main.__doc__)
    spark = SparkSession.builder.appName("wayfarer-build").getOrCreate()
    apply_cluster_defaults(spark)
    run_pipeline(spark, Sources.parquet_folder(spark, args[0]), BuildConfig.from_env(), tables=args[1:] or TABLE_ORDER)


if __name__ == "__main__":
    main()
