"""Readers for game builds, normalized games, feeds, master snapshots and registries.

No reader infers a schema. Finding the newest build or snapshot lists folder
names on the driver; the data of older ones is not opened.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.operators.clean import TEAM_KEYS, coerce_games, normalize_games, require_columns, slice_filter, split_complete
from rankloom.operators.windows import best_row
from rankloom.schemas import GAME_RAW, HASH_STORE, IDENTITY, MASTER_SLICE, METADATA_ENTRY, PROVIDER_FILE_MARKS
from rankloom.sources.provider import read_provider, stream_provider

GAME_DEDUPE = ("team_id_master", "opponent_id_master", "date", "gf", "ga")


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob on any file system Spark can read, sorted by name."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """CSV with a header; columns are matched by name and blanks are null."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("escape", '"').csv(paths)


# ---------------------------------------------------------------- games

def read_build_games(spark: SparkSession, build_dir: str) -> DataFrame:
    """All game files of one build, normalized."""
    files = list_paths(spark, f"{build_dir}/games_*.csv")
    if not files:
        raise FileNotFoundError(f"no games_*.csv in {build_dir}")
    return normalize_games(read_csv(spark, files, GAME_RAW))


def consolidate_builds(
    spark: SparkSession, root: str, states: Sequence[str], genders: Sequence[str], ages: Sequence[str],
    refresh: bool = False,
) -> DataFrame:
    """Games of the wanted slices from the latest build, or from all builds with ``refresh``.

    Slices are files ``games_<feed>_<slice>.csv`` or folders ``games_<feed>/slice_key=<slice>``.
    Adds build_id and slice_key from the path. Repeated games appear once.
    """
    builds = list_paths(spark, f"{root}/build_*")
    if not builds:
        raise FileNotFoundError(f"no build_* folders in {root}")
    wanted = re.compile(rf"[_=]({'|'.join(states)})_({'|'.join(genders)})_({'|'.join(ages)})(\.csv)?$")
    layouts = ("games_*.csv", "games_*/slice_key=*")
    files = [p for b in (builds if refresh else builds[-1:]) for layout in layouts
             for p in list_paths(spark, f"{b}/{layout}") if wanted.search(p)]
    if not files:
        raise ValueError("no games found for the requested slices")
    path = F.col("_metadata.file_path")
    games = read_csv(spark, files, GAME_RAW).select(
        "*", F.regexp_extract(path, r"/(build_[^/]+)/games_", 1).alias("build_id"),
        F.regexp_extract(path, r"/games_.*?[_=]([A-Z]{2}_[MF]_U[0-9]+)", 1).alias("slice_key"),
    )
    return dedupe_games(normalize_games(games)).orderBy(F.col("date").desc_nulls_last(), *GAME_DEDUPE)


def dedupe_games(games: DataFrame) -> DataFrame:
    """One row per team, opponent, date and score: that of the first build, then the first by its other columns."""
    return best_row(games, GAME_DEDUPE, [F.col("build_id").asc_nulls_last()] if "build_id" in games.columns else [])


def append_games(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing and new games; a repeated game keeps its newest ``scraped_at``."""
    both = existing.unionByName(new, allowMissingColumns=True)
    return best_row(both, GAME_DEDUPE, [F.col("scraped_at").desc_nulls_last()])


def append_clubs(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing and new clubs; a club of a state keeps its newest sighting."""
    both = existing.unionByName(new, allowMissingColumns=True)
    return best_row(both, ("club_name", "state"), [F.col("last_seen_at").desc_nulls_last()])


def read_latest_normalized(
    spark: SparkSession, root: str, state: str | None = None, genders: Sequence[str] = (), ages: Sequence[str] = ()
) -> DataFrame:
    """The newest ``version=`` folder of the normalized table; slice columns prune its partitions."""
    versions = list_paths(spark, f"{root}/version=*")
    if not versions:
        raise FileNotFoundError(f"no normalized games in {root}")
    games = spark.read.parquet(versions[-1])
    if state is not None:
        games = games.where(F.col("state") == state)
    if genders:
        games = games.where(F.col("gender").isin(*genders))
    if ages:
        games = games.where(F.col("age_group").isin(*ages))
    return games


def load_games(
    spark: SparkSession, root: str, state: str, genders: Sequence[str], ages: Sequence[str],
    mode: str = "normalized", national: bool = False,
) -> DataFrame:
    """Games for a rating run. ``normalized`` reads the table, ``raw`` the latest build's files."""
    if mode == "normalized":
        games = read_latest_normalized(spark, f"{root}/normalized")
        games = coerce_games(games)
    elif mode == "raw":
        builds = list_paths(spark, f"{root}/build_*")
        if not builds:
            raise FileNotFoundError(f"no builds in {root}")
        games = read_build_games(spark, builds[-1])
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return slice_filter(games, None if national else state, genders, ages)


# ---------------------------------------------------------------- feeds and snapshots

def provider_of_file(name: Column) -> Column:
    case = None
    for mark, provider in PROVIDER_FILE_MARKS.items():
        test = F.contains(F.lower(name), F.lit(mark))
        case = F.when(test, provider) if case is None else case.when(test, provider)
    return case.otherwise("Unknown")


def headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header): the first line of every file that has one; of each file only the first block is looked at."""
    lines = spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_at")).where("_at = 0")
    return lines.withColumn("_row", F.monotonically_increasing_id()).groupBy("path").agg(F.min_by("value", "_row").alias("header"))


def read_feeds(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Every feed file of a folder as text columns, with ``provider`` from the file name where absent.

    Files with the same header are read together, so the plan grows with the
    number of layouts and not with the number of files. One job reads all headers.
    """
    found = list_paths(spark, f"{folder}/{pattern}")
    layouts = {tuple(r["header"].split(",")): sorted(map(unquote, r["paths"])) for r in headers(spark, found).groupBy("header").agg(
        F.collect_list("path").alias("paths")).collect()} if found else {}
    if not layouts:
        raise FileNotFoundError(f"no feed files in {folder}")
    result = None
    for columns, paths in sorted(layouts.items()):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        rows = read_csv(spark, paths, schema)
        if "provider" not in columns:
            inside = F.substring_index(F.col("_metadata.file_path"), f"{_name(folder)}/", -1)
            rows = rows.withColumn("provider", provider_of_file(inside))
        result = rows if result is None else result.unionByName(rows, allowMissingColumns=True)
    return result


def latest_snapshot(spark: SparkSession, folder: str, baseline: bool = False, pattern: str = "master_*") -> str:
    """Newest master snapshot by name: a migrated one first; for a baseline no incremental one."""
    paths = [p for p in list_paths(spark, f"{folder}/{pattern}") if not (baseline and "incremental" in _name(p))]
    if not paths:
        raise FileNotFoundError(f"no master snapshot in {folder}")
    migrated = [p for p in paths if "migrated" in _name(p)]
    return (migrated if migrated and not baseline else paths)[-1]


def read_baseline(spark: SparkSession, path: str, schema: T.StructType, sample: bool = False, sample_rows: int = 5000) -> DataFrame:
    """The baseline index; ``sample`` is the quick mode that keeps the first rows by key."""
    rows = read_csv(spark, path, schema)
    if not sample:
        return rows
    key = [c for c in ("team_name", "state", "gender", "age_group", "provider", "source_url") if c in rows.columns]
    return rows.orderBy(*key).limit(sample_rows)


def read_master_slice(master: DataFrame, state: str, gender: str, age_group: str) -> tuple[DataFrame, DataFrame]:
    """Complete teams of one slice and the incomplete ones with what they miss."""
    require_columns(master, TEAM_KEYS)
    rows = master.where((F.col("state") == state) & (F.col("gender") == gender) & (F.col("age_group") == age_group))
    return split_complete(rows, [k for k in TEAM_KEYS if k != "club_name"])


def master_slices(master: DataFrame) -> DataFrame:
    """The master index in slice layout: renamed ids, one row per team."""
    return master.select(
        F.col("team_id").alias("team_id_master"),
        F.regexp_replace("provider_team_id", "\\.0$", "").alias("team_id_source"),
        "team_name", "club_name", "state", "gender", "age_group", "provider",
    ).select(*MASTER_SLICE.fieldNames())


# ---------------------------------------------------------------- registries

def json_layouts(spark: SparkSession, path: str, lines: bool | None) -> dict[bool, list[str]]:
    """Files by layout: True, a document per line, which tasks share; False, a document per file.

    Without ``lines`` a file is read by line if its first line is a whole document.
    """
    if lines is not None:
        return {lines: [path]}
    whole_line = F.try_parse_json("header").isNotNull()
    found = headers(spark, [path]).groupBy(whole_line.alias("lines")).agg(F.collect_list("path").alias("paths")).collect()
    return {r["lines"]: sorted(map(unquote, r["paths"])) for r in found} or {True: [path]}


def _read_json(spark: SparkSession, path: str, lines: bool | None, schema: T.StructType) -> DataFrame:
    parts = [spark.read.schema(schema).option("multiLine", not by_line).json(paths) for by_line, paths in json_layouts(spark, path, lines).items()]
    return reduce(DataFrame.unionByName, parts)


def read_identity_map(spark: SparkSession, path: str, lines: bool | None = None) -> DataFrame:
    """JSON objects keyed by team id as one row per team; see ``json_layouts``."""
    parts = [spark.read.text(paths, wholetext=not by_line) for by_line, paths in json_layouts(spark, path, lines).items()]
    entries = reduce(DataFrame.unionByName, parts).select(
        F.explode(F.from_json("value", T.MapType(T.StringType(), IDENTITY))).alias("team_id", "entry")
    )
    return entries.select("team_id", "entry.*")


def read_registry(spark: SparkSession, path: str, schema: T.StructType = METADATA_ENTRY, lines: bool | None = None) -> DataFrame:
    """JSON build entries, or lists of them, as rows; see ``json_layouts``."""
    return _read_json(spark, path, lines, schema)


def read_hash_store(spark: SparkSession, path: str, lines: bool | None = None) -> DataFrame:
    """Stored game hashes: one row per slice and game; see ``json_layouts``."""
    stored = _read_json(spark, path, lines, HASH_STORE)
    return stored.select("slice_key", "build_id", F.explode("games").alias("game_id", "game_hash"))


# ---------------------------------------------------------------- registered feeds

@dataclass(frozen=True)
class Feed:
    """How a raw feed becomes games or teams: its layout and one expression per target column."""

    name: str
    schema: T.StructType
    mapping: Mapping[str, Callable[[], Column] | str]

    def apply(self, raw: DataFrame) -> DataFrame:
        return raw.select(*[
            (F.expr(e) if isinstance(e, str) else e()).alias(target) for target, e in self.mapping.items()
        ])

    def read(self, spark: SparkSession, root: str, since: str | None = None) -> DataFrame:
        """What the feed's provider published on or after ``since``, as games or teams; ``day`` may be used by the mapping."""
        return self.apply(read_provider(spark, root, self.schema, since))

    def stream(self, spark: SparkSession, root: str, since: str | None = None) -> DataFrame:
        """The same as a stream whose offsets are the ``since`` dates."""
        return self.apply(stream_provider(spark, root, self.schema, since))


_FEEDS: dict[str, Feed] = {}


def register_feed(name: str, schema: T.StructType, mapping: Mapping[str, Callable[[], Column] | str]) -> Feed:
    """Make a feed known by name; ``mapping`` holds SQL text or functions that build a column."""
    _FEEDS[name.lower()] = Feed(name, schema, dict(mapping))
    return _FEEDS[name.lower()]


def feed(name: str) -> Feed:
    if name.lower() not in _FEEDS:
        raise ValueError(f"unknown feed {name!r}; known: {sorted(_FEEDS)}")
    return _FEEDS[name.lower()]
