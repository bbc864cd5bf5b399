"""Trie of conversation prefixes by depth-band rollup (operator 11).

A node is a distinct sequence of first turns. Its id is a chain of SHA-256 digests, built in bands of ``BAND`` turns: the
turns of a band are chained within the band, the digests of full bands form a sequence ``BAND`` times shorter that is
chained by the same step, and a turn's id is the digest of what stands before its band and of its chain. So no
conversation is one group, however long; the number of levels is the logarithm of the longest one to base ``BAND``.

Totals of subtrees go the same way. In a band, a node's values are summed at the node that ends the band above (its top).
The tops form a tree ``BAND`` times flatter, whose totals come from the same step. A completed top then hands its total
to its own node, and each node explodes once, to the ancestors of its band only: at most ``BAND`` rows a node on a level,
in logarithmically many rounds. Hot nodes, such as the root, are met by partial sums.

Positions come from sorting by range over (conversation, turn). Rows that a hot conversation or a node with very many
children bring to a join meet staged tables, so that the join can be split. The ids that end at a node are joined to text
in chunks of neighbouring ids and streamed through the digest chunk by chunk.

Defined cases: null roles and texts are empty; a turn of null comes first, equal turns are ordered by a digest of role and
text; repeated rows are turns of their own; rows without a conversation id belong to no conversation and are not read; a
conversation left without turns ends at the root; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import query, table
from rankloom.operators.ordering import global_positions
from rankloom.storage import stage

#: Turns of a band; neighbouring conversation ids whose text is joined in one piece.
BAND, CHUNK = 16, 4096
#: First turns that a conversation may take from another are fewer than this.
MOST_SHARED = 9
BINARIES = "array<binary>"


def root_id() -> Column:
    return F.lit(b"root").cast("binary")


def digest(*parts: Column | str) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, code, size): digest of role and text, and the bytes of the text, in turn order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", digest(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("code"),
        F.octet_length(text).cast("long").alias("size"))
    placed = global_positions(slim, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("code").asc()], "place")
    return stage(placed.select("conv_id", "place", "code", "size"), "trie-turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sequences and their lengths: (conv_id, depth from 1, code, size, last) and (conv_id, length).

    A conversation takes its first turns from conversation ``conv_id - conv_id % 5``, as many as its checksum says.
    """
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("own")).select(
        "conv_id", "own", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).alias("shared"))
    counts = stage(counts, "trie-counts")
    lengths = counts.select(F.col("conv_id").alias("base"), F.col("own").alias("of_base"))
    taken = F.least("shared", F.coalesce("of_base", F.lit(0)))
    plans = stage(counts.join(lengths, "base", "left").select(
        "conv_id", "base", "shared", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("shared"), F.lit(0))).alias("length")), "trie-plans")
    heads = turns.where(F.col("place") < MOST_SHARED).withColumnRenamed("conv_id", "base")
    first = plans.join(heads, "base").where("place <= shared").withColumn("depth", F.col("place"))
    after = turns.join(plans, "conv_id").where("place > shared").withColumn("depth", F.col("place") - F.col("shared") + F.col("taken"))
    columns = ("conv_id", "depth", "code", "size", (F.col("depth") == F.col("length")).alias("last"))
    return first.select(*columns).unionByName(after.select(*columns)), plans.select("conv_id", "length")


def named(rows: DataFrame, level: int = 1) -> list[DataFrame]:
    """Ids of all prefixes of the sequences (conv_id, depth, code, ...), level by level, coarser ones last.

    Each level has conv_id, depth (there in bands), id, path (ids of its band down to its own), top (the id that ends the
    band above) and the other columns of ``rows``. The id that ends a full band is that of the coarser level.
    """
    others = [c for c in rows.columns if c not in ("conv_id", "depth", "code")]
    band = F.floor((F.col("depth") - 1) / BAND).cast("long").alias("band")
    # At most BAND entries a group: bands of a conversation have no gaps.
    bands = rows.groupBy("conv_id", band).agg(F.sort_array(F.collect_list(F.struct("depth", "code", *others))).alias("items"))
    tag = F.lit(f"{level}:")
    chain = F.aggregate("items", F.array().cast(BINARIES), lambda done, x: F.concat(
        done, F.array(digest(tag.cast("binary"), F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(b"")), x["code"]))))
    bands = stage(bands.withColumn("chain", chain), f"trie-bands-{level}")
    full = F.size("items") == BAND
    coarser: list[DataFrame] = []
    if bands.where(full).limit(1).count():
        coarser = named(bands.where(full).select("conv_id", (F.col("band") + 1).alias("depth"), F.element_at("chain", BAND).alias("code")), level + 1)
        # A full band's end, and the next band's start.
        marks = F.explode(F.array(F.struct((F.col("depth") - 1).alias("band"), F.col("id").alias("end"), F.lit(None).cast("binary").alias("start")),
                                  F.struct(F.col("depth").alias("band"), F.lit(None).cast("binary").alias("end"), F.col("id").alias("start"))))
        marks = stage(coarser[0].select("conv_id", marks.alias("m")).groupBy("conv_id", "m.band").agg(
            F.max("m.end").alias("end"), F.max("m.start").alias("start")), f"trie-marks-{level}")
        bands = bands.join(marks, ["conv_id", "band"], "left")
    else:
        bands = bands.withColumns({"end": F.lit(None).cast("binary"), "start": F.lit(None).cast("binary")})
    bands = bands.withColumn("top", F.coalesce("start", root_id()))
    bands = bands.withColumn("ids", F.transform("chain", lambda x, i: F.when(
        full & (i == BAND - 1), F.col("end")).otherwise(digest(F.col("top"), x))))
    entries = bands.select("conv_id", "top", "ids", F.posexplode("items").alias("at", "item"))
    here = entries.select("conv_id", F.col("item.depth").alias("depth"), F.element_at("ids", F.col("at") + 1).alias("id"),
                          F.slice("ids", F.lit(1), F.col("at") + 1).alias("path"), "top", *[F.col(f"item.{c}").alias(c) for c in others])
    return [stage(here, f"trie-ids-{level}"), *coarser]


def rolled_up(nodes: DataFrame, values: list[str], coarser: list[DataFrame]) -> DataFrame:
    """(id, values): totals of every subtree; ``nodes`` has id, path, top and values, the root its own row without a path."""
    sums = [F.sum(v).alias(v) for v in values]
    if coarser:
        tops = coarser[0].groupBy("id").agg(F.first("path").alias("path"), F.first("top").alias("top"))
        tops = tops.unionByName(nodes.where("path IS NULL").select("id", "path", "top"))
        below = nodes.where("path IS NOT NULL").groupBy("top").agg(*sums).withColumnRenamed("top", "id")
        tops = stage(tops.join(below, "id", "left").select("id", "path", "top", *[F.coalesce(v, F.lit(0)).alias(v) for v in values]), "trie-tops")
        complete = rolled_up(tops, values, coarser[1:]).select("id", *[F.col(v).alias(f"_{v}") for v in values])
        nodes = nodes.join(complete, "id", "left").select(
            "id", "path", "top", *[(F.col(v) + F.coalesce(F.col(f"_{v}"), F.lit(0))).alias(v) for v in values])
        inner = nodes.select(F.explode(F.coalesce("path", F.array("id"))).alias("id"), *values)
    else:
        # One band: the root is above every node, too.
        inner = nodes.select(F.explode(F.when(F.col("path").isNull(), F.array("id")).otherwise(F.concat(F.array(root_id()), "path"))).alias("id"), *values)
    return stage(inner.groupBy("id").agg(*sums), "trie-totals")


def end_digests(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256): digest of the ids that end at a node, ascending, joined by commas."""
    chunks = ends.groupBy("id", F.floor(F.col("conv_id") / CHUNK).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    ordered = chunks.repartition("id").sortWithinPartitions("id", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, seen = None, None
        for batch in batches:
            names, found = [], []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if node != here:
                    if seen:
                        names.append(here)
                        found.append(seen.hexdigest())
                    here, seen = node, hashlib.sha256(ids.encode())
                else:
                    seen.update(f",{ids}".encode())
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(found)], names=["id", "ends_sha256"])
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([here], pa.binary()), pa.array([seen.hexdigest()])], names=["id", "ends_sha256"])

    return ordered.mapInArrow(run, "id binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    rows, lengths = rebuilt(numbered_turns(conversations))
    levels = named(rows)
    members = levels[0]
    parent = F.coalesce(F.try_element_at("path", F.lit(-2)), F.col("top"))
    nodes = members.groupBy("id").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.count("*").alias("n_convs"), F.max("size").alias("size"),
        F.min("last").alias("leaf"), F.first("path").alias("path"), F.first("top").alias("top")).withColumn("parent", parent)
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), (F.max("length") == 0).alias("leaf")).where(
        "n_convs > 0").select(root_id().alias("id"), "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("size"), "leaf",
                              F.lit(None).cast(BINARIES).alias("path"), F.lit(None).cast("binary").alias("top"), F.lit(None).cast("binary").alias("parent"))
    nodes = stage(nodes.unionByName(root), "trie-nodes")
    own = nodes.select("id", "path", "top", F.col("leaf").cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    totals = rolled_up(own, ["n_leaves", "saved_tokens"], levels[1:])
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    ends = members.where("last").select("id", "conv_id").unionByName(lengths.where("length = 0").select(root_id().alias("id"), "conv_id"))
    parents = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    found = reduce(lambda a, b: a.join(b, "id", "left"), [totals, children, end_digests(ends)], nodes.drop("path", "top", "leaf", "size"))
    # Staged, so that the join can split the children of a hot parent.
    return stage(found, "trie-found").join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


@query("op11_prefix_trie", r"""
WITH RECURSIVE bits AS (
  SELECT range AS b, range AS v, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8),
turns AS (
  SELECT conv_id, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS item,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(item ORDER BY place) AS items FROM turns GROUP BY 1),
shared AS (
  SELECT conv_id, items, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda s, c: xor(s >> 8, t[(xor(s, c) & 255) + 1])), 4294967295) % 9 AS h FROM own, crc),
whole AS (
  SELECT s.conv_id, coalesce(list_slice(b.items, 1, h), []) || list_slice(s.items, h + 1, len(s.items)) AS items
  FROM shared s LEFT JOIN own b ON b.conv_id = s.conv_id - s.conv_id % 5),
member AS (
  SELECT conv_id, d AS depth, len(items) = d AS ends, sha256(to_json(list_slice(items, 1, d))::VARCHAR) AS node, strlen(items[d].t) AS size
  FROM (SELECT conv_id, items, unnest(range(0, len(items) + 1)) AS d FROM whole)),
node AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(CASE WHEN depth > 0 THEN size ELSE 0 END) AS size, min(ends) AS leaf,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM member GROUP BY 1, 2),
above AS (SELECT n.*, m.node AS up, m.depth AS up_depth FROM node n JOIN member m ON m.conv_id = n.conv_id AND m.depth <= n.depth),
totals AS (
  SELECT up AS node, up_depth AS depth, count(*) FILTER (leaf) AS n_leaves, sum((n_convs - 1) * size)::BIGINT AS saved_tokens,
    count(*) FILTER (depth = up_depth + 1) AS n_children FROM above GROUP BY 1, 2),
parent AS (SELECT a.node, a.depth, p.conv_id AS parent_conv_id FROM above a JOIN node p ON p.node = a.up AND p.depth = a.up_depth WHERE a.up_depth = a.depth - 1)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM node JOIN totals USING (node, depth) LEFT JOIN parent USING (node, depth)""")
def op11(spark, sf_dir):
    """All prefixes of all conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))
