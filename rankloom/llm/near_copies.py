"""N-gram Jaccard join by MinHash banding (operator 2).

Two documents are linked if their sets of five-word shingles have a Jaccard similarity of 0.8 or more. Documents with equal
sets form one node. A node has ``BANDS`` band hashes of ``ROWS`` minima each: a pair at similarity s meets in a band with
probability 1 - (1 - s^ROWS)^BANDS, 0.99997 at 0.8. Nodes that meet are verified on their full sets.

Meeting nodes are never paired up as rows. A node's home is the lowest node it meets; the nodes of a home are cut into
tiles of at most ``TILE`` nodes, and ``TILE_SHINGLES`` shingles on average. A node travels once to each pair of tiles in which it meets someone,
where one matrix product gives all intersections. What comes back is one row per node: how many documents it is linked to,
and the lowest node it is connected to. Counting the links exactly within n documents that are all near one another takes
n x n / TILE rows; links of equal sets are counted without any.

Classes are the connected components of the links, found by hooking and pointer jumping over node labels with staged
tables, so that only minima meet at a hot node and joins on it can be split.

Defined cases: words are lower-cased runs of letters, digits and non-ASCII characters; texts of one to four words have one
shingle, all of it; texts without words (null, empty) are linked to nothing and are classes of their own; repeated rows and repeated
ids are documents each; a class is named by its smallest id (null if it has none); an empty table gives no rows; columns
named like a result are replaced. Shingles and nodes are 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from rankloom.llm.common import query, table
from rankloom.llm.words import Block, Hasher, map_texts, mixed, word_bytes
from rankloom.storage import stage

SHINGLE = 5
BANDS, ROWS = 20, 4
TILE, TILE_SHINGLES = 144, 400_000
SIGNED = StructType([StructField("node", LongType()), StructField("size", LongType()), StructField("bands", ArrayType(LongType()))])
SETS = StructType([StructField("node", LongType()), StructField("shingles", BinaryType())])


def shingles(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts in order, and how many each text has; repeats are kept."""
    words = block.hashes()
    step = np.uint64(0xC2B2AE3D27D4EB4F)
    full = np.maximum(block.count - SHINGLE + 1, 0)
    short = np.flatnonzero((block.count > 0) & (full == 0))
    starts = np.repeat(block.first[:-1] - np.cumsum(full) + full, full) + np.arange(int(full.sum()))
    grams = np.zeros(len(starts), np.uint64)
    for i in range(SHINGLE):
        grams = grams * step + words[starts + i]
    grams = mixed(grams)
    if not len(short):
        return grams, full
    counts = full.copy()
    counts[short] = 1
    out, at = np.empty(int(counts.sum()), np.uint64), np.cumsum(counts) - counts
    is_short = np.zeros(len(out), bool)
    is_short[at[short]] = True
    out[~is_short] = grams
    for doc in short:
        h = np.uint64(block.count[doc])
        for w in words[block.first[doc]:block.first[doc + 1]]:
            h = mixed(np.array([h]))[0] ^ w
        out[at[doc]] = h
    return out, counts


def distinct_sets(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles per text, and how many each has."""
    grams, counts = shingles(block)
    at = np.concatenate([[0], np.cumsum(counts)])
    sets = [np.unique(grams[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    return (np.concatenate(sets) if sets else grams), np.array([len(s) for s in sets], np.int64)


def nodes(sets: np.ndarray, sizes: np.ndarray) -> list[int | None]:
    """A hash of each whole set; None for an empty one."""
    at = np.concatenate([[0], np.cumsum(sizes)])
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(sets + np.uint64(1)), dtype=np.uint64)])
    whole = mixed(sums[at[1:]] - sums[at[:-1]] + sizes.astype(np.uint64)).view(np.int64)
    return [int(h) if n else None for h, n in zip(whole, sizes, strict=True)]


def signer():
    hasher, member = Hasher(), word_bytes()
    factors = np.random.default_rng(5).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(texts: list[bytes]) -> tuple[list, list, list]:
        sets, sizes = distinct_sets(Block(texts, member, hasher))
        some = np.flatnonzero(sizes)
        opens = (np.cumsum(sizes) - sizes)[some]
        bands = np.zeros((len(some), BANDS), np.uint64)
        for j, factor in enumerate(factors if len(some) else ()):
            low = np.minimum.reduceat(sets * factor, opens)
            bands[:, j // ROWS] = mixed(bands[:, j // ROWS] + low + np.uint64(j))
        out: list[list[int]] = [[] for _ in texts]
        for doc, row in zip(some, bands.view(np.int64).tolist(), strict=True):
            out[doc] = row
        return nodes(sets, sizes), sizes.tolist(), out

    return sign


def setter():
    hasher, member = Hasher(), word_bytes()

    def make(texts: list[bytes]) -> tuple[list, list]:
        sets, sizes = distinct_sets(Block(texts, member, hasher))
        at = np.concatenate([[0], np.cumsum(sizes)])
        return nodes(sets, sizes), [sets[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]

    return make


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the common parts of all pairs, by matrix products over blocks of the shingles that repeat."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = times[number] > 1
    owner, number = owner[keep], np.unique(number[keep], return_inverse=True)[1]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    out, width = np.zeros((n, n), np.float32), max(1, 4_000_000 // n)
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        a, b = np.searchsorted(number, [low, low + width])
        part = np.zeros((n, width), np.float32)
        part[owner[a:b], number[a:b] - low] = 1
        out += part @ part.T
    return out.astype(np.int64)


def verify(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links of the nodes of a pair of tiles: documents linked to and the lowest node connected with."""
    node, tile = pdf["node"].to_numpy(np.int64), pdf["tile"].to_numpy(np.int64)
    sets = [np.frombuffer(s, np.uint64) for s in pdf["shingles"]]
    size = np.array([len(s) for s in sets], np.int64)
    linked = 9 * intersections(sets) >= 4 * (size[:, None] + size[None, :])  # i / (a + b - i) >= 4 / 5
    np.fill_diagonal(linked, False)
    if len(np.unique(tile)) > 1:
        linked &= tile[:, None] != tile[None, :]
    low = node.copy()
    while True:
        near = np.minimum(low, np.where(linked, low[None, :], low[:, None]).min(axis=1))
        if (near == low).all():
            break
        low = near
    links = linked @ pdf["copies"].to_numpy(np.int64)
    return pd.DataFrame({"node": node, "links": links, "low": low})[linked.any(axis=1)]


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the lowest node of each connected component; ``edges`` (a, b) are staged here."""
    edges = stage(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-edges")
    label = stage(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "near-label")
    while True:
        near = edges.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        met = stage(label.join(near, "node", "left").select("node", "root", F.least("root", "near").alias("near")), "near-met")
        hook = stage(met.groupBy("root").agg(F.min("near").alias("hook")), "near-hook")
        hooked = stage(met.join(hook, "root").select("node", "root", F.least("near", "hook").alias("next")), "near-hooked")
        jump = hooked.select(F.col("node").alias("next"), F.col("next").alias("over"))
        new = stage(hooked.join(jump, "next", "left").select(
            "node", F.least("next", "over").alias("root"), (F.least("next", "over") != F.col("root")).alias("moved")), "near-label")
        label = new.select("node", "root")
        if new.filter("moved").limit(1).count() == 0:
            return label


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id, n_links, text_key) for each row of ``docs``; text_key tells rows of one id apart."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    signed = stage(map_texts(texts, signer, SIGNED).drop("text"), "near-signed")
    some = signed.filter(F.col("node").isNotNull())
    # Documents of a node: how many, one to take the set from, and the band hashes, which are the same for all.
    node = stage(some.groupBy("node").agg(F.count("*").alias("copies"), F.min("id").alias("id"), F.max("size").alias("size"),
                                          F.first("bands").alias("bands")), "near-node")
    met = node.select("node", F.posexplode("bands").alias("band", "hash"))
    lows = stage(met.groupBy("band", "hash").agg(F.min("node").alias("low"), F.count("*").alias("n")).filter("n > 1").drop("n"), "near-low")
    meeting = stage(met.join(lows, ["band", "hash"]), "near-meeting")
    home = stage(meeting.groupBy("node").agg(F.min("low").alias("home")).join(node.select("node", "size"), "node"), "near-home")
    large = stage(home.groupBy("home").agg(F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("size") / TILE_SHINGLES)).alias("cut")).filter(
        "cut > 1"), "near-large")
    tile = stage(home.join(large, "home", "left").select("node", F.xxhash64(
        "home", F.pmod(F.xxhash64("node"), F.coalesce("cut", F.lit(1)))).alias("tile")), "near-tile")
    placed = stage(meeting.drop("low").join(tile, "node"), "near-placed")
    tiles = stage(placed.groupBy("band", "hash").agg(F.collect_set("tile").alias("tiles")), "near-tiles")
    others = placed.join(tiles, ["band", "hash"]).groupBy("node", "tile").agg(F.array_distinct(F.flatten(F.collect_set("tiles"))).alias("others"))
    pairs = others.select("node", "tile", F.explode("others").alias("other")).select(
        "node", "tile", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"))
    wanted = tile.join(node, "node").select("id").distinct()
    sets = stage(map_texts(texts.join(wanted, texts["id"].eqNullSafe(wanted["id"]), "left_semi"), setter, SETS).drop("text").select(
        "node", "shingles").dropDuplicates(["node"]).join(node.select("node", "copies"), "node"), "near-sets")
    checked = stage(pairs.join(sets, "node").groupBy("one", "two").applyInPandas(verify, "node long, links long, low long"), "near-checked")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    root = components(checked.filter("node != low").select(F.col("node").alias("a"), F.col("low").alias("b")))
    about = stage(node.select("node", "copies", "id").join(links, "node", "left").join(root, "node", "left").select(
        "node", "id", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "near-about")
    names = stage(about.groupBy("root").agg(F.min("id").alias("class_id")), "near-names")
    named = stage(about.join(names, "root").select("node", "class_id", "n_links"), "near-named")
    alone = signed.filter(F.col("node").isNull()).select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), "text_key")
    return some.select("id", "node", "text_key").join(named, "node").select("id", "class_id", "n_links", "text_key").unionByName(alone).withColumnRenamed("id", id_col)


SQL2 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, w[i:i + 4] AS g FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 9 * c >= 4 * (a.n + b.n)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y)
SELECT d.doc_id, (SELECT min(y) FROM reach r WHERE r.x = d.doc_id) AS class_id,
  (SELECT count(*) FROM link l WHERE l.x = d.doc_id) AS n_links FROM documents d
"""


@query("op2_near_copies", SQL2.replace("WITH w AS", "WITH RECURSIVE w AS", 1))
def op2(spark, sf_dir):
    """Class and number of links of every document."""
    return near_copies(table(spark, sf_dir, "documents")).drop("text_key")
