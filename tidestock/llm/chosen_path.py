"""N-gram Jaccard join by chosen paths (after Christiani, Pagh and Sivertsen's CPSJoin).

A document is the set of its hashed word n-grams; documents with equal sets are one record. A run
puts every record under a root and splits recursively: at each node a few coordinates are chosen at
random, and per coordinate the records are divided by their sampled token there, the one that is
least under the coordinate's hash. Two records go on together with a chance equal to their
similarity, so unlike records part quickly. Buckets of at most ``LEAF`` records are leaves; deeper
than ``DEPTH`` larger ones are leaves too, compared exactly in blocks spread over tasks. Inside a
leaf all pairs are compared exactly, by shared tokens.

A node chooses ``BRANCH`` coordinates. A pair of similarity s is lost by a run with at most the
chance q = (1 - s + s q)^BRANCH, the smallest root (a branching process that dies out); runs repeat
until q to their number is below 1 - recall.

Pairs never leave a leaf: a leaf yields for each record its number of links that no leaf with a
smaller number has counted, and one edge to the least record of its local component. Components of
these edges are the near-duplicate classes.

Defined results: null texts and texts without words are records of their own with no links; fewer
words than n are one n-gram; repeated rows and equal sets share their class; a null id sorts first;
the class id is the least document id of the class.
"""

from __future__ import annotations

import math
from itertools import groupby

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.llm.components import components
from tidestock.llm.rows import map_rows, numbered
from tidestock.session import staged

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.999
COORDINATES, BRANCH, DEPTH, LEAF, BLOCK = 48, 2, 3, 1000, 500
LOWEST = -(1 << 63)
#: Odd multipliers, one for each coordinate's hash.
MULTIPLIERS = np.random.default_rng(20).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
MEMBER = "path long, used long, rec binary, key long, version long"


def runs_for(similarity: float, recall: float) -> int:
    """Runs after which a pair at the threshold is found with at least chance ``recall``."""
    lost = 0.0
    for _ in range(10_000):
        lost = (1 - similarity + similarity * lost) ** BRANCH
    if lost >= 1:
        raise ValueError(f"similarity {similarity} needs a larger BRANCH")
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost)))


def ngram_set(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; words are what spaces, tabs and line ends separate."""
    words = (text or "").encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    last = max(1, len(words) - n + 1)
    grams = own[:last].copy()
    for k in range(1, min(n, len(words))):
        grams *= np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(29)
        grams += own[k:last + k]
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(grams ^ (grams >> np.uint64(31)))


def sampled_tokens(grams: np.ndarray) -> np.ndarray:
    """The least token of each coordinate, 32 bits each."""
    out = np.empty(COORDINATES, "<u4")
    for c in range(COORDINATES):
        out[c] = (grams * MULTIPLIERS[c]).min() >> np.uint64(32)
    return out


def child(path: int, coordinate: int, token: int) -> int:
    return xxhash.xxh3_64_intdigest(b"%d,%d,%d" % (path, coordinate, token)) - (1 << 63)


def chosen(path: int, used: int) -> list[int]:
    """Coordinates of a node, among those that its path hasn't used."""
    free = [c for c in range(COORDINATES) if not used >> c & 1]
    order = sorted(free, key=lambda c: xxhash.xxh3_64_intdigest(b"%d:%d" % (path, c)))
    return order[:BRANCH]


def shared_tokens(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Matrix of common tokens between two lists of sets."""
    every = np.concatenate(left + right)
    tokens, column = np.unique(every, return_inverse=True)
    frequent = np.bincount(column, minlength=len(tokens)) > 1
    place = np.cumsum(frequent) - 1
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    use = frequent[column]
    row, column, width = row[use], place[column[use]], int(frequent.sum())
    out = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, width, 4096):  # a slice of the tokens at a time
        inside = (column >= start) & (column < start + 4096)
        matrix = np.zeros((len(left) + len(right), min(4096, width - start)), np.float32)
        matrix[row[inside], column[inside] - start] = 1
        out += matrix[:len(left)] @ matrix[len(left):].T
    return out


def linked(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs have at least this Jaccard similarity."""
    common = shared_tokens(left, right).astype(np.float64)
    sizes = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :]
    return common >= similarity * (sizes - common) - 1e-9


def local_roots(links: np.ndarray) -> np.ndarray:
    """Least member of each member's component in a symmetric matrix."""
    root = np.arange(len(links))
    while True:
        low = np.where(links, root[None, :], len(links)).min(axis=1, initial=len(links))
        new = np.minimum(root, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def compare(leaf: int, halves: tuple[list, list], similarity: float):
    """``(rec, links counted here, local root)`` of the records of a leaf, or of a pair of its blocks.

    ``halves``: members ``(rec, other leaves, set)``; the second one is empty when a block is
    compared with itself.
    """
    left, right = halves
    members = left + right
    n, cut = len(members), len(left)
    links = np.zeros((n, n), bool)
    if right:
        links[:cut, cut:] = linked([m[2] for m in left], [m[2] for m in right], similarity)
        links |= links.T
    else:
        links = linked([m[2] for m in left], [m[2] for m in left], similarity)
        np.fill_diagonal(links, False)
    if not links.any():
        return
    smaller: dict[int, int] = {}
    entries = [(i, smaller.setdefault(other, len(smaller))) for i, m in enumerate(members) for other in m[1] if other < leaf]
    counted = links
    if entries:
        together = np.zeros((n, len(smaller)), np.float32)
        together[tuple(np.array(entries).T)] = 1
        counted = links & (together @ together.T == 0)
    roots = local_roots(links)
    for i, (rec, _, _) in enumerate(members):
        if links[i].any():
            yield rec, int(counted[i].sum()), members[roots[i]][0]


def records_of(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """Per document: ``key``, ``version``, its record ``rec``, ``size`` and sampled tokens ``sig``."""
    source = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("key"), F.xxhash64(text_col).alias("version"), text_col
    )

    def work(rows):
        for key, version, text in rows:
            grams = ngram_set(text, n)
            if len(grams):
                yield key, version, xxhash.xxh3_128_digest(grams.tobytes()), len(grams), sampled_tokens(grams).tobytes()
            else:
                yield key, version, None, 0, None

    return map_rows(source, work, "key long, version long, rec binary, size long, sig binary")


def leaves_of(records: DataFrame, runs: int) -> DataFrame:
    """Memberships ``path, rec, key, version, n`` (members of the leaf) of all leaves with company."""

    def split(rows):
        for path, used, rec, key, version, sig in rows:
            tokens = np.frombuffer(sig, "<u4")
            for c in chosen(path, used):
                yield child(path, c, int(tokens[c])), used | 1 << c, rec, key, version

    roots = records.select(
        F.explode(F.array(*[F.lit(r).cast("long") for r in range(runs)])).alias("path"), F.lit(0).cast("long").alias("used"),
        "rec", "key", "version", "sig",
    )
    nodes, leaves = roots, []
    for depth in range(1, DEPTH + 1):
        members = staged(map_rows(nodes, split, MEMBER), "paths")
        shared = members.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        members = staged(members.join(shared, "path"), "buckets")
        small = members if depth == DEPTH else members.where(F.col("n") <= LEAF)
        leaves.append(small.drop("used"))
        large = members.where(F.col("n") > LEAF).drop("n")
        if depth == DEPTH or large.isEmpty():
            break
        nodes = large.join(records.select("rec", "sig"), "rec").select("path", "used", "rec", "key", "version", "sig")
    out = leaves[0]
    for more in leaves[1:]:
        out = out.union(more)
    return out


def compared(docs: DataFrame, leaves: DataFrame, id_col: str, text_col: str, n: int, similarity: float) -> DataFrame:
    """``rec, links, root`` from the exact comparison of every leaf."""
    blocks = F.when(F.col("n") <= LEAF, 1).otherwise(F.ceil(F.col("n") / BLOCK)).cast("int")
    own = leaves.groupBy("rec", "key", "version").agg(F.collect_list(F.struct("path", blocks.alias("blocks"))).alias("at"))
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("key"), F.xxhash64(text_col).alias("version"),
        F.col(text_col).alias("body"),
    )

    def spread(rows):
        for rec, at, body in rows:
            grams = ngram_set(body, n).tobytes()
            paths = np.array([a["path"] for a in at], "<i8").tobytes()
            for a in at:
                path, count = a["path"], a["blocks"]
                mine = int.from_bytes(rec[:4], "little") % count
                for other in range(count):
                    yield path, min(mine, other), max(mine, other), mine, rec, paths, grams

    def work(rows):
        for (path, x, y), group in groupby(rows, key=lambda r: r[:3]):
            held = {}
            for _, _, _, mine, rec, paths, grams in group:
                held[rec] = (mine, np.frombuffer(paths, "<i8").tolist(), np.frombuffer(grams, np.uint64))
            members = [[(rec, h[1], h[2]) for rec, h in sorted(held.items()) if h[0] == side] for side in (x, y)]
            if x == y:
                members[1] = []
            elif not members[1] or not members[0]:
                continue
            yield from compare(path, tuple(members), similarity)

    rows = map_rows(
        texts.join(own, ["key", "version"]).select("rec", "at", "body"), spread,
        "path long, x int, y int, mine int, rec binary, paths binary, grams binary",
    )
    grouped = rows.repartition("path", "x", "y").sortWithinPartitions("path", "x", "y")
    return map_rows(grouped, work, "rec binary, links long, root binary")


def near_duplicates(
    docs: DataFrame, n: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per document row ``key`` (the id, null as the least number), ``version`` (hash of the text),
    ``size`` (n-grams), ``class`` (its near-duplicate class, null without words), ``class_key``
    (least id of the class) and ``links`` (other n-gram sets at or above the similarity).
    """
    base = staged(records_of(docs, id_col, text_col, n), "ngram-records")
    records = staged(
        base.where("rec is not null").groupBy("rec")
        .agg(F.min(F.struct("key", "version")).alias("place"), F.first("sig").alias("sig")).select("rec", "place.*", "sig"),
        "records",
    )
    leaves = staged(leaves_of(records, runs_for(similarity, recall)), "leaves")
    found = staged(compared(docs, leaves, id_col, text_col, n, similarity), "links")
    links = found.groupBy("rec").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rec").alias("u"), F.col("root").alias("v")))
    grouped = staged(records.select("rec", "key").join(roots.withColumnRenamed("node", "rec"), "rec"), "classes")
    least = grouped.groupBy("root").agg(F.min("key").alias("class_key"))
    classes = grouped.join(least, "root").join(links, "rec").select("rec", "root", "class_key", "links")
    own = records.select("rec", F.col("key").alias("own_key")).join(classes, "rec", "left")
    return base.select("key", "version", "rec", "size").join(own, "rec", "left").select(
        "key", "version", "size", F.coalesce("root", "rec").alias("class"),
        F.coalesce("class_key", "own_key", "key").alias("class_key"), F.coalesce("links", F.lit(0)).alias("links"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row of ``docs`` for each near-duplicate class, the one with the least id, unchanged.

    Documents without words are in no class and stay.
    """
    named, (key, text) = numbered(docs, id_col, text_col)
    judged = near_duplicates(named, id_col=key, text_col=text, **settings)
    first = judged.where("size > 0").groupBy("class").agg(F.min(F.struct("key", "version")).alias("at")).select("at.*")
    places = named.withColumns({
        "key": F.coalesce(F.col(key).cast("long"), F.lit(LOWEST)), "version": F.xxhash64(text),
    })
    has_words = F.coalesce(F.col(text), F.lit("")).rlike("[^ \\t\\n\\x0B\\f\\r]")
    kept = places.where(has_words).join(first, ["key", "version"], "left_semi").dropDuplicates(["key", "version"])
    return kept.select(*named.columns).union(places.where(~has_words).select(*named.columns)).toDF(*docs.columns)
