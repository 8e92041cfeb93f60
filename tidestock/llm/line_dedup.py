"""Line dedup by a deletion-neighbourhood join: a line goes if an earlier one is within one edit.

Lines are what newlines separate. A line of at least ``min_chars`` code points is removed if an
earlier line of the corpus, by document id and line number, is equal or one code point edit
(insertion, deletion, substitution) away, judged on the input, not on what is left. Shorter lines stay.

1. Equal lines are aggregated by hash to their earliest place.
2. Of two lines within one edit, either the first or the second half is the same in both. Every
   line emits four half keys (its own length and one less); lines that share none with another line
   have no partner and emit nothing more.
3. The others emit their deletion neighbourhood: the line and each variant without one code point,
   as hashed keys. Equal variants meet: variants without the same place are substitutions, a variant
   equal to a whole line is an insertion. The earliest of a key is witness for all others there, so a
   key yields a row for each line, never pairs; distinct lines with a common variant are bounded by
   its length times the alphabet.
4. Witnesses are verified by edit distance on the texts; the earliest line of each kind is kept.

Defined results: null texts stay null and have no lines, an empty text is one empty line; rows with
equal id and text are one document and get the same result; a null id comes first; of documents
with equal id and other texts the text's hash decides which is earlier.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidestock.llm.rows import ddl, map_rows, numbered
from tidestock.session import staged

MIN_CHARS = 20
LOWEST = -(1 << 63)


def line_hash(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode())


def half_keys(line: str) -> list[int]:
    """Keys of both halves, cut as for partners of the same length and of one code point less or more."""
    keys = []
    for length in (len(line), len(line) - 1):
        head = length // 2
        for seed, part in ((0, line[:head]), (1, line[len(line) - (length - head):])):
            keys.append(xxhash.xxh3_64_intdigest(part.encode(), seed=2 * length + seed) - (1 << 63))
    return keys


def variant_keys(line: str) -> np.ndarray:
    """Hash of the whole line, then of the line without its first, second, ... code point.

    A hash is a sum of mixed (code point, place) pairs, so each variant is a prefix sum at the own places
    plus a suffix sum at the places before, and the work is linear in the line's length.
    """
    n = len(line)
    codes = np.frombuffer(line.encode("utf-32-le"), "<u4").astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)

    def mixed(first: int) -> np.ndarray:
        x = codes + np.arange(first, first + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(33))

    own, moved = np.zeros(n + 1, np.uint64), np.cumsum(mixed(0))
    np.cumsum(mixed(1), out=own[1:])
    keys = np.concatenate([own[n:], own[:n] + (moved[-1:] - moved)])
    keys[0] += np.uint64(n)
    keys[1:] += np.uint64(n - 1)  # the length keeps shorter lines apart
    keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (keys ^ (keys >> np.uint64(32))).view(np.int64)


def earliest_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """Distinct lines with their earliest place and half keys."""

    def emit(rows):
        for key, version, text in rows:
            for number, line in enumerate(text.split("\n")):
                if len(line) >= min_chars:
                    yield line_hash(line), key, version, number, half_keys(line)

    lines = map_rows(
        docs.where("text is not null").select("key", "version", "text"), emit,
        "h binary, key long, version long, line int, halves array<long>",
    )
    return lines.groupBy("h").agg(
        F.min(F.struct("key", "version", "line")).alias("place"), F.first("halves").alias("halves")
    ).select("h", "place.*", "halves")


def with_text(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """Adds the line's text, read from the document of its earliest place."""
    wanted = lines.groupBy("key", "version").agg(F.collect_list(F.struct("line", "h")).alias("wanted"))

    def cut(rows):
        for key, version, text, wanted in rows:
            split = text.split("\n")
            for w in wanted:
                yield w["h"], key, version, w["line"], split[w["line"]]

    joined = docs.join(wanted, ["key", "version"]).select("key", "version", "text", "wanted")
    return map_rows(joined, cut, "h binary, key long, version long, line int, body string").dropDuplicates(["h"])


def near_copies(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``h`` of the distinct lines that have an earlier line within one edit."""
    halves = lines.select("h", "key", "version", "line", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").count().where("count > 1")
    partnered = halves.join(shared, "half", "left_semi").dropDuplicates(["h"]).drop("half")
    texts = staged(with_text(docs, partnered), "line-texts")

    def emit(rows):
        for h, key, version, line, body in rows:
            for place, variant in enumerate(variant_keys(body).tolist(), -1):
                yield variant, place, h, key, version, line

    variants = map_rows(texts, emit, "variant long, place int, h binary, key long, version long, line int")
    order = F.struct("key", "version", "line", "h")
    whole = F.col("place") < 0
    same_place, same_variant = Window.partitionBy("variant", "place"), Window.partitionBy("variant")
    marked = variants.withColumn("own", order).select(
        "h", "own", whole.alias("whole"),
        F.min("own").over(same_place).alias("replaced"),
        F.min(F.when(whole, F.col("own"))).over(same_variant).alias("shorter"),
        F.min(F.when(~whole, F.col("own"))).over(same_variant).alias("longer"),
    )
    earlier = lambda c, on: F.when(on & (F.col(c) < F.col("own")), F.col(f"{c}.h"))
    pairs = marked.select("h", F.explode(F.array_compact(F.array(
        earlier("replaced", ~F.col("whole")), earlier("shorter", ~F.col("whole")), earlier("longer", F.col("whole")),
    ))).alias("witness")).distinct()
    bodies = texts.select("h", "body")
    verified = (
        pairs.join(bodies, "h")
        .join(bodies.select(F.col("h").alias("witness"), F.col("body").alias("earlier")), "witness")
        .where(F.levenshtein("body", "earlier", 1) >= 0)
    )
    return verified.select("h").distinct()


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, str, str]:
    """``docs`` with the removed lines cut from ``text_col``, and the names of two added columns.

    The added columns hold each document's number of lines and of removed lines.
    """
    named, (key, text) = numbered(docs, id_col, text_col)
    places = named.withColumns({
        "key": F.coalesce(F.col(key).cast("long"), F.lit(LOWEST)), "version": F.xxhash64(text),
    })
    own = places.select("key", "version", F.col(text).alias("text"))
    lines = staged(earliest_lines(own, min_chars), "line-places")
    kept = lines.join(near_copies(own, lines), "h", "left_anti")
    kept = kept.groupBy("key", "version").agg(F.collect_set("line").alias("kept"))
    at = named.columns.index(text)

    def cut(rows):
        for *values, kept in rows:
            if values[at] is None:
                yield (*values, 0, 0)
                continue
            stay = set(kept or ())
            split = values[at].split("\n")
            left = [x for k, x in enumerate(split) if len(x) < min_chars or k in stay]
            values[at] = "\n".join(left)
            yield (*values, len(split), len(split) - len(left))

    counts = [f"c{len(docs.columns)}", f"c{len(docs.columns) + 1}"]
    joined = places.join(kept, ["key", "version"], "left").select(*named.columns, "kept")
    out = map_rows(joined, cut, f"{ddl(named)}, {counts[0]} long, {counts[1]} long")
    added = [n + "_" * (n in docs.columns) for n in ("n_lines", "n_removed")]
    return out.toDF(*docs.columns, *added), *added
