"""Quality rules whose cutoffs come from labelled holdouts with exact binomial bounds.

Every document gets counts (:func:`measure`) and, from them, one severity of 0 to 100 per rule.
A rule rejects a document whose severity reaches the cutoff of the document's stratum.
:func:`choose_cutoffs` certifies cutoffs: with probability ``1 - error`` over the draw of the
labelled rows, in *no* stratum the certified cutoffs of all rules together reject more than
``limit`` of the good documents that pass the base rules. Good documents that fail the base rules
don't count: these rules are fixed, hold without labels and reject whatever the cutoffs are.

As a document goes if any rule hits, each rule has an equal share of the limit, ``limit`` divided
by the number of rules, whichever documents the rules hit. The test is exact: a cutoff that rejects
x of n good labelled documents has the p-value P(Binomial(n, share) <= x). Within one stratum and rule the cutoffs are tested from the most
lenient to the strictest and testing ends at the first failure (fixed-sequence testing, which
needs no correction); across strata and rules the error is divided by their number (Bonferroni).
Where the labels are too few to certify anything, the rule stays idle in that stratum.

Defined results: null and empty texts have no words and fail the base rules; a null stratum is
a stratum of its own; labels for unknown documents and null labels are ignored; a document with
several labels counts once, as good if any of them says so; repeated rows are measured each.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.llm.rows import ddl, map_rows, numbered
from tidestock.session import staged

#: Plain base rules, applied before the certified ones.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
WINDOW = 5
SYMBOLS = re.compile(r"[#*$%&|<>]")
COUNTS = ["word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_shouts long, base_failed boolean, symbols int, shouting int, repetition int"
)
RULES = ["symbols", "shouting", "repetition"]
STEPS = 100
#: Strata up to which the cutoffs are broadcast; beyond, they are joined by shuffle.
MAX_BROADCAST = 10_000


def repeated_words(words: list) -> int:
    """Words inside any 5-word window that the text has twice or more, first one included."""
    windows = list(zip(*(words[k:] for k in range(WINDOW))))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = reach = 0
    for start, window in enumerate(windows):
        if counts[window] > 1:
            covered += start + WINDOW - max(reach, start)
            reach = start + WINDOW
    return covered


def repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those among them that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    return len(lines), len(lines) - len(set(lines))


def measured(text: str | None) -> tuple:
    """Counts, base verdict and severities of one text (null: no words)."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # splits at space, \t, \n, \v, \f and \r only, as asked for
    n = len(words)
    chars = len(text) - len(raw) + len(raw.translate(None, b" \t\n\r\x0b\x0c"))  # all but the separators
    symbols = len(SYMBOLS.findall(text))
    lines, dup_lines = repeated_lines(raw)
    repeats = repeated_words(words)
    shouts = sum(1 for w in words if len(w) > 3 and w.isupper())
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    share = lambda part, whole: min(STEPS, STEPS * part // max(1, whole))
    return (
        n, chars, symbols, dup_lines, repeats, lines, shouts, failed,
        share(symbols, chars), share(shouts, n), max(share(repeats, n), share(dup_lines, lines)),
    )


def measure(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", keep: tuple[str, ...] = (),
) -> DataFrame:
    """One scan: ``id_col``, the ``keep`` columns, ``stratum`` and the measures of every document."""
    source = docs.select(*dict.fromkeys([id_col, *keep]), F.col(stratum_col).cast("string").alias("stratum"), F.col(text_col).alias("_text"))

    def work(rows):
        for *own, text in rows:
            yield (*own, *measured(text))

    return map_rows(source, work, f"{ddl(source.drop('_text'))}, {MEASURES}")


def binomial_tail(successes: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= successes), summed in logs."""
    if successes >= n:
        return 1.0
    log = lambda k: (
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    top = max(log(k) for k in (min(successes, int(n * p)), successes))
    return min(1.0, math.exp(top) * math.fsum(math.exp(log(k) - top) for k in range(successes + 1)))


def certified(good: list[int], bad: list[int], limit: float, error: float) -> int | None:
    """Cutoff of one stratum and rule from label counts by severity 0 to 100, or None.

    Among the cutoffs certified at ``error``, the one with the largest difference between the
    rejected shares of bad and good documents; the most lenient of equals.
    """
    n, m = sum(good), max(1, sum(bad))
    best, choice = 0.0, None
    false = caught = 0
    for cutoff in range(STEPS, 0, -1):
        false += good[cutoff]
        caught += bad[cutoff]
        if not n or binomial_tail(false, n, limit) > error:
            break
        gain = caught / m - false / n
        if gain > best:
            best, choice = gain, cutoff
    return choice


def choose_cutoffs(
    measures: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
    limit: float = 0.10, error: float = 0.05,
) -> DataFrame:
    """``stratum, rule, cutoff`` for every stratum and rule with a certified cutoff.

    ``limit`` holds for what all rules of a stratum reject together, each having an equal share.
    Label counts by severity are aggregated over all labelled documents; each group that then
    reaches Python holds at most 101 rows.
    """
    marked = (
        labels.where(F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_good"))
    )
    sides = measures.where(~F.col("base_failed")).join(marked, F.col(id_col) == F.col("_id"))
    long = sides.select("stratum", "_good", F.explode(F.create_map(*[
        x for r in RULES for x in (F.lit(r), F.col(r))
    ])).alias("rule", "severity"))
    counts = long.groupBy("stratum", "rule", "severity").agg(
        F.sum("_good").alias("good"), F.sum(1 - F.col("_good")).alias("bad")
    )
    tests = max(1, counts.select("stratum", "rule").distinct().count())

    def choose(key, table):
        good, bad = [0] * (STEPS + 1), [0] * (STEPS + 1)
        for severity, g, b in zip(table["severity"], table["good"], table["bad"]):
            good[severity], bad[severity] = int(g), int(b)
        cutoff = certified(good, bad, limit / len(RULES), error / tests)
        table = table.iloc[:1][["stratum", "rule"]].copy()
        table["cutoff"] = [cutoff or STEPS + 1]
        return table

    return (
        counts.groupBy("stratum", "rule")
        .applyInPandas(choose, "stratum string, rule string, cutoff int")
        .where(F.col("cutoff") <= STEPS)
    )


def judge(measures: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds ``kept``: false where a base rule fails or a severity reaches its stratum's cutoff."""
    wide = staged(cutoffs.groupBy(F.col("stratum").alias("_stratum")).agg(*[
        F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_{r}") for r in RULES
    ]), "quality-cutoffs")
    small = wide.count() <= MAX_BROADCAST
    joined = measures.join(
        F.broadcast(wide) if small else wide, F.col("stratum").eqNullSafe(F.col("_stratum")), "left"
    )
    hit = F.lit(False)
    for r in RULES:
        hit = hit | F.coalesce(F.col(r) >= F.col(f"_{r}"), F.lit(False))
    return joined.withColumn("kept", ~(F.col("base_failed") | hit)).drop("_stratum", *[f"_{r}" for r in RULES])


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged."""
    named, (key, text, stratum) = numbered(docs, id_col, text_col, stratum_col)
    measures = staged(measure(named, key, text, stratum, keep=tuple(named.columns)), "quality-measures")
    marks = labels.select(F.col(id_col).alias(key), "quality")
    judged = judge(measures, choose_cutoffs(measures, marks, key))
    return judged.where("kept").select(*named.columns).toDF(*docs.columns)
