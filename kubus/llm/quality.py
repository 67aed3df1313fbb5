"""Quality rules with thresholds learned per language and source.

Each document is measured once.  For every metric a mergeable quantile
sketch is kept per (language, source): counts over logarithmic buckets of
relative width ``ACCURACY``.  The sketch is a table and merging is addition,
so the same sketches serve every (language, source), every language and the
whole corpus, in any order and over any number of tasks.

A group's sketch is merged with its language's, scaled to ``PRIOR`` documents,
and a language's with the corpus's in the same way, so that few documents move
a fence little and many decide it, without a step in between.  The upper fence
lies ``REACH`` times the distance from median to upper quartile beyond that
quartile (for some metrics there is a lower one likewise).  Where the two
quantiles fall together, as with measures that most documents have none of,
the metric's ``room`` takes the place of the distance.  A group's fence never
lies beyond ``GROUP_FACTOR`` times its language's, and that one never beyond
``LANGUAGE_FACTOR`` times the corpus's: a source that is mostly junk cannot
open its own fence.  Documents beyond a fence are rejected by a join.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, word_blocks, written

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
_WORD = re.compile(r"[^\x20\x09-\x0d]")
_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_LETTER = bytes(b for b in range(128) if not chr(b).isalpha()) + bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Metric:
    """A document measure; ``room`` is the distance of the fence from the
    quartile where median and quartile fall together."""

    name: str
    value: str
    room: float
    lower: bool = False


METRICS = (
    Metric("symbols", "n_symbols / word_chars", 0.04),
    Metric("upper", "n_upper / greatest(n_letters, 1)", 0.16),
    Metric("word_length", "word_chars / n_words", 3.0, lower=True),
    Metric("dup_lines", "n_dup_lines / greatest(n_lines, 1)", 0.48),
    Metric("repeats", "n_repeat_words / n_words", 0.28),
    Metric("stutter", "n_stutter / n_words", 0.2),
)
REACH = 12.0
PRIOR = 50.0
GROUP_FACTOR, LANGUAGE_FACTOR = 1.5, 2.0

ACCURACY = 0.005
_GAMMA = math.log1p(ACCURACY)
_ZERO = -(1 << 30)


def _repeat_words(ids: np.ndarray) -> int:
    """Words that lie in a window of eight which occurs twice or more."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    hashes = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        for i in range(WINDOW):
            hashes = hashes * np.uint64(0xBF58476D1CE4E5B9) + mixed[i:i + n]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return 0
    # Equal hashes are only candidates; the windows themselves decide.
    candidates = np.sort(order[np.concatenate(([False], same)) | np.concatenate((same, [False]))])
    windows = np.lib.stride_tricks.sliding_window_view(ids, WINDOW)[candidates]
    _, inverse, counts = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    starts = candidates[counts[inverse.reshape(-1)] > 1]
    marks = np.zeros(len(ids) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + WINDOW, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    n_upper, n_letters, n_stutter (words equal to the word before) of a text;
    all 0 for null and empty texts."""
    if not text:
        return (0,) * 9
    data = text.encode()
    index: dict[bytes, int] = {}
    blocks = [np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
              for words in word_blocks(data)]
    ids = np.concatenate(blocks) if blocks else np.zeros(0, np.int64)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    spaces = len(data) - len(data.translate(None, SPACES))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return (len(ids), len(text) - spaces, symbols, len(lines) - len(set(lines)),
            _repeat_words(ids), len(lines), len(data.translate(None, _NOT_UPPER)),
            len(data.translate(None, _NOT_LETTER)), int((ids[1:] == ids[:-1]).sum()))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_upper", "n_letters", "n_stutter")


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([measure(t) for t in batch.column(4).to_pylist()],
                         dtype=np.int64).reshape(-1, len(MEASURES))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], *(pa.array(found[:, i]) for i in range(len(MEASURES)))],
            ["doc_id", "lang", "source", "text_hash", *MEASURES])


def measures(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, source, text_hash and MEASURES."""
    ship(docs.sparkSession)
    schema = ("doc_id long, lang string, source string, text_hash long, "
              + ", ".join(f"{m} long" for m in MEASURES))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"),
                       F.xxhash64("text").alias("text_hash"), F.col("text")) \
        .mapInArrow(_measures, schema)


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


# Null languages and sources are groups of their own; the mark keeps them
# apart from the rollup's nulls.
def _group(col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(col)), F.lit("null"))


def _bucket(value: Column) -> Column:
    return F.when(value > 0, F.ceil(F.log(value) / F.lit(_GAMMA)).cast("int")).otherwise(_ZERO)


def _bucket_value(bucket: Column) -> Column:
    return F.when(bucket == _ZERO, 0.0).otherwise(F.exp((bucket - 0.5) * F.lit(_GAMMA)))


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n) of the documents the base rules pass."""
    rows = measured.where(~base_failed()).select(
        _group("lang").alias("lang"), _group("source").alias("source"),
        F.explode(F.array(*[F.struct(F.lit(m.name).alias("metric"),
                                     _bucket(F.expr(m.value)).alias("bucket"))
                            for m in METRICS])).alias("m"))
    return rows.groupBy("lang", "source", "m.metric", "m.bucket").agg(F.count("*").alias("n"))


def _merged(sketch: DataFrame, by: list[str], docs: str, entries: str) -> DataFrame:
    """(by..., metric, docs, entries): merged sketches; a sketch has as many
    entries as its metric has buckets, whatever the number of documents."""
    return (sketch.groupBy(*by, "metric", "bucket").agg(F.sum("n").cast("double").alias("n"))
            .groupBy(*by, "metric").agg(F.sum("n").alias(docs), F.array_sort(
                F.collect_list(F.struct("bucket", "n"))).alias(entries)))


def _with_prior(entries: str, prior: str, prior_docs: str) -> Column:
    """A sketch plus another that is scaled to ``PRIOR`` documents."""
    scaled = F.transform(prior, lambda e: F.struct(
        e["bucket"].alias("bucket"), (e["n"] * (F.lit(PRIOR) / F.col(prior_docs))).alias("n")))
    return F.array_sort(F.concat(entries, scaled))


def _fences(entries: Column, docs: Column) -> Column:
    """struct(low, high) from the quartiles of sorted entries of ``docs`` in all."""
    shares = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    start = F.struct(F.lit(0.0).alias("n"), *[F.lit(None).cast("int").alias(q) for q in shares])

    def step(state: Column, entry: Column) -> Column:
        n = state["n"] + entry["n"]
        return F.struct(n.alias("n"), *[F.coalesce(state[q], F.when(n >= docs * share, entry["bucket"]))
                                        .alias(q) for q, share in shares.items()])

    # Sums of scaled counts may end a rounding short of the last bucket.
    last = F.element_at(entries, -1)["bucket"]

    def fences(state: Column) -> Column:
        q1, q2, q3 = (_bucket_value(F.coalesce(state[q], last)) for q in shares)
        params = F.create_map(*[x for m in METRICS for x in (
            F.lit(m.name), F.struct(F.lit(m.room).alias("room"), F.lit(m.lower).alias("lower")))])
        p = params[F.col("metric")]

        def room(distance: Column) -> Column:
            return F.when(distance > 0, distance * REACH).otherwise(p["room"])

        return F.struct(F.when(p["lower"], q1 - room(q2 - q1)).alias("low"),
                        (q3 + room(q3 - q2)).alias("high"))

    return F.aggregate(entries, start, step, fences)


def _held(fence: Column, bound: Column, factor: float) -> Column:
    return F.struct(F.greatest(fence["low"], bound["low"] / factor).alias("low"),
                    F.least(fence["high"], bound["high"] * factor).alias("high"))


def thresholds(measured: DataFrame) -> DataFrame:
    """(lang, source, limits): the fences of every group with a document that
    passes the base rules, as a map from metric to (low, high)."""
    finest = written(sketches(measured), "quality-sketches")
    corpus = _merged(finest, [], "all_docs", "all_entries") \
        .withColumn("all_fence", _fences(F.col("all_entries"), F.col("all_docs")))
    languages = _merged(finest, ["lang"], "lang_docs", "lang_entries").join(written(corpus, "quality-corpus"), "metric")
    languages = languages.withColumn("lang_fence", _held(
        _fences(_with_prior("lang_entries", "all_entries", "all_docs"), F.col("lang_docs") + PRIOR),
        F.col("all_fence"), LANGUAGE_FACTOR)).drop("all_docs", "all_entries", "all_fence")
    groups = _merged(finest, ["lang", "source"], "docs", "entries") \
        .join(written(languages, "quality-languages"), ["lang", "metric"])
    fence = _held(_fences(_with_prior("entries", "lang_entries", "lang_docs"), F.col("docs") + PRIOR),
                  F.col("lang_fence"), GROUP_FACTOR)
    return groups.select("lang", "source", "metric", fence.alias("fence")).groupBy("lang", "source").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "fence"))).alias("limits"))


def verdicts(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, MEASURES, base_failed,
    ``broken`` (names of the metrics beyond a fence) and kept.

    Null and empty texts have no words and fail the base rules; null
    languages and sources form groups of their own; repeated rows are
    measured and judged each; an empty table gives an empty result.
    """
    measured = written(measures(docs), "quality-measures")
    limits = written(thresholds(measured), "quality-limits")
    judged = measured.select("*", _group("lang").alias("_lang"), _group("source").alias("_source")) \
        .join(limits.withColumnsRenamed({"lang": "_lang", "source": "_source"}),
              ["_lang", "_source"], "left")

    def outside(m: Metric) -> Column:
        value, limit = F.expr(m.value), F.col("limits")[m.name]
        return F.when((value > limit["high"]) | (value < limit["low"]), F.lit(m.name))

    broken = F.when(base_failed(), F.array().cast("array<string>")).otherwise(
        F.array_compact(F.array(*[outside(m) for m in METRICS])))
    return judged.select("doc_id", "text_hash", "lang", "source", *MEASURES,
                         base_failed().alias("base_failed"), broken.alias("broken")) \
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns, which may have
    any names; null and empty texts go, repeated rows are judged alike, an
    empty table stays empty."""
    # A verdict depends on text, language and source only, so equal rows agree.
    passed = written(verdicts(docs).where("kept").groupBy(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
        F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(F.lit(1).alias("_one")),
        "quality-passed")
    return docs.join(passed, docs["doc_id"].eqNullSafe(passed["_id"])
                     & (F.xxhash64(docs["text"]) == passed["_hash"])
                     & docs["lang"].eqNullSafe(passed["_lang"])
                     & docs["source"].eqNullSafe(passed["_source"]), "left_semi")
