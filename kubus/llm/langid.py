"""Language identification by error-correcting output codes.

Every learned language gets a codeword; one binary classifier per bit, a
log-ratio model over hashed byte trigrams, predicts that bit's margin.
Decoding weighs each bit by the exponential loss of its margin and takes the
codeword with the least loss; a text whose two best codewords are nearly as
good is flagged as ambiguous.

Learning needs trigram counts per language only, so it is one aggregation
over a bounded sample: about ``sample_docs`` labelled rows per language,
chosen by hash.  Prediction reads every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_mod, ship, word_blocks, written

UNKNOWN = "und"
BUCKETS = 1 << 14
SAMPLE_DOCS = 4000
AMBIGUOUS = 0.6
_LETTER = re.compile(r"[^\W\d_]")
# ASCII letters in lower case, other ASCII as blanks, all other bytes kept.
_TABLE = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 32
               for b in range(256))


def has_letter(text: str) -> bool:
    """Has it a character of a letter category?  Number signs are none."""
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def trigram_blocks(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of a text's byte trigrams over its words."""
    for words in word_blocks(text.encode("utf-8", "replace").translate(_TABLE)):
        if words:
            data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
            code = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
            yield (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)


def codewords(n: int) -> np.ndarray:
    """n codewords of +1 and -1: all distinct splits of up to five languages,
    beyond that the widest apart of several hashed codes of 10 log2(n) bits."""
    if n < 2:
        return np.ones((n, 0), np.int8)
    if n <= 5:
        bits = np.array([[(s >> i) & 1 for s in range(1, 1 << (n - 1))] for i in range(n)])
        return (2 * bits - 1).astype(np.int8)
    length = int(np.ceil(10 * np.log2(n)))
    best, best_gap = None, -1
    for seed in range(64):
        code = np.array([[1 if xxhash.xxh64_intdigest(f"{i}:{b}", seed) & 1 else -1
                          for b in range(length)] for i in range(n)], np.int8)
        code = code[:, np.abs(code.sum(axis=1 - 1)) < n]  # a constant bit tells nothing
        gaps = (code.shape[1] - code.astype(int) @ code.T.astype(int)) // 2
        gap = int((gaps + np.eye(n, dtype=int) * length).min())
        if gap > best_gap:
            best, best_gap = code, gap
    return best


@dataclass(frozen=True)
class Model:
    """``weights``: per bucket and bit the log ratio; ``code``: per language
    its codeword."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray

    @classmethod
    def from_counts(cls, languages: list[str], counts: np.ndarray) -> "Model":
        """From trigram counts (languages x buckets), every language as likely."""
        code = codewords(len(languages))
        share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
        weights = np.stack([np.log(share[bit > 0].mean(axis=0) / share[bit < 0].mean(axis=0))
                            for bit in code.T], axis=1) if code.size else np.zeros((BUCKETS, 0))
        return cls(tuple(languages), code, weights.astype(np.float32))

    def margins(self, text: str) -> np.ndarray:
        """Per bit the log ratio over the whole text, damped for its length."""
        total, n = np.zeros(self.code.shape[1]), 0
        for buckets in trigram_blocks(text):
            total += self.weights[buckets].sum(axis=0, dtype=np.float64)
            n += len(buckets)
        return total / np.sqrt(n + 1.0)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous); the score is the best codeword's
        share of the inverse losses."""
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        z = np.clip(self.code * self.margins(text), -20, 20)
        loss = np.exp(-z).mean(axis=1)
        likely = 1 / loss
        score = likely / likely.sum()
        best = int(np.argmin(loss))
        return self.languages[best], float(score[best]), bool(score[best] < AMBIGUOUS)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for buckets in trigram_blocks(text):
                total += np.bincount(buckets, minlength=BUCKETS)
    for lang, total in totals.items():
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(own), pa.string()), pa.array(own), pa.array(total[own])],
            ["lang", "bucket", "n"])


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Model of the non-null ``lang`` values of ``labelled`` (text, lang and,
    if it has one, doc_id, which only keeps copies of a text apart in the draw).

    The model has languages x ``BUCKETS`` counts; a language of which no row is
    drawn cannot be predicted.
    """
    ship(labelled.sparkSession)
    drawn = [c for c in ("doc_id", "text") if c in labelled.columns]
    rows = labelled.select(F.col("lang").cast("string").alias("lang"), *drawn) \
        .where("lang is not null and text is not null")
    sizes = written(rows.groupBy("lang").agg(F.count("*").alias("docs")), "langid-sizes")
    # A hash of id and text picks about sample_docs of each language's rows.
    unit = F.pmod(F.xxhash64(*drawn), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.join(sizes, "lang").where(unit * F.col("docs") < sample_docs)
    counted = sample.select("lang", "text").mapInArrow(_counts, "lang string, bucket long, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # One row per language and bucket: bounded by the number of languages.
    found = counted.collect()
    languages = sorted({r["lang"] for r in found})
    counts = np.zeros((len(languages), BUCKETS))
    for r in found:
        counts[languages.index(r["lang"]), r["bucket"]] = r["n"]
    return Model.from_counts(languages, counts)


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [model.predict(t) for t in batch.column(2).to_pylist()]
        lang, score, ambiguous = zip(*found) if found else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(lang, pa.string()),
             pa.array(score, pa.float64()), pa.array(ambiguous, pa.bool_())],
            ["doc_id", "held_out", "lang_pred", "score", "ambiguous"])


def identify(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) for every row.

    Rows with crc32(doc_id) mod 3 = 1 are held out of learning.  Null texts
    and texts without letters are ``und`` with score 0, as is everything if
    nothing could be learned; a null doc_id is not held out; repeated rows
    give a row each; an empty table gives an empty result; other columns
    are not read.
    """
    held_out = F.coalesce(crc32_mod("doc_id", 3) == 1, F.lit(False))
    model = learn(docs.where(~held_out).select("doc_id", "text", "lang"), sample_docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"),
                       "text").mapInArrow(
        partial(_predict, model=model),
        "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")
