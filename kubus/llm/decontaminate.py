"""Benchmark decontamination by template windows.

A text's words become a template: numbers, units after numbers and names
(capitalised words inside a sentence) turn into typed placeholders, all other
words into their lower-case letters.  Windows of five template words are
hash-joined between documents and benchmark items, so a question asked with
other numbers or names still meets its item.  The placeholders' fillings then
have to agree: where the item lies in the document (document position minus
item position, give or take a few words), each filling of the item must map to
one filling of the document.  An item's window counts if any place of the
document holds it with the item's own fillings or with the majority's mapping
there.  A window with fewer than three ordinary words would meet too much as a
template; it is widened to the right and to the left until it holds three, and
its plain words are a window of their own, met only by the same words.  An item
of fewer than five words is one such window.  A document with at least
``min_share`` of an item's windows, or with ``MIN_RUN`` of them in a row, holds
it.

Texts that share or run on with the item's own fillings are settled by joins on
whole windows and on hashes of ``MIN_RUN`` windows, in which a place does not
matter.  Only the other pairs that meet enough positions of the item meet place
by place: at most the text's windows of a template times the item's, per pair.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, word_blocks, written

WINDOW = 5
MIN_LITERALS = 3
MIN_SHARE = 0.5
MIN_RUN = 9  # windows, hence 13 words in a row
WIDEST = 16  # words of a widened window
BAND = 8  # alignments that vote together; two bands overlap by half
FILTER_BITS = 22
NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
UNITS = frozenset(
    "mm cm dm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec min h hr hour hours day days "
    "week weeks month months year years minute minutes second seconds meter meters metre metres "
    "kilometer kilometers kilometre kilometres mile miles inch inches foot feet gram grams "
    "kilogram kilograms pound pounds ounce ounces liter liters litre litres dollar dollars euro "
    "euros cent cents percent degree degrees usd eur gbp kmh mph hz khz mhz ghz w kw kwh v kv "
    "kb mb gb tb".split())
_EDGES = re.compile(r"^\W+|\W+$")
_SIGNS = re.compile(r"[^\w]+")
_CLOSING = "\"')]\u00bb\u201d\u2019"
_STOPS = frozenset(".!?:")
_ENDINGS = frozenset(".,;:!?")
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_CACHE = 300_000
BLOCK = 1 << 16  # bytes of a text that are looked at together


def _bare(raw: bytes) -> str:
    """A raw word without the signs around it."""
    word = raw.decode("utf-8", "replace")
    # The usual word, alone or before one sign, needs no pattern.
    bare = word if word.isalpha() else word[:-1] if word[-1] in _ENDINGS else ""
    if bare.isalpha():
        return bare
    return word if word.isalnum() else _EDGES.sub("", word)


def _literal(bare: str) -> str:
    return (bare if bare.isalpha() else _SIGNS.sub("", bare)).lower()


def _odd_form(raw: bytes) -> tuple[bytes, bool, bool, bool, bool]:
    """Literal form; is a number, a unit, a name; ends a sentence: of any word."""
    word, bare = raw.decode("utf-8", "replace"), _bare(raw)
    literal = _literal(bare)
    number = not literal.isalpha() and any(map(str.isdigit, literal))
    return (literal.encode("utf-8", "replace"), number, literal in UNITS,
            bare[:1].isupper() and not number,
            word[-1] in _STOPS or word[-1] in _CLOSING and word.rstrip(_CLOSING)[-1:] in _STOPS)


_FACTOR = 0x9FB21C651E98DF25


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's factor and of its inverse modulo 2^64."""
    return tuple(np.cumprod(np.array([1] + [f] * n, np.uint64))
                 for f in (_FACTOR, pow(_FACTOR, -1, 1 << 64)))


_USUAL_POWERS = _powers(2 * BLOCK)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of bytes, in which zero bytes at the end do not
    count.  They only choose filter bits; the joins compare the words themselves."""
    up, down = _USUAL_POWERS if len(data) < len(_USUAL_POWERS[0]) else _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * up[:len(data)], out=sums[1:])
    found = (sums[ends] - sums[starts]) * down[starts]
    found = (found ^ (found >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return found ^ (found >> np.uint64(29))


def _hashes_of(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    return _hashes(np.frombuffer(b"".join(words), np.uint8), np.concatenate(([0], ends[:-1])), ends)


class _OddWords:
    """Forms of words that are not just ASCII letters, remembered per worker process."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        # As _odd_form, the literal form hashed.
        self.columns = (np.zeros(1024, np.uint64), *(np.zeros(1024, bool) for _ in range(4)))

    def forms(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        found = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            unseen = [words[i] for i in missing.tolist()]
            new = list(dict.fromkeys(unseen))
            if self.index and len(self.index) + len(new) > _CACHE:
                self.clear()
                return self.forms(words)
            self._add(new)
            found[missing] = np.fromiter(map(self.index.__getitem__, unseen), np.int64, len(unseen))
        return tuple(c[found] for c in self.columns)

    def _add(self, new: list[bytes]) -> None:
        first, size = len(self.index), len(self.index) + len(new)
        self.index.update(zip(new, range(first, size)))
        if size > len(self.columns[0]):
            self.columns = tuple(np.concatenate((c, np.zeros(max(size, len(c)), c.dtype)))
                                 for c in self.columns)
        literals, *flags = zip(*map(_odd_form, new))
        for column, values in zip(self.columns, (_hashes_of(literals), *flags)):
            column[first:size] = values


_odd_words = _OddWords()
_UNIT_HASHES = np.sort(_hashes_of([u.encode() for u in sorted(UNITS)]))
_KIND_HASHES = _hashes_of([k.encode() for k in (NUMBER, UNIT, NAME)])
_IN_WORD = ~np.isin(np.arange(256), list(b"\x20\x09\x0a\x0b\x0c\x0d"))
_IS_ENDING, _IS_STOP = (np.isin(np.arange(256), [ord(c) for c in signs]) for signs in (_ENDINGS, _STOPS))


def _forms(data: bytes, at: int, stop: int) -> tuple[np.ndarray, ...]:
    """Of the words in a stretch of a text that begins and ends between words:
    first byte, end, hash of the literal form; is a number, a unit, a name; ends
    a sentence.  Words of ASCII letters, alone or before one sign, are told by
    their bytes all at once, the others are looked up."""
    raw = np.frombuffer(data, np.uint8, stop - at, at)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = _IN_WORD[raw]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    lower = raw | 0x20
    letter = (lower >= 97) & (lower <= 122)
    letters = np.zeros(len(raw) + 1, np.int32)
    np.cumsum(letter, out=letters[1:])
    other = ends - starts - (letters[ends] - letters[starts])
    first, last = raw[starts], raw[ends - 1]
    plain = (other == 0) | (other == 1) & (ends - starts > 1) & _IS_ENDING[last]
    hashes = _hashes(lower * letter, starts, ends)  # a last sign is a zero byte
    number, closes = np.zeros(len(starts), bool), _IS_STOP[last]
    unit, name = np.zeros(len(starts), bool), (first >= 65) & (first <= 90)
    nearest = np.minimum(np.searchsorted(_UNIT_HASHES, hashes), len(_UNIT_HASHES) - 1)
    for i in np.flatnonzero(plain & (_UNIT_HASHES[nearest] == hashes)).tolist():
        unit[i] = _literal(_bare(data[at + starts[i]:at + ends[i]])) in UNITS
    odd = np.flatnonzero(~plain)
    if len(odd):
        found = _odd_words.forms([data[i:j] for i, j in zip((at + starts[odd]).tolist(),
                                                            (at + ends[odd]).tolist())])
        for column, values in zip((hashes, number, unit, name, closes), found):
            column[odd] = values
    return at + starts, at + ends, hashes, number, unit, name, closes


def _blocks(data: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """``_forms`` of a whole text, about ``BLOCK`` bytes at a time."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + BLOCK)
        stop = cut.start() if cut else len(data)
        yield _forms(data, at, stop)
        at = stop


_POWERS = np.cumprod(np.full(WIDEST, 0xD6E8FEB86659FD93, np.uint64))


def _spans(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of spans of at most ``WIDEST`` words."""
    at = np.arange(WIDEST)
    own = codes[np.minimum(starts[:, None] + at, len(codes) - 1)] * _POWERS
    return (own * (at < sizes[:, None])).sum(axis=1, dtype=np.uint64)


def windows(data: bytes | None, bits: np.ndarray | None = None, short: tuple[int, ...] = ()
            ) -> Iterator[tuple[int, int, int, str, tuple[str, ...]]]:
    """(slot, position, start, template, fillings) of a text's windows whose
    slot, if ``bits`` are given, is in them.  Each position has its five words'
    template or, with fewer than ``MIN_LITERALS`` ordinary words, the widened
    windows that begin or end with them (from ``start``) and the plain words.
    The text's first window and those that begin with a name have plain words
    too, as the first word's kind depends on what stands before.  Spans of the
    ``short`` numbers of words are given once each, as plain words."""
    seen: set[str] = set()
    data = data or b""
    blocks = _blocks(data)
    block, kept = next(blocks, None), None
    before = skip = 0  # words before the kept ones; positions there that are done or lack context
    while block is not None:
        words = block if kept is None else tuple(map(np.concatenate, zip(kept, block)))
        kept, block = words, next(blocks, None)
        first, stops, hashes, number, unit, name, ends = words
        n_words = len(first)
        # Positions up to ``last`` see all words they may need.
        last = n_words - (WIDEST if block is not None else 0)
        if last <= skip:
            continue
        kind = np.zeros(n_words, np.int8)
        kind[1:][name[1:] & ~ends[:-1]] = 3
        kind[1:][unit[1:] & number[:-1]] = 2
        kind[number] = 1
        codes = np.where(kind > 0, _KIND_HASHES[kind - 1], hashes)
        n = max(0, min(last, n_words - WINDOW + 1))
        rolled = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(WINDOW):
                rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + codes[i:i + n]
        literals = np.concatenate(([0], np.cumsum(kind == 0)))
        good = (literals[WINDOW:] - literals[:-WINDOW])[:n] >= MIN_LITERALS
        own = np.arange(skip, max(n, skip))
        usual, heavy = own[good[skip:]], own[~good[skip:]]
        # (positions, starts, words, hashes, plain words) of each sort of window.
        sorts = [(usual, usual, np.full(len(usual), WINDOW), rolled[usual], False)]
        if len(heavy):
            stop = np.searchsorted(literals, literals[heavy] + MIN_LITERALS)
            begin = np.searchsorted(literals, literals[heavy + WINDOW] - MIN_LITERALS, "right") - 1
            for at, start, size in ((heavy, heavy, stop - heavy),
                                    (heavy, begin, heavy + WINDOW - begin)):
                fits = (size <= WIDEST) & (start >= 0) & (start + size <= n_words)
                at, start, size = at[fits], start[fits], size[fits]
                sorts.append((at, start, size, _spans(codes, start, size), False))
        bare_too = own[~good[skip:] | (kind[skip:n] == 3) | (before + own == 0)]
        for size, at in [(WINDOW, bare_too), *((k, np.arange(skip, max(
                skip, min(last, n_words - k + 1)))) for k in short)]:
            if len(at):
                sizes = np.full(len(at), size)
                sorts.append((at, at, sizes, _spans(hashes, at, sizes) ^ np.uint64(size << 44), True))
        met = []
        for k, (positions, _, _, spans, _) in enumerate(sorts):
            slots = (spans >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            hits = np.arange(len(slots)) if bits is None else np.flatnonzero(bits[slots])
            met += zip(positions[hits].tolist(), [k] * len(hits), hits.tolist(), slots[hits].tolist())
        for position, k, j, slot in sorted(met):
            start, size, plain = int(sorts[k][1][j]), int(sorts[k][2][j]), sorts[k][4]
            kinds = kind[start:start + size].tolist()
            bare = [_bare(data[a:b]) for a, b in zip(first[start:start + size].tolist(),
                                                     stops[start:start + size].tolist())]
            if plain:
                template, fillings = f"={size} " + " ".join(b.lower() for b in bare), ()
                if size < WINDOW and template in seen:
                    continue
                seen.update([template] if size < WINDOW else [])
            else:
                template = " ".join((NUMBER, UNIT, NAME)[f - 1] if f else
                                    _literal(b) for f, b in zip(kinds, bare))
                fillings = tuple(b for f, b in zip(kinds, bare) if f)
            yield slot, before + position, before + start, template, fillings
        # The words before a position may widen its window and tell its kind.
        keep = max(0, last - WIDEST - 1)
        kept, before, skip = tuple(c[keep:] for c in words), before + keep, last - keep


def _short(data: bytes | None) -> tuple[int, ...]:
    """The number of words of an item of fewer than five, if they say anything."""
    n = 0
    for block in word_blocks(data or b""):
        n += len(block)
        if n >= WINDOW:
            return ()
    return (n,) if n and re.search(r"[^\W_]", data.decode("utf-8", "replace")) else ()


def _run_keys(rows: list[tuple[int, int, str, tuple[str, ...]]]) -> dict[int, str]:
    """For a position that begins ``MIN_RUN`` windows in a row, which begin
    where they stand: a hash of these windows with their fillings."""
    own = {at: f"{template}\0{chr(1).join(fillings)}" for at, start, template, fillings in rows
           if at == start and not template.startswith("=")}
    return {at: xxhash.xxh3_128_hexdigest("\0\0".join(own[at + i] for i in range(MIN_RUN)))
            for at in own if all(at + i in own for i in range(1, MIN_RUN))}


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for item_id, item, text in zip(*(c.to_pylist() for c in batch.columns)):
            short = _short(text)
            found = list(windows(text, short=short))
            runs = _run_keys([w[1:] for w in found])
            rows += [(item_id, item, slot, at, start, sum(short), t, list(f), runs.get(at))
                     for slot, at, start, t, f in found]
        yield _batch(rows, [pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string(),
                            pa.list_(pa.string()), pa.string()],
                     ["item_id", "item", "slot", "at", "start", "short", "template", "fillings", "run"])


def _document_windows(batches: Iterator[pa.RecordBatch], bits: np.ndarray,
                      short: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text_hash, text in zip(*(c.to_pylist() for c in batch.columns)):
            found = list(windows(text, bits, short))
            runs = _run_keys([w[1:] for w in found]) if len(found) >= MIN_RUN else {}
            rows += [(doc, text_hash, start, t, list(f), runs.get(at)) for _, at, start, t, f in found]
        yield _batch(rows, [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()),
                            pa.string()],
                     ["doc_id", "text", "place", "template", "fillings", "run"])


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names)


def _consistent(met: DataFrame) -> DataFrame:
    """(text, item, at, lies, exact): the item windows of ``met`` and where the
    item ``lies`` in the text, if their fillings are the item's or follow
    the mapping of the alignments around.  A pairing votes with the number of
    windows on its alignment, so crossed pairings of an item that repeats a
    template weigh less than the item's own course."""
    pairing = ["text", "item", "at", "lies", "template"]
    weight = F.count("*").over(Window.partitionBy("text", "item", "lies"))
    bands = F.explode(F.array(*[F.concat_ws(":", F.lit(k), F.floor((F.col("lies") + k) / BAND))
                                for k in (0, BAND // 2)]))
    slots = met.select(*pairing, (F.col("fillings") == F.col("item_fillings")).alias("exact"),
                       "fillings", "item_fillings", weight.alias("weight")) \
        .select("*", bands.alias("band")) \
        .select(*pairing, "exact", "weight", "band", F.explode_outer(
            F.arrays_zip(F.col("item_fillings").alias("a"), F.col("fillings").alias("b"))).alias("p")) \
        .select(*pairing, "exact", "weight", "band", F.col("p.a").alias("of_item"),
                F.col("p.b").alias("of_doc"))
    mapping = (slots.where("of_item is not null")
               .groupBy("text", "item", "band", "of_item", "of_doc").agg(F.sum("weight").alias("n"))
               .groupBy("text", "item", "band", "of_item")
               .agg(F.max_by("of_doc", F.struct("n", "of_doc")).alias("chosen")))
    return (slots.join(mapping, ["text", "item", "band", "of_item"], "left")
            .groupBy(*pairing, "exact", "band")
            .agg(F.bool_and(F.expr("of_item is null or of_doc = chosen")).alias("agrees"))
            .where("exact or agrees")
            .groupBy("text", "item", "at", "lies").agg(F.bool_or("exact").alias("exact")))


def contaminated(docs: DataFrame, benchmark: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, text_hash, item_id, n_windows, share, exact): documents that
    hold a benchmark item: ``min_share`` of its windows, or ``MIN_RUN`` of them
    in a row.  ``exact`` tells that all fillings met are the item's; a pair that
    these alone settle counts no other windows.

    Null and empty texts and texts without a letter or digit hold nothing and
    match nothing; items of fewer than five words are held wherever these words
    follow each other; repeated rows of a document count as one; different texts
    under one item_id are items of their own, of which the best met one is
    given; empty tables give an empty result; other columns are not read.
    """
    ship(docs.sparkSession)
    # Null ids take part like any other under their text form.
    key = "concat_ws(':', coalesce(cast({0} as string), 'null'), {1})"
    items = written(benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                                     F.expr(key.format("item_id", "xxhash64(text)")).alias("item"),
                                     F.col("text").cast("binary").alias("text"))
                    .mapInArrow(_item_windows, "item_id long, item string, slot long, at long, "
                                               "start long, short long, template string, "
                                               "fillings array<string>, run string").distinct(),
                    "bench-items")
    bits, short = _slots(items), tuple(sorted(r["short"] for r in items.select(
        "short").distinct().collect() if r["short"]))
    found = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"),
                    F.col("text").cast("binary").alias("text"))
        .mapInArrow(partial(_document_windows, bits=bits, short=short),
                    "doc_id long, text long, place long, template string, "
                    "fillings array<string>, run string"),
        "bench-found")
    # Copies of a text are one from here on.
    texts = written(found.drop("doc_id").distinct(), "bench-texts")
    sizes = written(items.groupBy("item").agg(F.countDistinct("at").alias("size")), "bench-sizes")

    def met(on: list[str], name: str) -> DataFrame:
        """(text, item, name): item positions of which the text has a window, wherever."""
        pairs = written(texts.select("text", *on).distinct().join(
            items.select("item", "at", *on).distinct(), on).select("text", "item", "at"), f"bench-{name}")
        return pairs.groupBy("text", "item").agg(F.countDistinct("at").alias(name))

    runs = written(texts.select("text", "run").where("run is not null").distinct().join(
        items.select("item", "run").distinct(), "run").select("text", "item"), "bench-runs").distinct()
    enough = F.col("size") * min_share
    pairs = written(
        met(["template"], "n_met").join(sizes, "item")
        .where(F.col("n_met") >= F.least(enough, F.lit(MIN_RUN)))
        .join(met(["template", "fillings"], "n_exact"), ["text", "item"], "left")
        .join(runs.withColumn("run", F.lit(True)), ["text", "item"], "left")
        .select("text", "item", "size", F.coalesce("n_exact", F.lit(0)).alias("n_exact"),
                (F.coalesce((F.col("n_exact") >= enough) | F.col("run"), F.lit(False))).alias("settled")),
        "bench-pairs")
    settled = pairs.where("settled").select(
        "text", "item", F.col("n_exact").alias("n_windows"), (F.col("n_exact") / F.col("size")).alias("share"),
        F.lit(True).alias("exact"))
    open_pairs = written(pairs.where("not settled").select("text", "item").join(
        items.select("item", "at", "start", "template", F.col("fillings").alias("item_fillings")), "item"),
        "bench-open")
    places = texts.select("text", "place", "template", "fillings").distinct().join(
        open_pairs, ["text", "template"])
    shares = settled.unionByName(_by_place(written(
        places.withColumn("lies", F.expr("place - start")).drop("place", "start"), "bench-met").distinct(),
        sizes, min_share))
    names = items.select("item", "item_id").distinct()
    holders = found.select("doc_id", "text").distinct()
    best = F.max(F.struct("share", "n_windows", "exact")).alias("best")
    return (written(shares, "bench-shares").join(names, "item").join(holders, "text")
            .groupBy("doc_id", F.col("text").alias("text_hash"), "item_id").agg(best)
            .select("doc_id", "text_hash", "item_id", "best.n_windows", "best.share", "best.exact"))


def _slots(items: DataFrame) -> np.ndarray:
    """One bit per slot of a fixed 2^22 that a window of the benchmark has, so
    half a megabyte whatever its size; the joins decide."""
    bits = np.zeros(1 << FILTER_BITS, bool)
    rows = items.groupBy(F.shiftright("slot", 15).alias("page")).agg(
        F.bitmap_construct_agg(F.col("slot") % (1 << 15)).alias("bits")).collect()
    for row in rows:
        page = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
        bits[row["page"] << 15:][:1 << 15] = page
    return bits


def _by_place(met: DataFrame, sizes: DataFrame, min_share: float) -> DataFrame:
    """(text, item, n_windows, share, exact) of pairs that hold enough windows
    with the item's or consistent fillings, or enough of them in a row."""
    agreed = written(_consistent(met), "bench-agreed")
    # Windows in a row: position minus rank stays the same along one alignment.
    rank = F.row_number().over(Window.partitionBy("text", "item", "lies").orderBy("at"))
    runs = (agreed.withColumn("run", F.col("at") - rank)
            .groupBy("text", "item", "lies", "run").agg(F.count("*").alias("n"))
            .groupBy("text", "item").agg(F.max("n").alias("longest")))
    return (agreed.groupBy("text", "item", "at").agg(F.bool_or("exact").alias("exact"))
            .groupBy("text", "item").agg(F.count("*").alias("n_windows"), F.bool_and("exact").alias("exact"))
            .join(sizes, "item").join(runs, ["text", "item"])
            .select("text", "item", "n_windows", (F.col("n_windows") / F.col("size")).alias("share"),
                    "exact", "longest")
            .where((F.col("share") >= min_share) | (F.col("longest") >= MIN_RUN)).drop("longest"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all columns.

    Null and empty texts hold nothing and stay; null ids are judged by their
    text like others; repeated rows go or stay together; an empty table or an
    empty benchmark changes nothing; further columns may have any name.
    """
    bad = written(contaminated(docs, benchmark, min_share).select(
        F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct(),
        "bench-bad")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad_id"])
                     & (F.xxhash64(docs["text"]) == bad["_bad_hash"]), "left_anti")
