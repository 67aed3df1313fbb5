"""Operators on documents against brute force on the odd cases."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from kubus.llm import (decontaminate, encoding, langid, licenses, packing, quality, registry, secrets,
                       simhash, token_files)
from .conftest import prose

WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def multiset(rows):
    return Counter(tuple(r) for r in rows)


# -- quality ---------------------------------------------------------------


def base_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    seen, covered, lines, dup = Counter(windows), set(), set(), 0
    for k, w in enumerate(windows):
        if seen[w] > 1:
            covered |= set(range(k, k + 8))
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(covered),
            len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_quality_measures(odd_docs, no_docs):
    found = quality.verdicts(odd_docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert multiset((r["doc_id"], *(r[n] for n in names)) for r in found) == multiset(
        (i, *base_measures(t)) for i, t in texts_of(odd_docs))
    assert all(not r["kept"] for r in found if r["base_failed"])
    assert quality.verdicts(no_docs).count() == 0


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def made_of(seed, n, low, high, mark=""):
    """``n`` words of ``low`` to ``high`` letters, each with a ``mark``."""
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghij", k=r.randint(low, high))) + mark for _ in range(n))


def test_quality_fences_differ_as_the_sources_do(spark):
    sizes = {"brief": (2, 4), "usual": (4, 7), "long": (7, 12)}
    rows = [(1000 * k + i, made_of(1000 * k + i, 80, *size), "en", name, 0)
            for k, (name, size) in enumerate(sizes.items()) for i in range(300)]
    rows += [(9000 + k, made_of(9000, 80, 7, 9), "en", name, 0) for k, name in enumerate(sizes)]
    docs = spark.createDataFrame(rows, DOCS)
    high = {r["source"][1:]: r["limits"]["word_length"]["high"]
            for r in quality.thresholds(quality.measures(docs)).collect()}
    assert high["brief"] < high["usual"] < high["long"]
    kept = {r["doc_id"] for r in quality.keep_good(docs).collect()}
    assert kept >= {r[0] for r in rows if r[0] < 9000} and 9002 in kept and 9000 not in kept


@pytest.mark.parametrize("n", [99, 100, 101])
def test_quality_junk_source_cannot_open_its_fence(spark, n):
    rows = [(i, prose(i, 60), "en", "plain", 0) for i in range(400)]
    rows += [(1000 + i, prose(i, 60).replace(" ", " # "), "en", "junk", 0) for i in range(n)]
    kept = {r["doc_id"] for r in quality.keep_good(spark.createDataFrame(rows, DOCS)).collect()}
    assert kept == set(range(400))


def plain_limits(rows):
    """(low, high) by (lang, source, metric), from lists of buckets."""
    def bucket(v):
        return math.ceil(math.log(v) / quality._GAMMA) if v > 0 else quality._ZERO

    def value(b):
        return 0.0 if b == quality._ZERO else math.exp((b - 0.5) * quality._GAMMA)

    def fences(metric, own, prior):
        entries = sorted([(b, float(n)) for b, n in own.items()]
                         + [(b, n * (quality.PRIOR / sum(prior.values()))) for b, n in (prior or {}).items()])
        docs, found = float(sum(own.values())) + (quality.PRIOR if prior else 0), {}
        upto = 0.0
        for b, n in entries:
            upto += n
            for q in (0.25, 0.5, 0.75):
                if upto >= docs * q:
                    found.setdefault(q, value(b))
        q1, q2, q3 = (found[q] for q in (0.25, 0.5, 0.75))
        up = (q3 - q2) * quality.REACH if q3 > q2 else metric.room
        down = (q2 - q1) * quality.REACH if q2 > q1 else metric.room
        return (q1 - down if metric.lower else -math.inf), q3 + up

    def held(fence, bound, factor):
        return max(fence[0], bound[0] / factor), min(fence[1], bound[1] * factor)

    out = {}
    for m in quality.METRICS:
        values = [(r["lang"], r["source"], bucket(eval(m.value, {"greatest": max}, r))) for r in rows
                  if not (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])]
        every = Counter(b for *_, b in values)
        corpus = fences(m, every, None)
        for lang in {v[0] for v in values}:
            own = Counter(b for x, _, b in values if x == lang)
            of_lang = held(fences(m, own, every), corpus, quality.LANGUAGE_FACTOR)
            for source in {v[1] for v in values if v[0] == lang}:
                group = Counter(b for x, y, b in values if (x, y) == (lang, source))
                out[lang, source, m.name] = held(fences(m, group, own), of_lang, quality.GROUP_FACTOR)
    return out


def test_quality_verdicts_match_plain_quantiles(spark, odd_docs):
    r = random.Random(3)
    rows = []
    for i in range(600):
        text = made_of(i, r.randint(15, 90), *r.choice([(2, 5), (4, 7), (6, 9)]))
        if r.random() < 0.05:
            text = text.replace(" ", r.choice([" # ", " a a a ", " LOUD "]))
        rows.append((i, text, r.choice(["en", "de", None]), r.choice(["a", "a", "a", "b", None]), 0))
    docs = spark.createDataFrame(rows, DOCS).unionByName(odd_docs.select("doc_id", "text", "lang", "source", "n_chars"))
    found = [x.asDict() for x in quality.verdicts(docs).collect()]
    limits = plain_limits(found)
    for x in found:
        values = {m.name: eval(m.value, {"greatest": max}, x) for m in quality.METRICS} if x["n_words"] else {}
        broken = [] if x["base_failed"] else [
            m.name for m in quality.METRICS
            if not limits[x["lang"], x["source"], m.name][0] <= values[m.name] <= limits[x["lang"], x["source"], m.name][1]]
        assert x["broken"] == broken and x["kept"] == (not x["base_failed"] and not broken)
    assert {b for x in found for b in x["broken"]} >= {"symbols", "stutter"}


def test_quality_keeps_columns_and_repeated_rows(odd_docs):
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert ids.count(8) == 2  # both copies of row 8, not the short text under its id


# -- token files -------------------------------------------------------------


@cache
def tokenizer(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def encode_all(name, texts):
    t = tokenizer(name)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name, kind", [("byte_bpe_50k.json", "leading"), ("word_bpe_49k.json", "dropped")])
def test_pieces_encode_like_whole_texts(name, kind):
    parts = ["don't", "I'll", " ", "  ", "\n", "\t", "\x1c", "\xa0", "\u00e9", "\u00c9COLE", "\u2167",
             "a\u00b2b", "\u0141\u00f3d\u017a", "\u043f\u0440\u0438", "\u65e5\u672c", "'s", "''t",
             "_a_", "3.14", "100km", "...", "\u2605", "a\u2605", "e\u0301", "\u0130", "\u0391\u03a3.",
             "\U0001f600", "<|endoftext|>", "word", "Word,", "the.", "\r\n", "\0", "\u200b", "\x85",
             "\u0663", "\u00aa", "-", "\u00d7", "a\u00f7b", "\u2019s", "\u3000", "<|startoftext|>", "<|", "\x85a",
             "\u2028", "\x7f", "\u00c3", "caf\u00e9,", "9a", " a", "\n\n ", " \n"]
    r = np.random.default_rng(7)
    code = encoding.Encoder(public_tokenizers.path(name), kind, cache_size=500, slice_bytes=60)
    for _ in range(200):
        texts = ["".join(r.choice(parts, r.integers(0, 40))) for _ in range(8)]
        assert code.encode(texts) == [np.array(x, "<u4").tobytes() for x in encode_all(name, texts)]


def test_token_files_round_trip(odd_docs, no_docs):
    path = registry.vocabulary("byte_bpe_50k.json")
    found = token_files.token_files(odd_docs, path, "leading", 2).collect()
    rows = texts_of(odd_docs)
    ids = encode_all("byte_bpe_50k.json", [t for _, t in rows])
    assert multiset((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == multiset(
        (i, len(x) + 1, crc(x + [2])) for (i, _), x in zip(rows, ids))
    ordered = sorted(found, key=lambda r: r["start"])
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in ordered]
    assert keys == sorted(keys)
    assert [r["start"] for r in ordered] == np.cumsum([0] + [r["n_tokens"] for r in ordered])[:-1].tolist()
    assert token_files.token_files(no_docs, path, "leading", 2).count() == 0


def test_reader_opens_only_needed_frames(tmp_path):
    with open(tmp_path / "a.zst", "wb") as out:
        writer = token_files.FrameWriter(out, frame_bytes=4000)
        docs = {i: np.full(1 + i % 7 * 300, i, "<u4").tobytes() for i in range(60)}
        for i, ids in docs.items():
            writer.add(i, ids)
        writer.close()
    reader = token_files.FrameReader(str(tmp_path / "a.zst"))
    assert reader.find([31, 7]) == {7: docs[7], 31: docs[31]}
    assert reader.frames_read <= 1 + 4 < len(reader.entries) - 1
    assert dict(reader.documents(range(60))) == docs
    data = bytearray((tmp_path / "a.zst").read_bytes())
    data[20] ^= 255
    (tmp_path / "b.zst").write_bytes(data)
    with pytest.raises(Exception):
        token_files.FrameReader(str(tmp_path / "b.zst")).find([0])


# -- packing -----------------------------------------------------------------


def check_packing(rows, capacity):
    by_sequence = defaultdict(list)
    for sequence, offset, length in rows:
        by_sequence[sequence].append((offset, length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in parts) <= 2
    return len(by_sequence)


def test_packing(odd_docs, no_docs):
    path = registry.vocabulary("word_bpe_49k.json")
    found = packing.pack(odd_docs, path, "dropped", 1).collect()
    rows = texts_of(odd_docs)
    expected = [(i, k // 4096, k, len((x + [1])[k:k + 4096]), crc((x + [1])[k:k + 4096]))
                for (i, _), x in zip(rows, encode_all("word_bpe_49k.json", [t for _, t in rows]))
                for k in range(0, len(x) + 1, 4096)]
    assert multiset(tuple(r)[:5] for r in found) == multiset(expected)
    check_packing([(r["sequence_id"], r["offset"], r["length"]) for r in found], 4096)
    assert packing.pack(no_docs, path, "dropped", 1).count() == 0


def test_packed_sequences(odd_docs):
    pieces = packing.tokenised(odd_docs, registry.vocabulary("word_bpe_49k.json"), "dropped", 1)
    placed = packing.place(pieces)
    whole = {r["sequence_id"]: r for r in packing.sequences(pieces, placed).collect()}
    for r in placed.collect():
        own = whole[r["sequence_id"]]["ids"][4 * r["offset"]:4 * (r["offset"] + r["length"])]
        assert zlib.crc32(own) == r["ids_crc32"]


def test_plan_places_every_document_and_packs_tightly():
    r = np.random.default_rng(5)
    for trial in range(30):
        lengths = r.choice([r.integers(1, 101), *r.integers(1, 101, 40)], 400)
        counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
        rules = packing.plan(counts, 100)
        rows, placed = [], Counter()
        for length, first, per, n, sequence, offset in rules.tolist():
            assert first == placed[length]
            for i in range(per * n):
                rows.append((sequence + i // per, offset + i % per * length, length))
            placed[length] += per * n
        assert placed == Counter(counts)
        used = check_packing(rows, 100)
        least = max(-(-sum(lengths.tolist()) // 100), sum(2 * n > 100 for n in lengths.tolist()))
        assert used <= 1.25 * least + 1
    assert len(packing.plan({}, 100)) == 0


# -- secrets -----------------------------------------------------------------

SECRET = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                         r"([A-Za-z0-9+/_.=-]+)", re.I | re.A),
    "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}
LEAST = {"assign": lambda m: len(m[2]) >= 12, "access": lambda m: len(m[0]) >= 18,
         "hex": lambda m: len(m[0]) >= 16}


def base_secrets(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(SECRET.items())
             for m in p.finditer(text or "") if LEAST[kind](m)]
    return [(s, e, kind) for s, _, e, kind in sorted(found)]


def secret_texts():
    r = np.random.default_rng(3)
    parts = ["token", "Secret", "api_key", "PASSWORD", "=", " : ", '"', "'", " ", "abcdef0123", "AKIA",
             "XYZ12345678", "é", "..", "deadbeefdeadbeef", "ghp_" + "a" * 36, "\n", "token=short "]
    return ["".join(r.choice(parts, r.integers(1, 25))) for _ in range(4000)]


def test_secret_spans_match_regular_expressions():
    for text in secret_texts():
        own = [s for s in secrets.spans(text.encode()) if s[2] in SECRET]
        assert own == base_secrets(text), text


def test_secret_scan_and_redaction(spark, odd_docs, no_docs):
    texts = secret_texts()[:60]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)] + [(None, None, None)],
                                 "doc_id long, text string, n_chars long")
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secrets.scan(docs).collect()}
    assert found == {i: secrets.spans(t.encode()) for i, t in enumerate(texts)} | {None: []}
    redacted = secrets.redact(docs).collect()
    assert len(redacted) == len(texts) + 1
    for r in redacted:
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
        if found[r["doc_id"]]:
            assert "[" in r["text"]
    assert secrets.redact(odd_docs).columns == odd_docs.columns
    assert secrets.redact(odd_docs).count() == odd_docs.count()
    assert secrets.scan(no_docs).count() == secrets.redact(no_docs).count() == 0
    assert secrets.redacted_text('x token="' + "a1" * 10 + '" y') == 'x [assign]" y'


# -- decontamination -----------------------------------------------------------

ITEM = ("A farmer sells 12 kg of apples to Mary in the market and keeps 5 kg for himself so how many "
        "kg did he pick before Mary came to the market")


def test_decontamination(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, ITEM), (2, prose(50, 40)), (3, "too short"), (4, None), (None, "")],
                                  "item_id long, text string")
    asked = ITEM.replace("12", "19").replace("5 kg", "8 kg").replace("Mary", "Peter")
    broken = ITEM.replace("12", "19").replace("to Mary", "to Peter").replace("before Mary", "before John")
    rows = [(1, "Some words. " + ITEM + " and more"), (2, asked), (3, prose(60, 200)),
            (4, prose(61, 9) + " " + prose(50, 40).lower() + " " + prose(62, 9)), (None, ITEM),
            (6, " ".join(ITEM.split()[:9]) + " " + prose(63, 50)), (1, "Some words. " + ITEM + " and more"),
            (7, broken), (8, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(found) == {(1, 1), (2, 1), (4, 2), (None, 1), (7, 1)}
    assert found[1, 1]["exact"] and not found[2, 1]["exact"]
    assert found[1, 1]["share"] > 0.9 and found[2, 1]["share"] > 0.9
    assert found[7, 1]["share"] < found[2, 1]["share"]  # one name has two fillings
    assert sorted(r["doc_id"] for r in decontaminate.keep_clean(docs, bench).collect()) == [3, 6, 8, 9]
    assert decontaminate.keep_clean(odd_docs, bench).count() == odd_docs.count()
    assert decontaminate.contaminated(no_docs, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def found_items(spark, items, texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs, bench).collect()}


def test_decontamination_of_parallel_sentences(spark):
    names = ["Tom", "Ann", "Joe", "Eve"]
    item = " ".join(f"now we saw {n} buy {i} red apples and {i + 4} ripe pears." for i, n in
                    enumerate(names, 1))
    other = re.sub(r"\d", lambda m: str(30 - int(m[0])), item)
    mixed = item.replace("1", "6").replace("buy 2", "buy 9").replace("Joe", "Ann")
    found = found_items(spark, [item], ["Read this first: " + item, prose(64, 30) + ". " + other, mixed,
                                        prose(65, 60)])
    assert found[0, 0]["share"] == 1 and found[0, 0]["exact"]
    assert found[1, 0]["share"] == 1 and not found[1, 0]["exact"]
    assert set(found) <= {(0, 0), (1, 0), (2, 0)}


def test_decontamination_of_numbers_names_and_short_items(spark):
    items = ["In 1969 Neil Armstrong and Buzz Aldrin landed Apollo 11 on July 20, 1969.",
             "Paris 1900 London 1908 Stockholm 1912 Antwerp 1920 Berlin 1936 Helsinki 1952",
             "Who wrote Faust first?"]
    texts = [prose(66, 40) + ". " + i + " " + prose(67, 40) for i in items]
    moved = items[0].replace("1969", "1972").replace("Neil", "Gene")
    texts += [prose(68, 40) + ". " + moved, items[1].replace("19", "20"), "Who wrote Hamlet first?",
              "who wrote, faust first"]
    found = found_items(spark, items, texts)
    assert set(found) == {(0, 0), (1, 1), (2, 2), (3, 0), (6, 2)}
    assert all(found[k, k]["exact"] and found[k, k]["share"] >= 0.8 for k in range(3))


def test_decontamination_of_a_long_quoted_part(spark):
    item = prose(72, 300).lower().split()
    ask = ITEM + " while " + " ".join(item[:40])

    def inside(words):
        return prose(73, 50).lower() + ". " + " ".join(words) + " " + prose(74, 50).lower()

    cut = [item[at:at + 12] for at in range(0, 300, 60)]  # five quotes of 12 words
    texts = [inside(item[100:120]), inside(item[100:112]), " ".join(map(inside, cut)),
             inside(ask.replace("12", "19").replace("Mary", "Eve").split()[:18])]
    found = found_items(spark, [" ".join(item), ask], texts)
    assert set(found) == {(0, 0), (3, 1)}
    assert found[0, 0]["exact"] and found[0, 0]["share"] < 0.1 and not found[3, 1]["exact"]


def test_heavy_windows_of_long_texts_do_not_depend_on_blocks(monkeypatch):
    text = (" 5 km 7 Mary of the 3 4 5 " * 3 + "9 Bo " * 30 + prose(71, 40) + " 8 9 a Jo") .encode() * 3
    whole = sorted(decontaminate.windows(text, short=(2,)))
    monkeypatch.setattr(decontaminate, "BLOCK", 50)
    assert sorted(decontaminate.windows(text, short=(2,))) == whole


def test_windows_of_long_texts_do_not_depend_on_blocks(monkeypatch):
    text = (prose(70, 400) + " 5 km 7 Mary " + prose(71, 400)).encode()
    whole = list(decontaminate.windows(text))
    monkeypatch.setattr(decontaminate, "BLOCK", 50)
    assert list(decontaminate.windows(text)) == whole


# -- language ------------------------------------------------------------------


def test_codewords_tell_languages_apart():
    for n in (2, 3, 4, 5, 6, 12):
        code = langid.codewords(n).astype(int)
        gaps = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(gaps) >= max(1, code.shape[1] // 4)
    assert langid.codewords(1).shape == (1, 0)


def test_language_held_out_accuracy(spark):
    from kubus.llm.common import read_table

    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    found = langid.identify(docs).collect()
    held_out = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held_out} == {i for i in lang if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held_out) >= 0.97 * len(held_out)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_odd_cases(odd_docs, no_docs):
    found = langid.identify(odd_docs).collect()
    assert len(found) == odd_docs.count()
    text = {r["doc_id"]: r["text"] for r in odd_docs.collect() if r["doc_id"] not in (None, 8)}
    for r in found:
        if r["doc_id"] in text:
            letters = any(c.isalpha() for c in text[r["doc_id"]] or "")
            assert r["lang_pred"] in (("en", "de") if letters else ("und",))
    assert langid.identify(no_docs).count() == 0


# -- licenses ------------------------------------------------------------------


def test_licenses(spark, odd_docs, no_docs):
    texts = ["Released under the MIT License. under the mit license", "Apache License, Version 2.0",
             "cc by nc cc by-nc", "CC-BY-NC/under the (MIT) license", "under the mitlicense", None, "",
             "This work is licensed under the GNU General Public License, version 3.",
             prose(80, 200) + " Permission is hereby granted, free of charge, to any person obtaining a "
             "copy of this fine software and associated documentation files", prose(81, 5000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rows, frame in ((texts_of(docs), docs), (texts_of(odd_docs), odd_docs)):
        expected = []
        for i, t in rows:
            words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOW))
            places = [(k, x.label) for x in licenses.BASE_TEMPLATES for k in range(len(words))
                      if words[k:k + len(x.words)] == x.words]
            starts = [k for k, _ in places]
            expected.append((i, len(words), len(places), min(starts, default=None),
                             max(starts, default=None), ",".join(sorted({x for _, x in places}))))
        found = licenses.scan(frame).collect()
        assert multiset(tuple(r)[:6] for r in found) == multiset(expected)
    labels = {r["doc_id"]: r["labels"] for r in licenses.scan(docs).collect()}
    assert labels[7] == "gpl-3" and labels[8] == "mit" and labels[9] == ""
    assert licenses.scan(no_docs).count() == 0


def test_edited_license_notices(spark):
    edited = ("This library is software; you may redistribute it and/or modify it under the terms of the "
              "GNU General Public License as published by the FSF")
    texts = [edited, "The foundation can be free. " + prose(82, 200) + " " + edited,
             "It names the GNU General Public License only.", prose(83, 50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in licenses.scan(docs).collect()} == {
        0: "gpl", 1: "gpl", 2: "", 3: ""}
    assert licenses.scan(docs.where("doc_id = 0")).first()["labels"] == "gpl"


# -- simhash -------------------------------------------------------------------


def brute_fingerprint(text):
    words = WORD.findall((text or "").translate(LOW))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=2):
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(rows):
            for j, (_, b) in enumerate(rows):
                if (a ^ b).bit_count() <= radius and label[j] > label[i]:
                    label[j], changed = label[i], True
    return [min((rows[j][0] for j in range(len(rows)) if label[j] == x and rows[j][0] is not None),
                default=None) for x in label]


def test_simhash_components(odd_docs, no_docs):
    rows = [(i, brute_fingerprint(t)) for i, t in texts_of(odd_docs)]
    found = simhash.near_duplicates(odd_docs)
    assert multiset((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found.collect()) \
        == multiset((i, f, c) for (i, f), c in zip(rows, brute_components(rows)))
    assert simhash.near_duplicates(no_docs).count() == 0


def test_simhash_links_of_dense_and_split_tiles(spark):
    r = np.random.default_rng(9)
    centres = r.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = {0}
    for c in centres.tolist():
        fps.add(c)
        for _ in range(40):
            c ^= 1 << int(r.integers(64))  # a walk: neighbours one bit apart
            fps.add(c)
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    classes = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = simhash.links(classes, radius=2, tile_rows=4).collect()
    assert all((e["u"] % (1 << 64) ^ e["v"] % (1 << 64)).bit_count() <= 2 for e in edges)
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in edges:
        x, y = sorted((find(e["u"]), find(e["v"])))
        parent[y] = x
    expected = brute_components([(f, f % (1 << 64)) for f in fps])
    assert [find(f) for f in fps] == expected
    dense = np.arange(64, dtype=np.uint64)
    assert len(simhash.link_forest(dense, dense, True, 6)) == 63


def test_keep_one(odd_docs, no_docs):
    found = simhash.near_duplicates(odd_docs).collect()
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({r["root"] for r in found})
    assert simhash.keep_one(no_docs).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    from kubus.llm.components import connected_components

    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(500, i) for i in range(501, 900)]
    found = dict(map(tuple, connected_components(
        spark.createDataFrame(chain + hub + [(1, 1)], "u long, v long")).collect()))
    assert found == {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 900)}


