"""License labels and scores by the same method in plain Python."""

import math
import random
import re

from kubus.llm import chat, langid, licenses
from .conftest import prose


def plain_words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) if w]


def plain_scan(texts, anchors=licenses.ANCHORS):
    files = [plain_words(t) for t in texts]
    held = [set(f) for f in files]
    out = []
    for f, own in zip(files, held):
        labels, best = set(), 0.0
        for t in licenses.TEMPLATES:
            n = {w: sum(w in h for h in held) for w in t.words}
            idf = {w: math.log((len(files) + 1) / (n[w] + 1)) for w in t.words if n[w]}
            if not all(w in own for k in t.keys for w in k.split()):
                continue
            starts = range(-len(t.words), len(f))
            rare = [w for w in sorted(idf, key=lambda w: (-idf[w], w)) if w in own][:anchors]
            if t.slack and anchors:
                by = [{a - i for a, x in enumerate(f) if x == w for i, y in enumerate(t.words) if y == w}
                      for w in rare]
                starts = by[0] if len(by) == 1 else {
                    s for j, a in enumerate(by) for s in a
                    if any(abs(s - o) <= t.slack for b in by[:j] for o in b)}

            def stands(s):
                return all(any(s + at + d >= 0 and f[s + at + d:][:len(p)] == p
                               for d in range(-t.slack, t.slack + 1)) for at, p in t.key_positions())

            def share(s):
                return sum(w in f[max(0, s + j - t.slack):max(0, s + j + t.slack + 1)]
                           for j, w in enumerate(t.words)) / len(t.words)

            shares = [share(s) if t.slack else 1.0 for s in starts if stands(s)]
            shares = [x for x in shares if not t.slack or x >= licenses.MIN_SHARE]
            if shares:
                labels.add(t.label)
                best = max(best, *shares, 0.0)
        out.append((",".join(sorted(labels)), round(best, 9)))
    return out


def edited(r, text):
    words = text.split()
    for _ in range(r.randint(0, 6)):
        k = r.randrange(len(words))
        words[k:k + 1] = r.choice([["other"], [words[k], "new"], [words[k]], ["it"]])
    return " ".join(words)


def test_labels_and_scores(spark):
    r = random.Random(9)
    texts = [None, "", "Under the MIT License.", "licence"]
    for i in range(120):
        notices = [edited(r, r.choice(licenses.TEMPLATES).text) for _ in range(r.randint(0, 2))]
        texts.append(f" {prose(i, 5)} ".join(["", *notices, ""]))
    # The notice stands, but its rare words only elsewhere and in no order.
    gpl = next(t for t in licenses.TEMPLATES if t.label == "gpl").text
    held = [set(plain_words(t)) for t in texts]
    gone = sorted(set(gpl.split()) - set("gnu general public license".split()),
                  key=lambda w: (sum(w in h for h in held), w))[:licenses.ANCHORS]
    texts.append(" ".join(w if w not in gone else "x" for w in gpl.split()) + " "
                 + " ".join(f"{w} " + "y " * (7 * k + 9) for k, w in enumerate(gone)))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {x["doc_id"]: (x["labels"], round(x["score"], 9)) for x in licenses.scan(frame).collect()}
    expected = plain_scan(texts)
    assert [found[i] for i in range(len(texts))] == expected
    assert len({x for x, _ in expected}) > 8
    assert plain_scan(texts, anchors=0) != expected


def test_letters_are_of_a_letter_category():
    assert not any(map(langid.has_letter, ["½ ² 12", "Ⅷ", "", "_ 3"]))
    assert all(map(langid.has_letter, ["½ a", "Ⅷ é", "日"]))


def test_copies_of_a_text_are_drawn_one_by_one(spark):
    rows = [(i, ("the same words again", "dieselben worte noch einmal")[i % 2], ("en", "de")[i % 2])
            for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(langid.learn(docs, sample_docs=50).languages) == {"en", "de"}


def test_reply_tree_with_odd_rows(spark):
    rows = [(None, None, 1, None, "user", "q", 1.0), (None, None, 2, 1, "assistant", "a", 1.0),
            (None, None, 2, 1, "assistant", "a", 1.0), ("c", 7, 1, None, None, None, 1.0),
            ("c", 7, 2, 1, "assistant", "z", 1.0), ("c", 7, 2, 1, "assistant", "b", 1.0),
            ("c", 7, None, 1, "assistant", "lost", 1.0), ("null", 8, 1, None, "user", "x", None)]
    tree = spark.createDataFrame(rows, "conv string, conv_id long, node int, parent int, role string, "
                                       "text string, score double").withColumn("branch", chat.F.lit(3))
    found = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]]
             for r in chat.parsed(chat.formatted(tree)).collect()}
    assert found == {None: [("user", "q"), ("assistant", "a")], 7: [("", ""), ("assistant", "b")],
                     8: [("user", "x")]}
    assert chat.formatted(tree.limit(0)).count() == 0
