"""Found (document, item) pairs against all places in plain Python."""

import random
from collections import Counter, defaultdict

from kubus.llm import decontaminate as D


def plain_pair(text, item):
    short = D._short(item.encode())
    of_item = [(at, start, t, f) for _, at, start, t, f in D.windows(item.encode(), short=short)]
    slots = {w[0] for w in D.windows(item.encode(), short=short)}
    of_text = {(start, t, f) for slot, _, start, t, f in D.windows(text.encode(), short=short) if slot in slots}
    met = {(at, place - start, t, f, g) for at, start, t, g in of_item for place, t2, f in of_text if t2 == t}
    weight = Counter(lies for _, lies, *_ in met)
    groups, votes = defaultdict(list), defaultdict(Counter)
    for at, lies, t, f, g in met:
        for k in (0, D.BAND // 2):
            band = (k, (lies + k) // D.BAND)
            groups[at, lies, t, f == g, band] += [(band, a, b) for a, b in zip(g, f)]
            for a, b in zip(g, f):
                votes[band, a][b] += weight[lies]
    chosen = {key: max((n, b) for b, n in c.items())[1] for key, c in votes.items()}
    agreed = {(at, lies) for (at, lies, _, exact, _), slots in groups.items()
              if exact or all(b == chosen[band, a] for band, a, b in slots)}
    size = len({w[0] for w in of_item})
    longest = 0
    for at, lies in agreed:
        n = 0
        while (at + n, lies) in agreed:
            n += 1
        longest = max(longest, n)
    return bool(size) and (len({a for a, _ in agreed}) >= D.MIN_SHARE * size or longest >= D.MIN_RUN)


def sentence(r):
    words = ["the", "cat", "costs", "about", "for", "each", "red", "box", "in", "old", "town", "of", "wide"]
    return " ".join(r.choice([*words, str(r.randint(1, 9)), r.choice(["Ann", "Bob"]), "5 km"])
                    for _ in range(r.randint(4, 14))) + "."


def test_pairs_are_those_of_all_places(spark):
    r = random.Random(11)
    items = [" ".join(sentence(r) for _ in range(r.randint(1, 4))) for _ in range(14)]
    items += ["Ann has 3 apples and 4 pears in 2 boxes. " * 3, "one two", "row 1 costs 2 euros here. row 3 costs 4 euros here."]
    docs = []
    for _ in range(60):
        parts = []
        for _ in range(r.randint(0, 4)):
            words = r.choice(items).split()
            cut = r.randint(0, len(words))
            words = words[:cut] if r.random() < 0.4 else words
            swap = {str(n): str(r.randint(10, 99)) for n in range(10)} if r.random() < 0.5 else {}
            parts += [swap.get(w, w) if r.random() < 0.95 else "noise" for w in words] + sentence(r).split()
        docs.append(" ".join(parts))
    docs += docs[:5]
    found = {(x["doc_id"], x["item_id"]) for x in D.contaminated(
        spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
        spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    expected = {(i, j) for i, d in enumerate(docs) for j, t in enumerate(items) if plain_pair(d, t)}
    assert found == expected and 20 < len(expected) < len(docs) * len(items)


def test_repeated_phrase_makes_no_product_of_places(spark):
    phrase = "please read the long note "
    docs = spark.createDataFrame([(i, phrase * 3000 + str(i)) for i in range(4)], "doc_id long, text string")
    items = spark.createDataFrame([(1, phrase * 60), (2, "an apple a day keeps the doctor away today")],
                                  "item_id long, text string")
    assert {(x["doc_id"], x["item_id"]) for x in D.contaminated(docs, items).collect()} == {(i, 1) for i in range(4)}


def test_word_forms():
    words = [b"Word", b"word,", b"a.b.", b"U.S.", b"3.14", b"\xc3\x89cole!", b"(hi)", b"km", b"5km,", b"don't", b"--",
             b"x\xff", b'end."', b"\xe2\x80\x9cQuote", b"ab\xc2\xb2", b"?", b"\xe2\x85\xa7", b"KM!", b"days", b"A", b"a;",
             b"w" * 300_000, b"word", b'"word"', b"WORD.", b"[", b"@a", b"a`", b"day.."]
    data = b"\t " + b" \n".join(words + words) + b"\r"
    first, ends, hashes, *flags = D._forms(data, 0, len(data))
    assert [data[i:j] for i, j in zip(first, ends)] == words + words
    by_literal = {}
    for i, raw in enumerate(words + words):
        word = raw.decode("utf-8", "replace")
        bare = D._EDGES.sub("", word)
        literal = D._SIGNS.sub("", bare).lower()
        number = not literal.isalpha() and any(map(str.isdigit, literal))
        assert (D._bare(raw), D._literal(bare)) == (bare, literal), word
        assert [bool(c[i]) for c in flags] == [
            number, literal in D.UNITS, bare[:1].isupper() and not number,
            word.rstrip(D._CLOSING)[-1:] in D._STOPS], word
        by_literal.setdefault(literal, set()).add(int(hashes[i]))
    assert all(len(h) == 1 for h in by_literal.values())
    assert len(set().union(*by_literal.values())) == len(by_literal)


def test_keep_clean_with_odd_rows_and_clashing_names(spark):
    text = "what is the capital of the small island state in the north"
    rows = [(1, text, 5), (2, None, 6), (2, None, 6), (3, "clean words here", 7), (None, text, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _bad_id long")
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert [tuple(r) for r in D.keep_clean(docs, items).orderBy("doc_id").collect()] == rows[1:4]
    assert D.keep_clean(docs, items.limit(0)).count() == 5 and D.keep_clean(docs.limit(0), items).count() == 0
