"""Operators on conversations and pages, and the pipeline."""

import hashlib
import io
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kubus.llm import chat, decontaminate, packing, quality, registry, secrets, simhash, warc
from kubus.llm.common import read_table
from oracle_harness import compare, duck


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- chat --------------------------------------------------------------------


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "a\\b \\</s> <\\s> [\\INST] \\", "", None, "<s><s></s", "[/INST]]\n",
             "é\U0001f600 ", "[INST][INST", "plain"]
    rows = [(c, i, ("user", "assistant", "system", None, "assistant ")[(c + i) % 5],
             texts[(c * 3 + i) % len(texts)]) for c in range(9) for i in range(c + 1)]
    rows += [(50, 1, "user", "b"), (50, 1, "assistant", "a"), (50, 1, "user", "b"), (50, None, "user", "n"),
             (None, 0, "user", "x"), (None, 1, "assistant", "y"), (60, 0, "assistant", "only")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .withColumn("node", F.lit(1)).withColumn("score", F.lit(2))
    expected = {}
    groups = defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((t is not None, t, r or "", x or ""))
    for c, own in groups.items():
        own = sorted(own, key=lambda r: (r[0], r[1] or 0, r[2], r[3]))
        loss = "".join(x for *_, r, x in own if r == "assistant")
        expected[c] = (len(own), sha("".join(f"{r}\n{x}\n" for *_, r, x in own)), len(loss), sha(loss))
    found = chat.digests(chat.formatted(chat.messages_from_turns(turns))).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in found} == expected and len(found) == len(expected)
    assert chat.digests(chat.formatted(chat.messages_from_turns(turns.limit(0)))).count() == 0


def test_reply_tree_paths_and_ranking(spark):
    # 1 -> (2 -> (4, 5), 3); 9 is a root without its parent
    rows = [("c", 7, 1, None, "user", "q", 1.0), ("c", 7, 2, 1, "assistant", "a", 1.0),
            ("c", 7, 3, 1, "assistant", "b", 9.0), ("c", 7, 4, 2, "user", "x", 0.0),
            ("c", 7, 5, 2, "user", "y", 5.0), ("c", 7, 9, 8, "user", "lost", 0.5)]
    tree = spark.createDataFrame(rows, "conv string, conv_id long, node int, parent int, role string, "
                                       "text string, score double")
    found = defaultdict(dict)
    for r in chat.paths(tree).collect():
        found[r["leaf"]][r["up"]] = r["node"]
    assert found == {3: {0: 3, 1: 1}, 4: {0: 4, 1: 2, 2: 1}, 5: {0: 5, 1: 2, 2: 1}, 9: {0: 9}}
    output = chat.parsed(chat.formatted(tree, branches=2)).collect()
    assert {r["branch"]: [t["text"] for t in r["turns"]] for r in output} == {1: ["q", "b"], 2: ["q", "a", "y"]}
    assert {r["branch"]: "".join(r["loss"]) for r in output} == {1: "b", 2: "a"}
    cycle = spark.createDataFrame([("c", 1, 2), ("c", 2, 1)], "conv string, node int, parent int")
    with pytest.raises(ValueError):
        chat.paths(cycle)


def test_chat_long_conversation(spark):
    turns = spark.range(700).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
                                    .alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    row = chat.digests(chat.formatted(chat.messages_from_turns(turns))).first()
    assert row["n_turns"] == 700
    assert row["loss_sha256"] == sha("".join(f"t{i}" for i in range(1, 700, 2)))


# -- warc --------------------------------------------------------------------


def test_archives_round_trip(spark, tmp_path):
    big = "<p>" + "é" * 150000 + "</p>"
    html = ["x" * 99, "x" * 99, "y" * 100, "y" * 100, None, "", big, big, "WARC/1.1\r\n\r\n" * 20, "y" * 100]
    rows = [(i, f"http://a/{i} b\r\nX: 1", h) for i, h in enumerate(html)]
    rows += [(2, "http://a/2", "y" * 100), (None, None, "y" * 100), (None, None, "z" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string") \
        .withColumn("digest", F.lit(1)).withColumn("first", F.lit(2)).repartition(3)
    expected = []
    for i, _, h in rows:
        h = h or ""
        same = [j for j, _, x in rows if (x or "") == h and j is not None]
        first = min(same, default=None) if len(h.encode()) >= 100 else None
        revisit = first is not None and i != first
        expected.append((i, len(h.encode()), sha(h), "revisit" if revisit else "response",
                         first if revisit else None))
    assert sorted(map(tuple, warc.archived(pages).collect()), key=str) == sorted(expected, key=str)
    assert warc.archived(pages.limit(0)).count() == 0
    folder = str(tmp_path / "w")
    manifest = warc.write_archives(pages, folder)
    chunks = warc.read_archives(spark, folder, manifest).where("page_id = 6").orderBy("chunk").collect()
    assert len(chunks) > 3 and all(len(c["data"]) <= warc.CHUNK_BYTES for c in chunks)
    data = b"".join(c["data"] for c in chunks)
    assert data.decode() == big
    running = hashlib.sha256()
    for c in chunks:
        running.update(c["data"])
        assert c["payload_digest"] == running.hexdigest()


def test_a_damaged_archive_is_refused():
    head = warc._header(1, "u", sha("abc"), 3, None)
    import gzip

    good = gzip.compress(head + b"abc\r\n\r\n")
    assert [r["data"] for r in warc.records(io.BytesIO(good))] == [b"abc"]
    for bad in (head + b"abd\r\n\r\n", head + b"abc\r\n"):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(gzip.compress(bad))))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(good[:-12])))


# -- registry and pipeline -----------------------------------------------------


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_duckdb(spark, sf_small, name):
    r = compare(spark, duck(sf_small), name, sf_small, registry.queries()[name],
                registry.oracle_sql()[name])
    assert r["status"] == "ok", r


def test_pipeline_stages_one_after_another(spark, sf_small):
    docs = read_table(spark, sf_small, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "decontamination", "secret_scan", "best_fit_packing"]
    stages = dict(corpus_pipeline.STAGES)
    frames, kept, frame = [], [set(rows)], docs
    for name in list(stages)[:4]:
        frame = stages[name](spark, frame, sf_small)
        frame = frame.checkpoint()
        assert frame.columns == docs.columns
        frames.append(frame)
        ids = [r["doc_id"] for r in frame.select("doc_id").collect()]
        assert len(ids) == len(set(ids))
        kept.append(set(ids))
    assert kept[1] == {r["doc_id"] for r in quality.verdicts(docs).collect() if r["kept"]}
    components = simhash.near_duplicates(frames[0]).collect()
    assert kept[2] == {r["component_id"] for r in components}
    bad = {r["doc_id"] for r in decontaminate.contaminated(
        frames[1], read_table(spark, sf_small, "benchmark")).collect()}
    assert kept[3] == kept[2] - bad
    assert kept[4] == kept[3]
    for r in frames[3].collect():
        assert r["text"] == secrets.redacted_text(rows[r["doc_id"]]["text"])
        assert not [s for s in secrets.spans(r["text"].encode()) if s[2] != "hex"]
        assert r["n_chars"] == len(r["text"])
    packed = corpus_pipeline.run(spark, sf_small).collect()
    direct = packing.pack(frames[3], registry.vocabulary("word_bpe_49k.json"), "dropped", 1).collect()
    assert sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packed) == sorted(
        (r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in direct)
