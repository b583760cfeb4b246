"""Operators on small tables: nulls, empty tables, repeats, long texts, clashing columns, brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import parity
from citelight.llm import decontamination, exact, language, lines, minhash, mixing, quality, spans, token_files, warc
from citelight.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
SENTENCE = "one two three four five six seven eight nine ten"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_its_sql(spark, name):
    assert parity.compare(spark, parity.connect(FOLDER), name, QUERIES[name], ORACLE[name], FOLDER) is None


def brute_components(texts, width, percent):
    sets, parent = [], list(range(len(texts)))
    for text in texts:
        words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i: i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return sets, [top(i) for i in range(len(texts))]


def test_near_duplicates_against_brute_force(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    sets, want = brute_components([r["text"] for r in table], 4, 80)
    got = {r["doc_id"]: r for r in QUERIES["op5_minhash"](spark, FOLDER).collect()}
    for i, row in enumerate(table):
        found = got[row["doc_id"]]
        assert (found["n_shingles"], found["component_id"]) == (len(sets[i]), table[want[i]]["doc_id"])


def test_near_duplicates_edges(docs_of):
    long = " ".join(str(i) for i in range(30_000))
    docs = docs_of((3, "A b"), (1, "a  B"), (1, None), (2, ""), (4, long), (5, long + " x"), (5, long + " x"), (None, "q r s"))
    found = rows(minhash.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept")
    assert Counter(found) == Counter([
        (3, 1, 1, False), (1, 1, 1, True), (1, 0, 1, True), (2, 0, 2, True), (4, 29_996, 4, True),
        (5, 29_997, 4, False), (5, 29_997, 4, False), (None, 1, None, True),
    ])
    assert rows(minhash.near_duplicates(docs_of()), "doc_id") == []


def test_one_document_of_each_group_of_near_copies_stays(spark, docs_of):
    base = " ".join(f"w{i}" for i in range(200))
    other = " ".join(f"o{i}" for i in range(200))
    docs = docs_of(
        (None, base), (None, base + " x"), (None, base + " y"), (None, base), (7, other), (7, other + " x"), (8, other + " y"),
        (None, None), (None, ""), (1, "q r s"), (1, "q r s"), (1, "t u v"),
    )
    found = [(r["doc_id"], (r["text"] or "-")[:2]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert Counter(found) == Counter([(None, "w0"), (7, "o0"), (None, "-"), (None, "-"), (1, "q "), (1, "t ")])


def test_exact_edges(docs_of):
    old = docs_of((1, "Same"), (2, None), (None, "alone"), (4, "É"))
    new = docs_of((9, "sAME"), (9, "same"), (8, ""), (7, "new"), (6, "é"))
    found = rows(exact.duplicates(old, new), "doc_id", "keep_id", "group_size", "kept")
    assert Counter(found) == Counter([
        (1, 9, 3, False), (9, 9, 3, True), (9, 9, 3, True), (2, 8, 2, False), (8, 8, 2, True),
        (None, None, 1, True), (4, 4, 1, True), (7, 7, 1, True), (6, 6, 1, True),
    ])
    assert exact.keep_one(exact.duplicates(old, new)).count() == 6
    assert exact.duplicates(docs_of(), docs_of()).count() == 0


def test_mixing_edges(docs_of):
    docs = docs_of((1, "a b c", None, "x"), (2, None, None, "x"), (3, "d", None, None), (3, "d", None, None), (4, "e f", None, "y"))
    mixed = mixing.mix(docs)
    for source in ("x", "y", None):
        own = [r for r in mixed.collect() if r["source"] == source]
        # Rows that repeat share what is left, so a word may be lost for each of them.
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) < len(own)
        assert all(r["taken"] <= 2 * (3 if r["doc_id"] == 1 else 2) for r in own)
    out = mixing.materialise(mixed)
    assert "node" in out.columns and out.count() == mixed.groupBy().sum("repeats").first()[0]
    assert mixing.mix(docs_of()).count() == 0


def test_decontamination_edges(spark, docs_of):
    bench = spark.createDataFrame(
        [(1, SENTENCE + " eleven"), (2, "short item"), (3, None), (3, "!"), (2, "Short, item")], "item_id long, text string"
    )
    long = "x " * 50_000
    docs = docs_of((1, f"so {SENTENCE.upper()}, eleven"), (2, "a SHORT item!"), (3, None), (3, ""), (4, f"{long} {SENTENCE} {long}"), (4, "short"))
    found = rows(decontamination.scan(docs, bench), "doc_id", "n_words", "n_hit", "items", "longest_match", "spans")
    assert found == sorted([
        (1, 12, 11, ["1"], 11, [1, 12]), (2, 3, 2, ["2"], 2, [1, 3]), (3, 0, 0, [], 0, []), (3, 0, 0, [], 0, []),
        (4, 100_010, 10, ["1"], 10, [50_000, 50_010]), (4, 1, 0, [], 0, []),
    ], key=repr)
    small_blocks = decontamination.scan(docs, bench, block_bytes=20)
    assert rows(small_blocks, "doc_id", "n_hit", "items") == [(f[0], f[2], f[3]) for f in found]
    assert decontamination.clean(docs, bench.limit(0)).count() == 6 and decontamination.scan(docs_of(), bench).count() == 0


def test_language(spark, docs_of):
    found = QUERIES["op4_language"](spark, "/root/testdata/sf0.01").collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in found if r["held_out"]]
    assert len(found) == 1000 and np.mean([lang[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)
    docs = docs_of((1, None), (2, "1 2 !"), (3, ""), (3, "été"))
    assert {r["lang_pred"] for r in language.predict(language.train(docs), docs).collect()} == {"und"}
    one = language.train(docs_of((1, "some words", "xx"), (2, None, "yy"), (3, "z", None)))
    assert rows(language.predict(one, docs), "doc_id", "lang_pred") == [(1, "und"), (2, "und"), (3, "und"), (3, "xx")]
    assert language.predict(one, docs_of()).count() == 0


def test_quality(spark, docs_of):
    found = QUERIES["op3_quality"](spark, "/root/testdata/sf0.01")
    seen = found.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect()
    assert np.mean([r["kept"] for r in seen if r["quality"] and not r["toxic"]]) > 0.9
    assert np.mean([r["kept"] for r in seen if not r["quality"]]) < 0.1
    docs = docs_of((1, "a b"), (1, "a b"), (2, None), (None, ""), (3, "c"))
    some = quality.resample(docs, docs.where("doc_id = 1"), 0.4)
    assert sum(r["kept"] for r in some.collect()) == 2 and rows(some, "n_grams", "doc_id")[0] == (0, 2)
    assert rows(some, "sample_key") == rows(quality.resample(docs, docs.where("doc_id = 1"), 0.4), "sample_key")
    assert quality.resample(docs_of(), docs_of(), 0.5).count() == 0


def test_lines(docs_of):
    line = "a line that is long enough to be compared by edits"
    docs = docs_of(
        (1, f"{line}\nx\n\n"), (2, f"{line[:-1]}\nx"), (3, f"b{line}\n{line} and more"), (4, None), (5, ""), (5, "y"), (5, "y"),
        (None, line.upper()),
    )
    found = rows(lines.report(docs), "doc_id", "n_lines", "removed")
    assert Counter(map(str, found)) == Counter(map(str, [
        (1, 4, []), (2, 2, [0, 1]), (3, 2, [0]), (4, 0, []), (5, 1, []), (5, 1, []), (5, 1, []), (None, 1, []),
    ]))
    kept = rows(lines.apply(docs, lines.duplicate_lines(docs)), "doc_id", "text")
    assert (3, f"{line} and more") in kept and (2, "") in kept and len(kept) == 8
    assert lines.report(docs_of()).count() == 0


def test_spans(docs_of):
    passage = "The first part is here. Then comes a second part of it. A third one follows soon after. And a fourth ends it."
    docs = docs_of((1, f"Start. {passage} Tail."), (2, f"other words before {passage} Else."), (3, None), (4, ""), (5, "Short. Text."), (None, passage))
    found = {r["doc_id"]: r for r in spans.drop_repeats(docs).collect()}
    assert found[1]["n_removed"] == 0 and found[1]["kept_text"] == f"Start. {passage} Tail."
    assert found[2]["n_removed"] >= 3 and found[2]["first_docs"] == [1] and found[2]["kept_text"].endswith("Else.")
    assert found[None]["n_removed"] == found[None]["n_pieces"] and found[None]["kept_text"] == ""
    assert found[3]["kept_text"] is None and found[4]["kept_text"] == "" and found[5]["n_removed"] == 0
    assert spans.drop_repeats(docs_of()).count() == 0


def shared_spans(first, second):
    """Spans of two texts that are in both."""
    hashes, _, first_word, rows, _, counts = spans.pieces(pa.array([first, second]))
    keys, owner, _, _ = spans.spans(hashes, first_word, rows, counts)
    return set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


@pytest.mark.parametrize("vocabulary", [1, 2, 3, 50, 5000])
def test_every_passage_of_51_words_has_a_span(vocabulary):
    rng = random.Random(vocabulary)

    def words(n, name, size, stops):
        return [f"{name}{rng.randrange(size)}" + rng.choice(".!?") * (rng.random() < stops) for _ in range(n)]

    for _ in range(1500):
        passage = words(51, "w", vocabulary, rng.choice([0, 0, 0.03, 0.08, 0.15, 0.4]))
        texts = [
            " ".join(words(rng.randrange(30), f"{side}a", 900, 0.05) + passage + words(rng.randrange(30), f"{side}z", 900, 0.05))
            for side in "lr"
        ]
        assert shared_spans(*texts), texts


@pytest.mark.parametrize("low, high, stop", [(0x4E00, 0x9FFF, "\u3002"), (0x3041, 0x3096, "\uff01"), (0x0E01, 0x0E2E, " ")])
def test_every_passage_without_spaces_has_a_span(low, high, stop):
    rng = random.Random(low)

    def letters(n, stops):
        return "".join(stop if rng.random() < stops else chr(rng.randrange(low, high)) for _ in range(n))

    for _ in range(500):
        passage = letters(80, rng.choice([0, 0.05, 0.1]))
        assert shared_spans(*(letters(rng.randrange(40), 0.05) + passage + letters(rng.randrange(40), 0.05) for _ in range(2))), passage


def test_spans_without_spaces(docs_of):
    passage = "".join(chr(0x4E00 + 37 * i) for i in range(100))
    found = {r["doc_id"]: r for r in spans.drop_repeats(docs_of((1, f"\u524d{passage}\u3002"), (2, f"abc {passage}\u3002\u540e\u6587"))).collect()}
    assert found[1]["n_removed"] == 0 and found[2]["n_removed"] >= 3 and found[2]["kept_text"].startswith("abc ")
    assert found[2]["kept_text"].endswith("\u540e\u6587") and len(found[2]["kept_text"]) < 40


def test_warc_chunks(spark, monkeypatch):
    big = "<p>\r\n\r\n</p>" * 60_000
    pages = spark.createDataFrame(
        [(1, "http://a/\r\n b", big), (2, None, big), (2, "u", None), (None, "v", big), (5, "w", "x" * 99), (6, "w", "x" * 99)],
        "page_id long, url string, html string",
    )
    folder, ranges = warc.write(pages, range_bytes=1)
    chunks = warc.read(folder, ranges).orderBy("page_id", "chunk").collect()
    first = [c for c in chunks if c["page_id"] == "1"]
    assert len(first) > 1 and b"".join(c["payload"] for c in first) == big.encode() and [c["last"] for c in first].count(True) == 1
    found = rows(warc.round_trip(pages), "page_id", "payload_bytes", "record_type", "refers_to")
    assert Counter(found) == Counter([
        (1, len(big), "response", None), (2, len(big), "revisit", 1), (2, 0, "response", None),
        (None, len(big), "revisit", 1), (5, 99, "response", None), (6, 99, "response", None),
    ])
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_archives_of_several_records(spark):
    texts = [" ".join(f"{i}w{i * k}" for k in range(i)) for i in range(60)]
    pages = spark.createDataFrame([(i, "u", t) for i, t in enumerate(texts)], "page_id long, url string, html string").coalesce(1)
    folder, ranges = warc.write(pages, file_bytes=3000, range_bytes=1000)
    archives = [r["n"] for r in ranges.groupBy("name").agg(F.sum("records").alias("n")).collect()]
    assert sum(archives) == 60 and len(archives) > 4 and max(archives) > 1
    found = warc.read(folder, ranges).orderBy(F.col("page_id").cast("long")).collect()
    assert [(r["page_id"], r["payload"].decode()) for r in found] == [(str(i), t) for i, t in enumerate(texts)]


def test_token_files(docs_of):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    texts = [(3, "Hi there, you.\nIt's é  ok"), (1, None), (1, ""), (None, " \x1c x y z\t"), (2, "word " * 20_000), (3, "a\n\nb c")]
    folder, dictionary, listed = token_files.write(docs_of(*texts), path, file_bytes=10)
    found = {(r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read(folder, dictionary, listed).collect()}
    at, want = 0, set()
    for _, text in sorted(texts, key=lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or "")):
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want.add((at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert found == want
    row = listed.where("doc_id = 2").first()
    assert len(token_files.read_document(folder, row["name"], row["position"], dictionary)) > 20_000
    assert token_files.round_trip(docs_of(), path).count() == 0


def test_token_files_of_several_documents(docs_of):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [(i, " ".join(f"w{i * k}" for k in range(i % 7))) for i in range(60)]
    folder, dictionary, listed = token_files.write(docs_of(*texts).coalesce(1), path, file_bytes=150)
    files = [r["docs"] for r in listed.select("name", "docs").distinct().collect()]
    assert sum(files) == 60 and len(files) > listed.select("piece").distinct().count() and max(files) > 1
    found = token_files.read(folder, dictionary, listed).orderBy("doc_id").collect()
    sizes = [len(token_files.Encoder(path).ids(text)) // 4 + 1 for _, text in texts]
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in found] == [(i, sum(sizes[:i]), sizes[i]) for i in range(60)]
