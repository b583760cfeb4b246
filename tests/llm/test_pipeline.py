"""Every stage of the pipeline, and the whole run, against brute force over one small table."""

import re
import zlib
from array import array
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from citelight.llm import mixing
from citelight.session import staged
from test_operators import brute_components

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def windows(text, n=10):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, {tuple(words[i: i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def clean(docs, bench):
    """Documents that hold no window of an item; items of fewer than ten words are windows of their own."""
    held = set().union(*[windows(text)[1] for text in bench])
    sizes = {len(w) for w in held}
    kept = []
    for row in docs:
        words, _ = windows(row["text"])
        if not any(tuple(words[i: i + n]) in held for n in sizes for i in range(len(words) - n + 1)):
            kept.append(row)
    return kept


def as_rows(rows):
    return Counter(tuple(r[c] for c in corpus_pipeline.COLUMNS) for r in rows)


def test_stages_and_run(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_duplicates", "decontamination", "mixing", "token_files"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    step = lambda name: staged(stages[name](spark, docs, FOLDER), name)

    before = docs.collect()
    docs = step("language_id")
    after = docs.collect()
    assert as_rows(after) == as_rows(r for r in before if any(c.isalpha() for c in r["text"] or ""))

    before = sorted(after, key=lambda r: r["doc_id"])
    docs = step("near_duplicates")
    after = docs.collect()
    _, top = brute_components([r["text"] for r in before], 5, 80)
    assert as_rows(after) == as_rows(before[i] for i in sorted(set(top)))
    assert len(after) < len(before)

    before = after
    docs = step("decontamination")
    after = docs.collect()
    bench = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert as_rows(after) == as_rows(clean(before, bench)) and len(after) < len(before)

    # A document as often as it is taken; the sum of each source is within a document of its target.
    mixed = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    docs = step("mixing")
    taken = docs.collect()
    assert Counter(r["doc_id"] for r in taken) == Counter({d: r["repeats"] for d, r in mixed.items() if r["repeats"]})
    words, largest, target = Counter(), Counter(), {}
    for row in taken:
        words[row["source"]] += mixed[row["doc_id"]]["size"]
    for row in mixed.values():
        target[row["source"]] = row["target"]
        largest[row["source"]] = max(largest[row["source"]], row["size"])
    assert all(abs(words[s] - target[s]) <= largest[s] for s in target)

    # The files give the ids of the library, in ascending order of documents.
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r["doc_id"]: [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0] for r in taken}
    start, want = 0, []
    for row in sorted(taken, key=lambda r: r["doc_id"]):
        own = ids[row["doc_id"]]
        want.append((row["doc_id"], start, len(own), zlib.crc32(array("I", own).tobytes())))
        start += len(own)
    written = stages["token_files"](spark, docs, FOLDER)
    assert sorted(map(tuple, written.collect())) == want
    # The run is the stages one after the other.
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == want
