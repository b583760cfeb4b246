"""Search, packing and run detection against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from citelight.llm import packing, periods, queries, search, token_files

FOLDER = "/root/testdata/sf0.001"
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- periodic runs ------------------------------------------------------------------------


def brute_runs(words):
    """Every stretch by comparing all words a period apart; the smallest periods come first."""
    codes = np.unique(np.array(words, object).astype(str), return_inverse=True)[1].astype(np.int16) if words else np.zeros(0)
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        same = codes[:-q] == codes[q:]
        if np.count_nonzero(same) < max(24, 3 * q) - q:
            continue
        same = np.r_[False, same, False]
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(edges[::2].tolist(), (edges[1::2] + q).tolist()):
            shorter = any((codes[start: end - p] == codes[start + p: end]).all() for p in range(1, q))
            if end - start >= max(24, 3 * q) and not shorter:
                found.append((start, end - start, q))
    return sorted(found)


def nested(rng, depth, size, letters):
    if not depth:
        return [rng.randrange(letters) for _ in range(size)]
    inner = nested(rng, depth - 1, max(1, size // rng.randint(2, 8)), letters)
    out = (inner * size)[:size]
    for _ in range(rng.randint(0, 2)):
        out[rng.randrange(size)] = rng.randrange(letters + 1)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_runs_against_brute_force(seed):
    rng, total = random.Random(seed), 0
    for _ in range(12):
        texts = []
        for _ in range(rng.randint(1, 4)):
            text = []
            for _ in range(rng.randint(1, 5)):
                group = nested(rng, rng.randint(0, 3), rng.randint(1, 90), rng.choice([1, 2, 2, 3, 10]))
                text += (group * 8)[: int(len(group) * rng.choice([1, 1, 2, 3, 3.2, 4.5, 6]))]
                text += [rng.randrange(50) for _ in range(rng.randint(0, 20))] * (rng.random() < 0.3)
            texts.append(text[:500])
        codes = np.array([c for t in texts for c in t], np.int64)
        first = np.cumsum([0, *map(len, texts)])
        want = [(k, *run) for k, t in enumerate(texts) for run in brute_runs(t)]
        assert [tuple(r) for r in periods.find_runs(codes, first).tolist()] == want
        total += len(want)
    assert total > 50


def planted(doc_id, text):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_of_runs_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op13_periods"](spark, FOLDER).collect()}
    assert len(got) == len(docs)
    with_runs = 0
    for doc in docs:
        words = planted(doc["doc_id"], doc["text"])
        runs = brute_runs(words)
        drop = {k for s, n, p in runs for k in range(s + p, s + n)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        row = got[doc["doc_id"]]
        assert row["n_runs"] == len(runs)
        assert (row["start"], row["length"], row["period"]) == (best or (None,) * 3)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        text = " ".join(w for k, w in enumerate(words) if k not in drop)
        assert row["collapsed_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert row["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        with_runs += bool(runs)
    assert with_runs >= 5


def test_runs_edges(spark):
    group = "a b c d e f g h i j"
    rows = [
        (1, None, "x", 1), (1, "", "x", 2), (2, " \t\n ", None, 3), (None, f"s {' '.join([group] * 3)}  z", "y", 4),
        (None, "w " * 23, "y", 5), (3, "w w " * 24 + "v", "y", 6),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, `start` long")
    found = {r["start"]: r for r in periods.detect(docs).collect()}
    assert periods.detect(docs).columns == ["doc_id", "start", "runs", "collapsed"]
    shown = {k: ([tuple(x) for x in r["runs"]], r["collapsed"]) for k, r in found.items()}
    assert shown == {
        1: ([], ""), 2: ([], ""), 3: ([], ""), 4: ([(1, 30, 10)], f"s {group} z"), 5: ([], " ".join(["w"] * 23)),
        6: ([(0, 24, 1)], "w w v"),
    }
    assert periods.detect(docs.where("false")).count() == 0


def test_runs_of_a_long_text(spark):
    rng = random.Random(1)
    group = [str(rng.random()) for _ in range(3000)]
    words = [str(rng.random()) for _ in range(20_000)] + group * 5 + ["end"]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = periods.detect(docs).first()
    assert [tuple(r) for r in row["runs"]] == [(20_000, 15_000, 3000)]
    assert row["collapsed"] == " ".join(words[:23_000] + ["end"])


# --- packing ------------------------------------------------------------------------------


def fewest(sizes, capacity):
    """The least number of sequences, over all subsets."""
    best = [(0, capacity)] + [(99, 0)] * ((1 << len(sizes)) - 1)
    for held in range(1, 1 << len(sizes)):
        for i, size in enumerate(sizes):
            if held >> i & 1:
                number, used = best[held ^ (1 << i)]
                best[held] = min(best[held], (number, used + size) if used + size <= capacity else (number + 1, size))
    return best[-1][0]


def test_packing_against_the_optimum():
    rng, improved = random.Random(5), 0
    for _ in range(120):
        capacity, n = rng.choice([20, 50, 100]), rng.randint(1, 10)
        low, high = rng.choice([(1, capacity), (capacity // 5, capacity // 2), (capacity // 4, capacity * 2 // 3)])
        sizes = [rng.randint(low, high) for _ in range(n)]
        counts = np.bincount(sizes, minlength=capacity + 1)
        made = packing.complete_bins(counts, capacity)
        assert sorted(s for m in made for s in m) == sorted(sizes) and all(sum(m) <= capacity for m in made)
        want = fewest(sizes, capacity)
        assert packing.lower_bound(counts, capacity) <= want == len(made)
        improved += len(packing.best_fit(counts, capacity)) > want
    assert improved  # completions beat best fit somewhere


def test_dominated_fillings():
    assert packing._dominated((3, 2), (5,)) and packing._dominated((4, 2), (5, 3)) and packing._dominated((), (1,))
    assert not packing._dominated((3, 3), (5, 2)) and not packing._dominated((6,), (5, 2))
    counts = np.bincount([5, 4, 3, 2], minlength=11)
    assert packing._fillings(counts, 7, 2) == [(5, 2), (4, 3)]
    assert packing._fillings(counts, 5, 5) == [(5,)]


def whole_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_encoder_against_the_library():
    rng = random.Random(3)
    letters = list("aAbB'sStTéÉñßİΣςσ１²½́<|>0.,!?-_ \t\n\r\x0b\x0c\x1c\x85\xa0中ก🎉‍﻿\x00") + ["<|endoftext|>", "'re", " "]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(4000)]
    for name, parts in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        path = public_tokenizers.path(name)
        encoder, tokenizer = packing.WordEncoder(path), Tokenizer.from_file(path)
        assert encoder.parts is parts
        for at in range(0, len(texts), 500):
            part = texts[at: at + 500]
            want = [array("I", whole_ids(tokenizer, t)[:-1]).tobytes() for t in part]
            assert encoder.ids(pa.array(part)) == want
            assert encoder.ids(pa.array(["x", *part, None])[1:]) == [*want, b""]


def test_remembered_words_stay_few_and_frequent(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    encoder, tokenizer = packing.WordEncoder(WORD_FILE), Tokenizer.from_file(WORD_FILE)
    for k in range(40):
        text = " ".join(["often", *(f"rare{k * 20 + j}" for j in range(20))])
        assert encoder.ids(pa.array([text])) == [array("I", whole_ids(tokenizer, text)[:-1]).tobytes()]
        assert b"often" in encoder.young or b"often" in encoder.old
        assert len(encoder.young) <= 100 and len(encoder.old) <= 100


def check_packed(rows, texts, capacity):
    """Pieces restore the ids, sequences are gapless; the number of sequences."""
    tokenizer, placed, pieces = Tokenizer.from_file(WORD_FILE), defaultdict(list), Counter()
    want = Counter()
    for doc_id, text in texts:
        ids = whole_ids(tokenizer, text)
        for at in range(0, len(ids), capacity):
            part = ids[at: at + capacity]
            want[doc_id, at // capacity, at, len(part), zlib.crc32(array("I", part).tobytes())] += 1
    for r in rows:
        pieces[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        placed[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces == want
    for inside in placed.values():
        ends = np.cumsum([0, *(n for _, n in sorted(inside))]).tolist()
        assert [o for o, _ in sorted(inside)] == ends[:-1] and ends[-1] <= capacity
    return len(placed)


def test_query_of_packing(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.QUERIES["op12_packing"](spark, FOLDER).collect()
    counts = np.bincount([r["length"] for r in rows], minlength=2049)
    assert check_packed(rows, docs, 2048) == packing.lower_bound(counts, 2048)


def test_packing_edges_and_groups(spark):
    rng = random.Random(2)
    texts = [(None, None), (1, ""), (1, ""), (2, "one two " * 40), (None, "x y"), (None, "x y")]
    texts += [(k, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randint(0, 30)))) for k in range(200)]
    docs = spark.createDataFrame([(*t, "k", 7) for t in texts], "doc_id long, text string, `key` string, `length` long")
    pieces = packing.cut(docs, WORD_FILE, 64)
    assert pieces.columns == ["doc_id", "piece", "start", "length", "ids"]
    extra = pieces.withColumn("key", F.lit("k")).withColumn("row", F.lit(1)).withColumn("again", F.lit(True)).withColumn("ids_crc32", F.crc32("ids"))
    one = packing.pack(extra, 64).collect()
    many = packing.pack(extra, 64, group_pieces=20).collect()
    best = check_packed(one, texts, 64)
    # Groups of few pieces lose less than a sequence each, most of which the later turns win back.
    assert best <= check_packed(many, texts, 64) <= best + 4
    assert one[0]["key"] == "k" and one[0]["again"] is True
    assert packing.pack(pieces.where("false")).count() == 0


def test_sequences_hold_the_pieces(spark):
    texts = [(k, f"word{k} " * (k % 7)) for k in range(60)]
    packed = packing.pack(packing.cut(spark.createDataFrame(texts, "doc_id long, text string"), WORD_FILE, 32), 32)
    tokenizer = Tokenizer.from_file(WORD_FILE)
    for row in packing.sequences(packed).collect():
        ids = array("I", bytes(row["ids"])).tolist()
        assert len(ids) == row["length"] <= 32
        for p in row["pieces"]:
            own = whole_ids(tokenizer, texts[p["doc_id"]][1])[p["piece"] * 32: p["piece"] * 32 + 32]
            assert ids[p["offset"]: p["offset"] + len(own)] == own


# --- search -------------------------------------------------------------------------------


def brute_search(items, docs, k):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    held = [(i, Counter(cut(t))) for i, t in docs if cut(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, tfs in held:
            m = 50 + 50 * sum(tfs.values()) * n_docs // n_terms
            score = 0
            for term in set(cut(text)) & set(tfs):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += w * (10**9 * tfs[term] // (1000 * tfs[term] + 20 * m))
            scores += [(-score, doc is None, doc)] * (score > 0)
        ranked = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(ranked, 1)]
    return Counter(out)


def test_search_edges(spark):
    docs = [
        (3, "Alpha beta"), (1, "alpha BETA"), (2, None), (4, ""), (5, "... !"), (6, "é alpha"), (6, "é alpha"), (None, "beta"),
        (7, "gamma " * 5000 + "alpha"), *[(k, "delta epsilon") for k in range(100, 130)],
    ]
    items = [(1, "ALPHA alpha?"), (2, "É-beta"), (2, "É-beta"), (None, "delta"), (3, None), (4, "!!"), (5, "unknown"), (6, "epsilon gamma delta")]
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n long, `terms` string")
    wanted = spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, `number` long")
    for k in (3, 50):
        got = Counter(tuple(r) for r in search.search(wanted, table, k).collect())
        assert got == brute_search(items, docs, k)
    assert search.search(wanted.where("false"), table).count() == 0
    assert search.search(wanted, table.where("false")).columns == ["item_id", "rank", "doc_id", "score"]
    assert search.search(wanted, table.where("false")).count() == 0


def test_search_in_blocks_and_tiles(spark, monkeypatch):
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice("abcdefghij") + rng.choice("klm") for _ in range(n))
    docs = [(rng.randrange(200), text(rng.randint(0, 40))) for _ in range(300)]
    items = [(k, text(6)) for k in range(30)]
    monkeypatch.setattr(search, "BLOCK_TERMS", 40)
    monkeypatch.setattr(search, "BLOCK_ITEMS", 10)
    got = Counter(tuple(r) for r in search.search(
        spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string"), 7
    ).collect())
    assert got == brute_search(items, docs, 7)


def test_products_are_exact_beyond_the_bound():
    weights = np.full(6000, 28_000, np.int64) + np.arange(6000)
    tiles = search.term_tiles(weights)
    assert tiles[0].start == 0 and tiles[-1].stop == 6000 and all(a.stop == b.start for a, b in zip(tiles, tiles[1:]))
    assert all(int(weights[t].sum()) * search._IMPACT < 2**53 for t in tiles)
    row, term = np.repeat(np.arange(2), 6000), np.tile(np.arange(6000), 2)
    impact = np.random.default_rng(1).integers(1, 10**6, 12_000)
    got = search.tile_scores(np.ones((1, 6000), bool), weights, row, term, impact, 2)
    assert got.tolist() == [[int((weights * impact[:6000]).sum()), int((weights * impact[6000:]).sum())]]


def test_ties_keep_the_smaller_rows():
    best = search.Best(1, 3)
    for first, scores in ((0, [5, 0, 7, 5]), (4, [5, 7, 1, 5]), (8, [9, 7])):
        best.offer(np.array([scores]), first)
    assert best.score.tolist() == [[9, 7, 7]] and best.row.tolist() == [[8, 2, 5]]


def test_token_file_encoder_against_the_library(monkeypatch):
    """Random texts, with a memory so small that words are forgotten on the way; other tokenizers get whole texts."""
    monkeypatch.setattr(token_files, "REMEMBERED", 200)
    rng = random.Random(4)
    letters = list("aAbB'sé1.,!<|> \t\n\r\x0b\x1c\x85\xa0中🎉\x00") + ["<|endoftext|>", "word", "Word.", " ", "\n"]
    plain = ["ab", "éa", "x.", "it's", "a1", "\nb", "!?", "Hello", "often"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += [" ".join(rng.choice(plain) + rng.choice(["", "", str(rng.randrange(900))]) for _ in range(rng.randint(0, 20))) for _ in range(3000)]
    for name, fast in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        path = public_tokenizers.path(name)
        encoder, tokenizer = token_files.Encoder(path), Tokenizer.from_file(path)
        assert encoder.fast is fast
        for at in range(0, len(texts), 250):
            part = texts[at: at + 250]
            want = [array("I", whole_ids(tokenizer, t)[:-1]).tobytes() for t in part]
            assert encoder.batch(pa.array(["x", *part, None])[1:]) == [*want, b""]
        assert len(encoder.words) <= 1500


def test_a_lower_casing_tokenizer_is_not_taken_for_plain(tmp_path):
    import json

    with open(public_tokenizers.path("byte_bpe_50k.json")) as stream:
        form = json.load(stream)
    form["normalizer"] = {"type": "Lowercase"}
    (tmp_path / "t.json").write_text(json.dumps(form))
    encoder = token_files.Encoder(str(tmp_path / "t.json"))
    assert encoder.ids("Hello Big World") == array("I", encoder.tokenizer.encode("hello big world").ids).tobytes()
