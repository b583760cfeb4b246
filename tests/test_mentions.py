import random
import re

from citelight.operators.mentions import detection_metrics, mention_rank, mentions


def brute_force(texts, names):
    found = {}
    for key, text in texts:
        words = [w for w in re.split(r"[^\w']+|_", text.lower()) if w]
        for brand in {b for b, _ in names}:
            places = set()
            for spelling in {s for b, s in names if b == brand}:
                parts = [w for w in re.split(r"[^\w']+|_", spelling.lower()) if w]
                places |= {i for i in range(len(words)) if parts and words[i:i + len(parts)] == parts}
            if places:
                found[(key, brand)] = (len(places), min(places))
    return found


def check(spark, texts, names):
    df = mentions(
        spark.createDataFrame(texts, "id string, text string"),
        spark.createDataFrame(names, "brand_name string, spelling string"), "text", "id")
    got = {(r.id, r.brand_name): (r.mention_count, r.first_position) for r in df.collect()}
    assert got == brute_force(texts, names)
    return got


def test_single_words(spark):
    texts = [("1", "Rival and KB. rival!"), ("2", ""), ("3", "ČSOB, rival's KB-KB")]
    check(spark, texts, [("Rival", "rival"), ("KB", "KB"), ("KB", "kb"), ("ČSOB", "čsob")])


def test_phrases_against_brute_force(spark):
    random.seed(5)
    vocabulary = ["air", "bank", "air bank", "money", "x", "y", "Bank,", "AIR"]
    texts = [(str(i), " ".join(random.choices(vocabulary, k=random.randint(0, 60)))) for i in range(60)]
    check(spark, texts, [("Air Bank", "Air Bank"), ("Air Bank", "airbank"), ("Money", "money air bank"), ("Bank", "bank")])


def test_spellings_of_any_length(spark):
    """Spellings of every length from 1 to 40 words, cut from the texts, some with one word changed."""
    rng = random.Random(3)
    texts = [(str(i), " ".join(rng.choice("abc") for _ in range(rng.randint(0, 120)))) for i in range(20)]
    names = []
    for n in [*range(1, 20), 31, 32, 33, 40]:
        words = next(w for w in (t.split() for _, t in rng.sample(texts, len(texts))) if len(w) > n + 1)
        at = rng.randrange(len(words) - n)
        names.append((f"cut {n}", " ".join(words[at: at + n])))
        changed = words[at: at + n]
        changed[rng.randrange(n)] = "z"
        names.append((f"changed {n}", " ".join(changed)))
    got = check(spark, texts, [*names, ("none", ""), ("none", "...")])
    assert {b for _, b in got} == {b for b, _ in names if b.startswith("cut")}


def test_no_names_and_no_words(spark):
    assert check(spark, [("1", "a b"), ("2", "")], [("x", " ,")]) == {}


def test_rank_and_detection(spark):
    texts = [("1", "b then a then b"), ("2", "a"), ("3", "nothing")]
    found = mentions(
        spark.createDataFrame(texts, "id string, text string"),
        spark.createDataFrame([("A", "a"), ("B", "b")], "brand_name string, spelling string"), "text", "id")
    ranks = mention_rank(found, "id")
    assert {(r.id, r.brand_name): r.position_rank for r in ranks.collect()} == {("1", "B"): 1, ("1", "A"): 2, ("2", "A"): 1}
    got = {r.brand_name: (r.appearances, round(r.detection_rate, 3), r.top3_rate, r.avg_rank)
           for r in detection_metrics(ranks, len(texts)).collect()}
    assert got == {"A": (2, 66.667, 100.0, 1.5), "B": (1, 33.333, 100.0, 1.0)}
