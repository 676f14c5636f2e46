import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracehouse.functions.scoring import canonical_tokens, combined, ratio, score_canonical, token_set_ratio
from tracehouse.operators import matching
from tracehouse.operators.matching import best_match

WORDS = "shiraz merlot pinot noir grigio riesling estate reserve old vine block hill valley red 2018 2019 2020".split()


def _canon(text):
    return " ".join(sorted(set("".join(c if c.isalnum() or c == "_" else " " for c in text.lower()).split())))


def _brute(left, right, min_score):
    found = {}
    for text in left:
        best = max(((score_canonical(_canon(text), _canon(r)), -i) for i, r in enumerate(right)))
        found[text] = (right[-best[1]], best[0]) if best[0] >= min_score or min_score <= 1 else (None, None)
    return found


def _typo(rng, text):
    chars = list(text)
    for _ in range(rng.randrange(4)):
        chars[rng.randrange(len(chars))] = rng.choice("aeiou xyz")
    return "".join(chars)


def _texts(seed, n):
    rng = random.Random(seed)
    right = sorted({" ".join(rng.sample(WORDS, rng.randrange(1, 5))) for _ in range(n)})
    rng.shuffle(right)
    left = sorted({_typo(rng, " ".join(rng.sample(r.split(), len(r.split())))) for r in right} | {"", "qqq", "#!"})
    return left, right


@pytest.mark.parametrize("min_score,block", [(1, 2000), (1, 7), (60, 2000), (76, 5), (90, 2000)])
def test_best_match_equals_brute_force(spark, min_score, block):
    left, right = _texts(min_score + block, 60)
    lf = spark.createDataFrame([(t,) for t in left], "l string")
    rf = spark.createDataFrame(list(enumerate(right)), "pos int, r string")
    rows = best_match(lf, rf, "l", "r", "pos", min_score=min_score, fallback=min_score <= 1, block=block).collect()
    assert len(rows) == len(left)
    got = {row["l"]: (row["match"], row["score"]) for row in rows}
    want = _brute(left, right, min_score)
    for text in ("", "#!"):  # no words: nothing to score
        want[text] = (right[0], 0) if min_score <= 1 else (None, None)
    assert got == want


def test_hot_copies_keep_every_left_row(spark):
    lf = spark.createDataFrame([(i, "Old Vine Shiraz") for i in range(200)], "i int, l string")
    rf = spark.createDataFrame([(0, "shiraz"), (1, "vine shiraz old"), (2, "pinot")], "pos int, r string")
    rows = best_match(lf, rf, "l", "r", "pos").collect()
    # a subset of the tokens scores 100 as well, and the earlier text wins
    assert len(rows) == 200 and {(r["match"], r["score"]) for r in rows} == {("shiraz", 100)}


def test_token_set_ratio_by_hand(spark):
    cases = [
        ("Pinot Noir", "noir pinot", 100),  # order does not count
        ("pinot noir 2018", "Pinot!", 100),  # subset
        ("abc", "xyz", 0),
        ("", "abc", 0),
        ("abcd", "abce", 75),  # 2*3/8
        ("red hill", "red dale", 67),  # shared 'red' 3: 2*3/11=55; 'red hill'/'red dale': 2*5/16=62...
    ]
    df = spark.createDataFrame(cases, "a string, b string, want int")
    rows = df.withColumn("got", token_set_ratio(F.col("a"), F.col("b"))).collect()
    by_hand = {(r["a"], r["b"]): r["got"] for r in rows}
    for a, b, want in cases[:5]:
        assert by_hand[a, b] == want
    # 'red dale' / 'red hill': 'red ' and one 'l' match: 2*5/16 = 62.5, which rounds to even
    assert by_hand["red hill", "red dale"] == 62
    assert ratio("", "a") == 0


def test_canonical_tokens(spark):
    row = spark.range(1).select(canonical_tokens(F.lit("  The-old  VINE, the vine_2 é ")).alias("c")).first()
    assert row["c"] == "old the vine vine_2 é"


def test_positions_keep_their_type(spark):
    big = 2**53
    lf = spark.createDataFrame([("old vine",), ("none",)], "l string")
    rf = spark.createDataFrame([(big + 1, "vine old"), (big, "Old Vine!"), (big + 2, "old")], "pos long, r string")
    assert {r["l"]: r["match"] for r in best_match(lf, rf, "l", "r", "pos").collect()}["old vine"] == "Old Vine!"
    dated = rf.withColumn("pos", F.col("pos").cast("string"))
    assert best_match(lf, dated, "l", "r", "pos").where("l = 'old vine'").first()["score"] == 100


def _subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        left = 0
        for k, y in enumerate(b, 1):
            left, row[k] = row[k], (left + 1 if x == y else max(row[k], row[k - 1]))
    return row[-1]


def test_common_subsequences_and_bounds(monkeypatch):
    """Short, long and empty texts; no bound lies below a score."""
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcdé 日", k=rng.choice([0, 1, 5, 30, 63, 64, 65, 90]))) for _ in range(40)]
    one, two = [t for t in texts[:20]], [t for t in texts[20:]]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(20), np.arange(20)))
    monkeypatch.setattr(matching, "_PAIRS", 33)
    found = matching._subsequences(one, two, i, j)
    assert found.tolist() == [_subsequence(one[a], two[b]) for a, b in zip(i, j)]
    assert found.tolist() == [matching.common_subsequence(one[a], two[b]) for a, b in zip(i, j)]
    letters = matching._Texts(one).common_letters(matching._Texts(two))
    assert all(letters[a, b] >= n for a, b, n in zip(i, j, found))


@pytest.mark.parametrize("least", [1, 60, 76, 90])
def test_blocks_equal_brute_force(least):
    rng = random.Random(least)
    left, right = _texts(least, 60)
    left = sorted({_canon(t) for t in left} - {""}) + ["".join(rng.choices("abc ", k=200)).strip()]
    left = [_canon(t) for t in left]
    right = sorted({_canon(t) for t in right} | {" ".join(sorted(set("".join(rng.choices("abcd ", k=150)).split())))})
    rng.shuffle(right)
    found = {r[0]: r[1:3] for r in matching._best_in_block(left, [(k, t, t) for k, t in enumerate(right)], least)}
    for text in left:
        best, place = max((score_canonical(text, r), -k) for k, r in enumerate(right))
        assert found.get(text) == ((best, -place) if best >= least else None)


def test_long_names_query_equals_brute_force(spark):
    """The query has no SQL: aligning all pairs there takes too long."""
    from tracehouse.entry.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = QUERIES["match_long_names"](spark, folder).collect()
    parts = spark.read.parquet(f"{folder}/part.parquet").collect()
    names = []
    for p in sorted(p["p_partkey"] for p in parts):
        words = []
        for k in range(6):
            number = zlib.crc32(f"{p}-{k}".encode())
            digits = [number // 100**i % 100 for i in range(2 + k % 3)]
            words.append("".join("bcdfghjklmnpqrstvwxz"[n // 5] + "aeiou"[n % 5] for n in digits))
        names.append(" ".join(words))
    assert len(rows) == len(parts)
    rng = random.Random(1)
    for row in rng.sample(rows, 40):
        best, place = max((score_canonical(_canon(row["left_string"]), _canon(n)), -k) for k, n in enumerate(names))
        assert (row["match"], row["score"]) == ((names[-place], best) if best >= 76 else (None, None))
    assert sum(r["score"] is not None for r in rows) > len(rows) // 2


def test_many_names_meet_by_pieces_not_in_the_grid(spark):
    """Names with a good match are not dealt to the grid, whose copies grow with the square of the names."""
    rng = random.Random(4)
    words = ["".join(rng.choices("bcdfghklmnprst", k=1) + rng.choices("aeiou", k=1) + rng.choices("bdgklmnprst", k=5)) for _ in range(300)]
    right = sorted({" ".join(sorted(rng.sample(words, 4))) for _ in range(250)} | {"short one", words[0]})
    left = sorted({_canon(_typo(rng, r)) for r in right} | {f"{words[0]} {right[5]} {right[9]}"})
    lf = spark.createDataFrame([(_canon(t),) for t in left], "canon string")
    rf = spark.createDataFrame([(r, k, r) for k, r in enumerate(right)], "canon string, position int, match string")
    schema = "canon string, score int, position int, match string"
    found, rest = matching._by_pieces(lf, rf, schema, 76, len(right), (len(left), len(right)))
    rest = {r["canon"] for r in rest.collect()}
    assert len(rest) < len(left) // 4
    got = {}
    for r in found.collect():
        got[r["canon"]] = max(got.get(r["canon"], (0, 0)), (r["score"], -r["position"]))
    for text in {_canon(t) for t in left} - rest:
        best = max((score_canonical(text, r), -k) for k, r in enumerate(right))
        assert got.get(text) == (best if best[0] >= 76 else None)


def test_needed_pieces_are_in_every_close_text():
    rng = random.Random(5)
    right = [_canon(" ".join(rng.sample(WORDS, rng.randrange(1, 6)))) for _ in range(150)]
    left = [t for t in (_canon(_typo(rng, r)) for r in right) if t]
    counts = np.zeros(matching._BINS, np.int32)
    held = [dict(matching._postings(r, counts, 60)) for r in right]
    for least in (60, 85, 95, 100):
        for text in left:
            keys = matching._needed(text, least, counts, 10**9) or ()
            close = [h for r, h in zip(right, held) if keys and score_canonical(text, r) >= least]
            assert all(any(h.get(k, 0) >= least for k in keys) for h in close)


def test_marks_rule_out_no_match():
    """Texts of many and of few letters, of one that comes often, and of several alphabets."""
    rng = random.Random(6)
    texts = [_canon(" ".join("".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(rng.randrange(1, 6)))) for letters in ("abc", "aaab", "bdkéжλ日", "abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(12)]
    one = matching._Texts(texts + [_canon(_typo(rng, t)) or "a" for t in texts])
    for least in (1, 60, 86, 95, 100):
        i, j = one.near(one, np.full(len(one.texts), least))
        near = set(zip(i.tolist(), j.tolist()))
        for a, text in enumerate(one.texts):
            for b, other in enumerate(one.texts):
                _, left, right = combined(text, other)
                assert (a, b) in near or ratio(left, right) < least


def test_known_scores_spare_the_grid_its_letters(monkeypatch):
    """Texts whose match has to reach a high score meet the others by marks alone: no product of all letters."""
    rng = random.Random(7)
    right = [" ".join(sorted({"".join(rng.choices("bcdfghklmnprstvw", k=4)) for _ in range(5)})) for _ in range(300)]
    left = [_canon(_typo(rng, r)) for r in right[:100]]
    floors = np.array([score_canonical(a, b) for a, b in zip(left, right)])
    monkeypatch.setattr(matching._Texts, "common_letters", None)
    found = {r[0]: r[1:3] for r in matching._best_in_block(left, [(k, t, t) for k, t in enumerate(right)], floors)}
    for text in left:
        best, place = max((score_canonical(text, r), -k) for k, r in enumerate(right))
        assert found[text] == (best, -place)


def test_texts_for_the_grid_keep_the_score_that_they_have_reached(spark):
    """A text whose pieces are too common has found a match already; what cannot beat it is not aligned again."""
    rng = random.Random(3)
    right = sorted({" ".join(sorted({"".join(rng.choices("bcdfghklmnprstvw", k=6)) for _ in range(4)})) for _ in range(120)})
    left = sorted({_canon(r[:-3] + "xyz") for r in right} | set(right[:5]))
    lf = spark.createDataFrame([(t,) for t in left], "canon string")
    rf = spark.createDataFrame([(r, k, r) for k, r in enumerate(right)], "canon string, position int, match string")
    _, rest = matching._by_pieces(lf, rf, "canon string, score int, position int, match string", 76, 3, (len(left), len(right)))
    floors = {r["canon"]: r["floor"] for r in rest.collect()}
    assert len(floors) > 50
    for text, floor in floors.items():
        assert floor == max(score_canonical(text, r) for r in right)
