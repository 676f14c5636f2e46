"""Merge replay, periodic runs and hard negatives against the library and brute force."""

from __future__ import annotations

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.fixtures import WORD, documents, none, texts
from tracehouse.llm import hard_negatives, merge_replay, periodic_runs

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = st.text(alphabet=st.sampled_from("abcXYZ's 12\n\t  \x1cé̈Σß½<|endoftext|>!?Ɤ日🙂՘౜한русk"), max_size=80)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merge_replay.read_ranks(RANKS), special_tokens={}
    )


def cut(ids: np.ndarray, sizes: np.ndarray) -> list[list[int]]:
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]


# --- merge replay -----------------------------------------------------------------------------------


def test_merge_replay_equals_the_library(spark, library):
    docs = documents(spark).withColumn("copy", F.col("text")).withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(2))
    rows = merge_replay.encode_decode(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row["ids"] == library.encode_ordinary(row["copy"] or "")
        assert bytes(row["decoded"]) == (row["copy"] or "").encode()
        assert row["note"] in ("n", None)
    assert merge_replay.encode_decode(none(spark), RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=4))
def test_merge_replay_of_odd_texts(batch):
    ranks = merge_replay.read_ranks(RANKS)
    coder = merge_replay.coder_of(ranks, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=coder.source, mergeable_ranks=ranks, special_tokens={})
    assert cut(*coder.encode(batch)) == [library.encode_ordinary(t) for t in batch]


def test_merges_that_make_lower_ranks_and_words_that_are_tokens():
    """Made-up ranks in any order: pairs of lower rank appear late, and some tokens no merge reaches."""
    rng = random.Random(5)
    for _ in range(60):
        tokens = {bytes([b]) for b in range(256)}
        tokens |= {bytes(rng.choices(b"ab ", k=rng.randint(2, 5))) for _ in range(25)}
        several = sorted(t for t in tokens if len(t) > 1)
        rng.shuffle(several)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(several)}
        library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        coder = merge_replay.ByteBpe(ranks, public_tokenizers.PATTERN)
        batch = ["".join(rng.choices("ab ", weights=[4, 4, 1], k=rng.randint(0, 40))) for _ in range(20)]
        assert cut(*coder.encode(batch)) == [library.encode_ordinary(t) for t in batch]


def test_memory_keeps_the_parts_asked_for_most(library):
    coder = merge_replay.ByteBpe(merge_replay.read_ranks(RANKS), public_tokenizers.PATTERN)
    rng = random.Random(2)
    often = ["often", "again", "and again"]
    for _ in range(12):
        batch = [" ".join([*often, *("".join(rng.choices("xyzäw", k=9)) for _ in range(60)), "l" * 200]) for _ in range(5)]
        assert cut(*coder.encode(batch)) == [library.encode_ordinary(t) for t in batch]
        coder.parts.forget(100)
        coder.words.forget(100)
        assert len(coder.parts.numbers) <= 100 and {"often", "again", "and"} - {"often"} <= set(coder.parts.numbers)


def test_decode_alone(spark, library):
    rows = spark.createDataFrame(
        [(1, library.encode_ordinary("añ 日 x")), (2, []), (3, None), (None, [257])], "id long, ids array<int>"
    )
    found = {r["id"]: r["decoded"] for r in merge_replay.decode(rows, RANKS).collect()}
    assert bytes(found[1]).decode() == "añ 日 x" and bytes(found[2]) == b"" and found[3] is None
    assert bytes(found[None]) == library.decode_bytes([257])
    for wrong in ([99_999], [-1]):
        with pytest.raises(Exception, match="no token"):
            merge_replay.decode(spark.createDataFrame([(wrong,)], "ids array<int>"), RANKS).collect()


def test_wrong_rank_files_fail(spark, tmp_path):
    path = tmp_path / "short.tiktoken"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError, match="byte"):
        merge_replay.encode_decode(none(spark), str(path), public_tokenizers.PATTERN)


# --- periodic runs ----------------------------------------------------------------------------------


def brute_runs(w: list) -> list[tuple[int, int, int]]:
    """Every period, every diagonal; then no stretch that has a smaller period."""
    found = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                stretch = w[i : i + length]
                if all(any(stretch[k] != stretch[k + d] for k in range(length - d)) for d in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


WORDS = st.lists(st.sampled_from("aab"), max_size=40) | st.builds(
    lambda head, unit, n, tail: [*head, *(unit * n)[: n * len(unit) - len(tail)], *tail],
    st.lists(st.sampled_from("abc"), max_size=9),
    st.lists(st.sampled_from("abc"), min_size=1, max_size=14),
    st.integers(3, 7),
    st.lists(st.sampled_from("abc"), max_size=9),
)


@settings(max_examples=600, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=5))
def test_runs_equal_brute_force(batch):
    number: dict = {}
    symbols = np.array([number.setdefault(w, len(number)) for own in batch for w in own], np.int64)
    found = periodic_runs.find_runs(symbols, np.cumsum([len(own) for own in batch]))
    for i, own in enumerate(batch):
        assert found.get(i, []) == brute_runs(own)


def test_unit_of_doubled_grams():
    """Every short gram of the unit occurs in it twice, so only grams as long as the unit tell its copies apart."""
    unit = list("aababbaabbab" + "aabbabaababb")
    w = ["x", *(unit * 5), "y"]
    number: dict = {}
    symbols = np.array([number.setdefault(x, len(number)) for x in w], np.int64)
    assert periodic_runs.find_runs(symbols, np.array([len(w)]))[0] == brute_runs(w)


def test_seeds_grow_with_the_text_not_with_its_square():
    for w in (["a"] * 4000, ["a", "b", "c"] * 1500, [str(i % 900) for i in range(4000)]):
        number: dict = {}
        symbols = np.array([number.setdefault(x, len(number)) for x in w], np.int64)
        names = periodic_runs.Grams(symbols, np.zeros(len(w), np.int64)).ones
        islands = periodic_runs._seeds(names, 1, len(w))
        assert sum(last - first + 1 for _, first, last in islands) <= len(w)


def plant(own: list[str], doc_id: int | None) -> list[str]:
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not own:
        return own
    g, n = h // 10, len(own)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]


def test_periodic_runs_of_documents(spark):
    bodies = [t for t in texts() if len(t or "") < 10_000] * 4 + ["la " * 40 + "end", "a b " * 9, "x\x1cy z"]
    docs = documents(spark, bodies)
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    marked = periodic_runs.planted(docs.withColumn("copy", F.col("text")).withColumn("runs", F.lit(0)), number)
    lines = periodic_runs.run_lines(F.col("runs")).alias("lines")
    rows = periodic_runs.periodic_runs(marked).select("doc_id", "copy", "n_words", "runs", "best", "collapsed", lines, "note")
    seen = 0
    for row in rows.collect():
        own = plant(WORD.findall(row["copy"] or ""), row["doc_id"])
        expected = brute_runs(own)
        seen += len(expected)
        assert row["n_words"] == len(own) and [tuple(r) for r in row["runs"]] == expected
        best = min(expected, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        assert (row["best"] and tuple(row["best"])) == best
        gone = {i for s, n, q in expected for i in range(s + q, s + n)}
        assert row["collapsed"] == " ".join(w for i, w in enumerate(own) if i not in gone)
        assert row["lines"] == "".join(f"{s},{n},{q}\n" for s, n, q in expected)
    assert seen >= 5
    assert periodic_runs.periodic_runs(none(spark)).count() == 0


# --- hard negatives ---------------------------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 700), st.sampled_from([1, 3, 200, 30_000, 2**20]), st.integers(0, 99))
def test_residue_products_are_exact(width, size, seed):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(-size, size + 1, (n, width)) for n in (5, 7))
    bound = hard_negatives.greatest(a) * hard_negatives.greatest(b)
    prepared = hard_negatives.Residues(b, bound)
    assert (prepared.scores(a) == a @ b.T).all()
    for p in prepared.primes:
        assert min(width, hard_negatives.CHUNK) * (p // 2) ** 2 <= hard_negatives.EXACT


def brute_negatives(rows, every, positives=5, negatives=10):
    """``rows``: (id, label, whole components); ids are unique."""
    out = []
    for a, label, x in rows:
        if a % every:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y, strict=True)), b, other) for b, other, y in rows if b != a and len(y) == len(x)]
        for s, p, _ in sorted(t for t in scored if t[2] == label)[:positives]:
            fits = sorted(t for t in scored if t[2] != label and -30 * s <= -100 * t[0] <= -90 * s)
            out += [(a, p, i + 1, b, -s, -t) for i, (t, b, _) in enumerate(fits[:negatives])]
    return out


SCHEMA = "vec_id long, embedding array<double>, label int, rank string"


def vectors(seed: int, n: int, hot: float = 0.4):
    """Ties, equal rows, a hot label, small and large components, two widths, and rows that take no part."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        width = 6 if i % 9 else 4
        x = [rng.choice([-1.0, 0.0, 0.25, 0.5, 1.0]) + rng.choice([0.0, 0.0, 0.01]) for _ in range(width)]
        if i % 50 == 7:
            x = [100.0 * v for v in x]
        rows.append((i, x, 0 if rng.random() < hot else rng.randint(1, 4), "own"))
    odd = [(n + 1, None, 1, "o"), (n + 2, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1, "o"), (n + 3, [float("nan")] * 6, 1, "o")]
    odd += [(n + 4, [float("inf")] + [1.0] * 5, 1, "o"), (n + 5, [1.0] * 6, None, "o"), (None, [1.0] * 6, 1, "o")]
    odd += [(n + 6, [], 1, "o"), (n + 7, [], 2, "o")]
    return rows, odd


@pytest.mark.parametrize("limits", [{}, {"cell_rows": 40, "least_rows": 16}])
def test_hard_negatives_equal_brute_force(spark, limits):
    rows, odd = vectors(1, 300)
    df = spark.createDataFrame([*rows, *odd, rows[10], (20, [9.0] * 6, 4, "a greater label")], SCHEMA)
    whole = [(i, label, [int(np.floor(256 * v)) for v in x]) for i, x, label, _ in rows]
    whole += [(i, label, []) for i, x, label, _ in odd if x == []]
    expected = brute_negatives(whole, 20)
    found = hard_negatives.mine_negatives(df, F.col("vec_id") % 20 == 0, **limits)
    assert sorted(map(tuple, found.collect())) == sorted(expected) and len(expected) > 200


@pytest.mark.parametrize("limits", [{}, {"TILE": 100}, {"LIMIT": 1 << 40}])
def test_tiles_of_a_cell(monkeypatch, limits):
    """Small tiles, and scores so large that only few rows fit a key, give the same scores and order."""
    for name, value in limits.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(3)
    x = rng.integers(-30_000, 30_000, (60, 5))
    x[10:20] = x[20:30]
    table = pa.table(
        {"vec_id": rng.permutation(60), "label": np.zeros(60, int), "width": [5] * 60, "unit": [4] * 60,
         "data": [r.astype("<i4").tobytes() for r in x]}
    )
    cell = hard_negatives._Cell(table.slice(0, 7), table)
    order = np.argsort(np.asarray(table.column("vec_id")))
    scores = x[:7] @ x[order].T
    seen = np.zeros(scores.shape, bool)
    for own, part, r, keys in cell.tiles():
        assert (keys // r == scores[own, part]).all()
        assert (r - 1 - keys % r == np.arange(keys.shape[1])).all()
        seen[own, part] = True
    assert seen.all()


def test_hard_negatives_without_rows(spark):
    rows, odd = vectors(2, 30)
    empty = spark.createDataFrame([], SCHEMA)
    for df, condition in ((empty, F.lit(True)), (spark.createDataFrame(odd, SCHEMA), F.col("vec_id") < 0)):
        assert hard_negatives.mine_negatives(df, condition).count() == 0
    with pytest.raises(Exception, match="2\\*\\*62"):
        hard_negatives.mine_negatives(spark.createDataFrame([(1, [1e300], 1, "")], SCHEMA), F.lit(True)).collect()
