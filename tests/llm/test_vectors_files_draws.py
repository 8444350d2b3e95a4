"""Whitening, files of token ids and the weighted draw against plain versions, and on odd tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from playlake.llm import importance, queries, token_files, whitening
from playlake.llm.rows import numbered
from playlake.session import fresh_dir
from tests.conftest import TINY

COLUMNS = "doc_id long, text string"
CLASH = ("rid", "part", "task", "place", "rank", "score", "key", "vector", "start", "number", "n_ids", "rows")


@pytest.fixture(scope="module")
def docs(spark):
    def build(rows):
        data = [(*row, *("x" for _ in CLASH)) for row in rows]
        return spark.createDataFrame(data, ", ".join([COLUMNS, *(f"{c} string" for c in CLASH)]))

    return build


@pytest.fixture(scope="module")
def vectors(spark):
    def build(rows):
        data = [(*row, *("x" for _ in CLASH)) for row in rows]
        kinds = ", ".join(["vec_id long, embedding array<float>", *(f"{c} string" for c in CLASH)])
        return spark.createDataFrame(data, kinds)

    return build


# whitening


@pytest.mark.parametrize("case", ["plain", "repeated", "flat", "few"])
def test_rank_one_updates_give_the_scatter(case):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 9)) * rng.exponential(size=9) * 50
    if case == "repeated":
        x = x[rng.integers(0, 5, 200)]
    elif case == "flat":
        x[:, 3], x[:, 4] = x[:, 5], 7.0
    elif case == "few":
        x = rng.integers(0, 2, (200, 9)).astype(float)
    parts = [whitening.Spectrum(9) for _ in range(3)]
    for n, vector in enumerate(x):
        parts[min(n // 40, 2)].add(vector)
    total = parts[0]
    for part in parts[1:]:
        total.merge(part)
    want = np.cov(x.T, bias=True) * len(x)
    assert total.n == len(x) and np.allclose(total.mean, x.mean(axis=0))
    assert np.allclose(total.basis.T @ total.basis, np.eye(9), atol=1e-12)
    assert np.allclose(total.basis * total.roots @ total.basis.T, want, atol=1e-11 * np.abs(want).max())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(1e-3, 100), st.floats(-20, 20).filter(lambda v: abs(v) > 1e-3)), min_size=1, max_size=12))
def test_secular_equation_gives_the_roots(pairs):
    d = np.cumsum([gap for gap, _ in pairs])
    z = np.array([v for _, v in pairs])
    roots, turn = whitening.secular(d, z)
    whole = np.diag(d) + np.outer(z, z)
    scale = np.abs(whole).max()
    assert np.allclose(roots, np.linalg.eigvalsh(whole), atol=1e-12 * scale * len(d))
    assert np.allclose(turn.T @ turn, np.eye(len(d)), atol=1e-11)
    assert np.allclose(turn * roots @ turn.T, whole, atol=1e-11 * scale * len(d))


def plain_whitening(entries: np.ndarray):
    x = np.floor(entries.astype(np.float64) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    deviation = ((n * x.astype(object) - sums) ** 2).sum(axis=1)
    return centred @ basis / np.sqrt(np.maximum(values, 1e-300)), values / values.sum(), deviation


def check_whitening(out, ids, entries):
    want, shares, deviation = plain_whitening(entries)
    count = max(r.component for r in out)
    assert len(out) == len(ids) * count
    assert Counter(r.vec_id for r in out) == Counter(i for i in ids for _ in range(count))
    by_id = {i: n for n, i in enumerate(ids)}
    signs = {}
    for r in out:
        row = by_id[r.vec_id]
        assert r.n == len(ids) and r.deviation == deviation[row] == r.deviation_wide
        assert math.isclose(r.explained, shares[r.component - 1], rel_tol=1e-9)
        assert r.identity_error < 1e-9
        value = want[row, r.component - 1]
        if abs(value) > 1e-6:
            assert signs.setdefault(r.component, r.whitened * value > 0) == (r.whitened * value > 0)
        assert math.isclose(abs(r.whitened), abs(value), abs_tol=1e-7, rel_tol=1e-9)
    return count


def test_whitening_of_the_given_table(spark):
    table = spark.read.parquet(f"{TINY}/embeddings.parquet")
    held = table.select("vec_id", "embedding").toPandas()
    out = queries.op11_whitening(spark, TINY).collect()
    assert check_whitening(out, held.vec_id.tolist(), np.array(held.embedding.tolist())) == 8


def test_whitening_leaves_out_what_does_not_count(vectors):
    rng = np.random.default_rng(5)
    rows = [(n, rng.normal(size=5).astype(np.float32).tolist()) for n in range(300)]
    rows += [(900 + n, rows[0][1]) for n in range(150)]  # copies
    odd = [
        (1000, None), (1001, [1.0, None, 1.0, 1.0, 1.0]), (1002, [float("nan")] * 5), (1003, [float("inf")] * 5),
        (1004, []), (1005, [1.0]), (1006, [3e38] * 5),
    ]
    out = whitening.whitened(vectors([*rows, *odd]).repartition(7)).collect()
    assert check_whitening(out, [i for i, _ in rows], np.array([v for _, v in rows])) == 5


def test_whitening_of_few_directions_and_of_none(vectors):
    flat = [(n, [float(n % 7), float(n % 3), 1.0]) for n in range(40)]
    out = whitening.whitened(vectors(flat)).collect()
    assert {r.component for r in out} == {1, 2}
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        frame = whitening.whitened(vectors(rows))
        assert frame.collect() == []
        assert frame.columns[:4] == ["vec_id", "component", "n", "deviation"]


def test_deviation_beyond_a_long_stays_exact():
    fitted = whitening.Whitening(3 * 10**9, [3 * 10**14] * 2, np.ones(2), np.eye(2), 2.0)
    x = np.array([[100_000 + 4, 100_000], [100_000 + 10**6, 100_000 - 10**6]])
    assert fitted.deviations(x) == [(3 * 10**9 * 4) ** 2, 2 * (3 * 10**15) ** 2]


# files of token ids


@pytest.mark.parametrize("most", [1, 2, 5, 300, 49_408, 2**32])
def test_any_token_and_any_run_of_a_file(most):
    rng = np.random.default_rng(most)
    ids = (rng.random(6000) ** 6 * most).astype(np.uint64).astype(np.uint32)
    ends = np.array([0, 5, 5, 4000, 6000])
    file = token_files.TokenFile(token_files.encoded(ids, ends, pa.array(["a", None, "b", "c", "d"])))
    places = rng.integers(0, 6000, 500)
    assert (file.at(places) == ids[places]).all() and (file.at(np.arange(6000)) == ids).all()
    for first, last in np.sort(rng.integers(0, 6001, (80, 2)), axis=1).tolist():
        assert (file.run(first, last) == ids[first:last]).all()
    assert file.docs().to_pylist() == ["a", None, "b", "c", "d"]
    assert file.document(0).tolist() == [] and (file.document(3) == ids[5:4000]).all()
    with pytest.raises(IndexError):
        file.at([6000])
    with pytest.raises(IndexError):
        file.run(5, 6001)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=300))
def test_file_round_trip(values):
    ids = np.array(values, np.uint32)
    file = token_files.TokenFile(token_files.encoded(ids, np.array([len(ids)]), pa.array([1])))
    assert file.run(0, len(ids)).tolist() == values and file.at(range(len(ids))).tolist() == values


def test_widths_are_the_smallest():
    lengths = np.zeros(33, np.int64)
    lengths[[3, 9, 16]] = 1000, 100, 10

    def bits(chosen):
        total, begin = 0, 0
        for number, width in enumerate(chosen):
            reach = lengths.sum() if begin == 0 else lengths[begin + 1 :].sum()
            total += reach * (width + (number + 1 < len(chosen)))
            begin += width
        return total

    every = [[16], *([w, 16 - w] for w in range(1, 16))]
    assert bits(token_files.widths(lengths)) == min(map(bits, every))


ODD = [
    (3, "ein Wort\n\nzwei <|endoftext|> drei<|startoftext|>vier \x00 　 x́ İ Ǆ ﬁ 漢字 👩‍👩‍👧 ½ it's I'LL 'SAY' (\"ÄÖÜ\")."),
    (5, None),
    (1, "the end. The END, the end's"),
    (1, "the end. The END, the end's"),
    (1, "other text of the same id"),
    (None, "no id \x1c \x85 a\xa0b ΑΣ. <|ENDOFTEXT|> <|endof text|>"),
    (2, ""),
    (7, "a" * 5000 + " " + "xé…. " * 2000),
    (9, "́ ´ é. É, ª.º, İ. ß'S"),
]


def plain_listed(rows):
    tokenizer = Tokenizer.from_file(queries.WORD_MODEL)
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is not None, rows[n][0] or 0, n))
    start, out = 0, []
    for n in order:
        ids = [*tokenizer.encode(rows[n][1] or "", add_special_tokens=False).ids, 1]
        out.append((rows[n][0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def as_listed(frame):
    return sorted(map(tuple, frame.collect()), key=lambda r: r[1])


def test_files_hold_the_library_s_ids(spark, docs):
    assert as_listed(token_files.listed(docs(ODD), queries.WORD_MODEL)) == plain_listed(ODD)
    held = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()]
    assert as_listed(queries.op12_token_files(spark, TINY)) == plain_listed(held)
    empty = token_files.listed(docs([]), queries.WORD_MODEL)
    assert empty.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and empty.count() == 0


def test_files_are_closed_at_their_size_and_strays_are_not_read(spark, docs):
    rows = [(n, f"document {n} " * (n % 50)) for n in range(400)]
    folder = fresh_dir(spark, "some-tokens")
    manifest = token_files.write_files(docs(rows), queries.WORD_MODEL, folder, file_ids=500)
    assert manifest.count() > 10 and manifest.selectExpr("sum(n_docs)").first()[0] == 400
    with open(f"{folder}/part-00000-00000-stray.dac", "wb") as stray:
        stray.write(b"of a lost task")
    assert as_listed(token_files.read_documents(manifest, "bigint")) == plain_listed(rows)


def test_encoder_forgets_words_and_still_agrees(monkeypatch):
    monkeypatch.setattr(token_files, "KEPT_WORDS", 5)
    encoder = token_files.Encoder(queries.WORD_MODEL)
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice("aBé .,'’Σ́<|\t漢1İ\u0958ªſ") for _ in range(rng.randrange(40)))
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text.encode()).tolist() == want


# the weighted draw


def plain_words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def plain_draw(rows, target, percent=10, least=20, seed=2024):
    def buckets(texts):
        return Counter(zlib.crc32(w) % 10_000 for t in texts for w in plain_words(t))

    s, t = buckets(text for _, text in rows), buckets(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log(((t[b] + 1) * (all_s + 10_000)) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)
    ]
    scored = []
    for n, (i, text) in enumerate(rows):
        words = plain_words(text)
        weight = sum(gain[zlib.crc32(w) % 10_000] for w in words)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, len(words), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    order = [r for r in scored if r[1] >= least]
    count = percent * len(order) // 100
    order.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[4]))
    ranks = {r[4]: place for place, r in enumerate(order[:count], 1)}
    return Counter((*r[:4], ranks.get(r[4])) for r in scored)


def drawn(docs, rows, target, **options):
    frame = importance.resampled(docs(rows), docs([(n, t) for n, t in enumerate(target)]), **options)
    assert frame.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return Counter(map(tuple, frame.collect()))


@pytest.mark.parametrize("percent", [0, 1, 10, 50, 100])
def test_draw_matches_a_plain_sort(docs, percent):
    rng = random.Random(percent)
    rows = [(n % 350, " ".join(f"Wort{rng.randrange(300)}" for _ in range(rng.randrange(60)))) for n in range(400)]
    rows += [(None, rows[0][1]), (None, rows[1][1]), (7, None), (8, ""), *[(900, "one two three " * 9)] * 90]
    target = ["Wort1 Wort2 wort3 é", None, ""]
    assert drawn(docs, rows, target, percent=percent) == plain_draw(rows, target, percent)


def test_draw_of_one_hot_score_and_of_small_tables(docs):
    same = [(n // 300, "same words here " * 8) for n in range(600)]
    assert drawn(docs, same, ["same"]) == plain_draw(same, ["same"])
    assert drawn(docs, [], ["a"]) == Counter()
    few = [(n, "too few " * 10) for n in range(9)]
    assert drawn(docs, few, []) == plain_draw(few, [])


def test_bracket_widens_until_it_holds_the_cutoff(docs, monkeypatch):
    monkeypatch.setattr(importance, "MARGIN", 1e-9)
    monkeypatch.setattr(importance, "SKETCH", 8)
    rows = [(n, f"w{n % 13} " * (20 + n % 17)) for n in range(900)]
    assert drawn(docs, rows, ["w1 w2"], percent=37) == plain_draw(rows, ["w1 w2"], 37)


def test_gains_of_very_long_words_and_texts(docs):
    rows = [(1, "x" * 300_000 + " " + "long text " * 60_000), (2, "a b c d e f g h i j k l m n o p q r s t u")]
    assert drawn(docs, rows, ["long"], percent=50) == plain_draw(rows, ["long"], 50)
    table = docs(rows)
    assert int(importance.bucket_counts(numbered(table)).sum()) == 120_001 + 21
