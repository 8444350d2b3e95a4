"""The text operators against plain versions and libraries, and on odd tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from playlake.llm import (
    automaton,
    decontamination,
    licenses,
    lm_scoring,
    near_dedup,
    pieces,
    quality_classifier,
    quality_rules,
    queries,
    suffix_dedup,
    terms,
    token_counts,
    url_filter,
)
from tests.conftest import TINY
from tests.llm import brute

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = ("rid", "row", "term", "n_words", "words", "kept", "kept_row", "class", "spans", "place", "ranges", "head")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    """Build documents from (doc_id, text) or texts; clashing columns come along."""

    def build(rows, clash: bool = False):
        rows = [r if isinstance(r, tuple) else (n, r) for n, r in enumerate(rows)]
        data = [(i, t, None, "s", None if t is None else len(t)) for i, t in rows]
        kind = COLUMNS
        if clash:
            data = [(*row, *("x" for _ in CLASHING)) for row in data]
            kind = ", ".join([COLUMNS, *(f"{name} string" for name in CLASHING)])
        return spark.createDataFrame(data, kind)

    return build


@pytest.fixture(scope="module")
def tiny(spark):
    return spark.read.parquet(f"{TINY}/documents.parquet")


ODD = [
    (1, None),
    (None, "a text of a row without id"),
    (2, ""),
    (2, ""),
    (3, " \n\t\r\n "),
    (4, "ein Wort\n\nein Wort\nzwei <|endoftext|> drei ▁ vier\x00 \u3000 x\u0301 İ Ǆ ﬁ 漢字 👩‍👩‍👧 ½ it's I'LL"),
    (5, "the of and to " * 3000),
    (5, "the of and to " * 3000),
    (6, "a" * 30000),
    (7, "  two  spaces  "),
    (8, "ab " * 10 + "é" * 700 + " cd"),
]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_measures(text):
    words, text = words_of(text), text or ""
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    lines = [line for line in text.split("\n") if words_of(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len({i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}),
    )


def test_quality_measures_match_a_plain_count(docs):
    rng = random.Random(1)
    random_texts = ["".join(rng.choice("ab \n#|é") for _ in range(rng.randrange(300))) for _ in range(60)]
    rows = [*ODD, *enumerate(random_texts, 100)]
    got = quality_rules.judged(docs(rows, clash=True)).collect()
    want = Counter((i, *plain_measures(t)) for i, t in rows)
    assert Counter(tuple(r)[:6] for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_rules_plan_is_native(docs):
    plan = quality_rules.judged(docs(["x"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_keep_good_returns_rows_as_they_were(docs):
    good = " ".join(f"the word{n} of thing{n}" for n in range(40))
    table = docs([(1, good), (2, "bad"), (3, None)], clash=True)
    kept = quality_rules.keep_good(table)
    assert kept.columns == table.columns and [tuple(r) for r in kept.collect()] == [tuple(table.first())]


def test_windows_match_a_plain_search():
    rng = random.Random(2)
    for _ in range(150):
        some = lambda n: [rng.choice([b"a", b"b", b"c"]) for _ in range(n)]
        items = [(str(k), some(rng.randrange(0, 9))) for k in range(rng.randrange(1, 5))]
        text = some(rng.randrange(0, 40))
        spans, found = automaton.Windows(items, 4).hits(text)
        plain = brute.hit_words(
            " ".join(w.decode() for w in text), [(k, " ".join(w.decode() for w in i)) for k, i in items], 4
        )
        assert ({p for a, b in spans for p in range(a, b)}, found) == plain
        assert all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))


@pytest.fixture
def items(spark):
    def build(rows):
        return spark.createDataFrame(rows, "item_id long, text string")

    return build


LONG_ITEM = " ".join(f"w{n}" for n in range(20))
ITEMS = [(1, LONG_ITEM), (10, "Short item, here"), (2, LONG_ITEM), (None, "null id item"), (5, None), (6, "...")]


@pytest.mark.parametrize("block_words", [200_000, 8])
def test_decontamination_matches_a_plain_search(docs, items, monkeypatch, block_words):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block_words)
    rows = [*ODD, (20, f"x {LONG_ITEM.upper()} y"), (21, "z " * 500 + LONG_ITEM), (22, "a short ITEM here null id item")]
    got = decontamination.judged(docs(rows, clash=True), items(ITEMS)).collect()
    named = [(None if k is None else str(k), t) for k, t in ITEMS]
    want = Counter()
    for key, text in rows:
        hit, found = brute.hit_words(text, named)
        ids, n = sorted(k for k in found if k), len(brute.lower_words(text))
        want[key, n, len(hit), len(ids), sha(",".join(ids)), bool(hit) and 20 * len(hit) >= n] += 1
    assert Counter(tuple(r) for r in got) == want


def test_clean_drops_contaminated_and_cuts_spans(docs, items):
    rest = "z " * 500
    table = docs([(1, rest + LONG_ITEM + "."), (2, LONG_ITEM), (3, None), (4, "fine")], clash=True)
    cleaned = decontamination.clean(table, items(ITEMS))
    assert cleaned.columns == table.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in cleaned.collect()} == {
        1: (rest + ".", len(rest) + 1), 3: (None, None), 4: ("fine", 4)
    }
    assert decontamination.clean(table, items([])).count() == 4


def test_classifier_ranks_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = [r for r in queries.op3_quality_classifier(spark, sf_dir).collect()]
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def plain_score(w, bag):
    """Gated attention of one document, passage by passage."""
    raw = [sum(w["w"] * np.tanh(w["V"].T @ h) / (1 + np.exp(-(w["U"].T @ h)))) for h in bag]
    shares = np.exp(raw) / sum(np.exp(raw))
    whole = sum(share * h for share, h in zip(shares, bag, strict=True))
    return 1 / (1 + np.exp(-(w["c"] @ whole + w["b"][0])))


def small_attention(rng):
    counts, width = np.array([3, 1, 4, 2]), 5
    w = {"V": rng.normal(size=(width, 3)), "U": rng.normal(size=(width, 3)), "w": rng.normal(size=3)}
    w |= {"c": rng.normal(size=width), "b": rng.normal(size=1)}
    return w, rng.normal(size=(counts.sum(), width)), quality_classifier._starts(counts), counts


def test_classifier_forward_matches_a_plain_version():
    w, h, starts, counts = small_attention(np.random.default_rng(1))
    got = quality_classifier._forward(w, h, starts, counts)["score"]
    want = [plain_score(w, h[a : a + n]) for a, n in zip(starts, counts, strict=True)]
    assert got == pytest.approx(want, abs=1e-12)


def test_classifier_gradient_matches_finite_differences():
    w, h, starts, counts = small_attention(np.random.default_rng(2))
    target = np.array([1.0, 0.0, 0.5, 1.0])

    def loss():
        scores = [plain_score(w, h[a : a + n]) for a, n in zip(starts, counts, strict=True)]
        logs = sum(t * math.log(s) + (1 - t) * math.log(1 - s) for s, t in zip(scores, target, strict=True))
        squares = sum((w[k] ** 2).sum() for k in "VUwc")
        return -logs / len(target) + quality_classifier.DECAY / 2 * squares

    got = quality_classifier._gradient(w, h, starts, counts, target)
    for name, values in w.items():
        for place in np.ndindex(values.shape):
            held = values[place]
            values[place] = held + 1e-5
            above = loss()
            values[place] = held - 1e-5
            below = loss()
            values[place] = held
            assert got[name][place] == pytest.approx((above - below) / 2e-5, abs=1e-8)


def test_classifier_trains_on_whole_texts_within_its_bound(spark, docs, monkeypatch):
    trained = []
    fit = quality_classifier.fit
    monkeypatch.setattr(quality_classifier, "fit", lambda v, c, t: trained.append((c.tolist(), t.tolist())) or fit(v, c, t))
    long = "plain words of a long text " * 4000  # 108,000 bytes, 210 passages
    rows = [(1, long), (1, long), (2, "short"), (3, "#" * 2000), (1, "another text of the id"), (4, None)]
    rows = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(n, n % 2) for n in range(1, 5)], "doc_id long, quality int")
    quality_classifier.scored(docs(rows), labels)
    sizes = sorted(max(1, len(t or "") // 512) for _, t in set(rows))
    assert sorted(trained[0][0]) == sizes
    monkeypatch.setattr(quality_classifier, "TRAIN_BYTES", 3000)
    quality_classifier.scored(docs(rows), labels)
    assert max(trained[1][0]) < 10 and len(trained[1][0]) == len(sizes) - (max(sizes) > 10)


def test_classifier_on_odd_tables(spark, docs):
    labels = spark.createDataFrame([(4, 1), (5, 0), (7, None), (None, 1)], "doc_id long, quality int")
    assert quality_classifier.scored(docs(ODD, clash=True), labels).count() == len(ODD)
    one = quality_classifier.scored(docs(ODD), labels.filter("doc_id < 0")).collect()
    assert {r.score for r in one} == {0.5}
    assert quality_classifier.scored(docs([]), labels).count() == 0
    vectors, counts = quality_classifier.encode([b"", b"ab" * 5_000_000])
    assert counts.tolist() == [1, 10_000_000 // 512] and len(vectors) == counts.sum()


def test_lattice_sums_all_segmentations():
    scores = {"▁": -1.0, "a": -2.0, "b": -1.5, "ab": -2.2, "▁a": -1.1, "▁ab": -3.0, "ba": -0.7}
    lattice = lm_scoring.Lattice(scores, [-9.0] * 256)

    def total(rest):
        if not rest:
            return 1.0
        ways = sum(math.exp(scores[p]) * total(rest[len(p) :]) for p in scores if rest.startswith(p))
        return ways + math.exp(-9.0 * len(rest[0].encode())) * total(rest[1:])

    for word in ("ab", "abab", "é", "bébab"):
        assert lattice.word(word) == pytest.approx(math.log10(total("▁" + word)))


@pytest.mark.parametrize("frequent", [131_072, 3])
def test_lm_scores_match_a_plain_sum(docs, tiny, monkeypatch, frequent):
    monkeypatch.setattr(terms, "FREQUENT", frequent)
    rows = [*ODD, *((r.doc_id + 100, r.text) for r in tiny.limit(40).collect())]
    got = lm_scoring.scored(docs(rows, clash=True), queries.PIECE_MODEL).collect()
    fold = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10
    tokens = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [None]
    counts = Counter(w for i, t in rows if fold(i) for w in tokens(t))
    whole, types = sum(counts.values()), len(counts)
    value = lambda w: math.log10((counts[w] + 0.1) / (whole + 0.1 * (types + 1)))
    want = Counter()
    for i, t in rows:
        held = tokens(t)
        base = round(sum(map(value, held)), 6)
        want[i, fold(i) == 0, len(held), sum(counts[w] > 0 for w in held), whole, base] += 1
    assert Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_lm_on_empty_table(docs):
    assert lm_scoring.scored(docs([]), queries.PIECE_MODEL).count() == 0


def test_digest_array_confirms_strings():
    entries = sorted((hash_, name) for hash_, name in [(5, b"a"), (7, b"b"), (7, b"c")])
    array = url_filter.DigestArray(np.array([k for k, _ in entries], np.uint64).tobytes(), [s for _, s in entries])
    array_of = lambda *values: iter(values)
    digests = array_of(7, 7, 5, 9)
    real, url_filter.xxhash.xxh64_intdigest = url_filter.xxhash.xxh64_intdigest, lambda *_: next(digests)
    try:
        assert array.holds([b"c", b"x", b"a", b"a"]).tolist() == [True, False, True, False]
    finally:
        url_filter.xxhash.xxh64_intdigest = real
    assert url_filter.DigestArray(b"", []).holds([b"a"]).tolist() == [False]


@pytest.mark.parametrize("block", [1_000_000, 1])
def test_url_rules_and_list(spark, monkeypatch, block):
    monkeypatch.setattr(url_filter, "BLOCK", block)
    cases = [
        ("https://www.Example.com/en/1?x", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
        ("http://example.com/fr/", "example.com", "/fr/", "com/", "allow"),
        ("http://x.net/es/q#f", "x.net", "/es/q", "net/es/", "block"),
        ("http://x.net", "x.net", "", None, "allow"),
        ("http://example.com", "example.com", "", None, "allow"),
        ("http://Blog.spam-farm.example.org/a", "blog.spam-farm.example.org", "/a", None, "block"),
        ("http://sub.casino-win.example.net/a\nb", "sub.casino-win.example.net", "/a\nb", None, "block"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ]
    rows = [(n, c[0], "h", "x") for n, c in enumerate(cases)] + [(None, cases[0][0], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = url_filter.judged(pages, url_filter.unwanted_hosts(pages)).drop("listed").collect()
    assert sorted((tuple(r) for r in got if r.page_id is not None)) == [(n, *c[1:]) for n, c in enumerate(cases)]
    assert len(got) == len(rows)
    none = pages.limit(0)
    assert url_filter.judged(none, url_filter.unwanted_hosts(none)).count() == 0


def repeated_texts():
    rng = random.Random(4)
    some = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared, long = some(500), some(1500)
    return [
        some(300) + shared + some(300),
        shared[:399] + some(200),
        some(50) + shared,
        some(10) + long + some(20) + long[200:1000],
        long[100:900],
        "xy" * 600,
        "z" * 401,
        "q" * 400,
        some(399),
        some(2000),
        *[some(30) + long[:700] + some(30) for _ in range(4)],
    ]


@pytest.mark.parametrize("strings", [suffix_dedup.WHOLE, suffix_dedup.PASSAGES])
@pytest.mark.parametrize(("near", "hot"), [(2000, 2000), (0, 2000), (0, 1), (3, 1)])
def test_suffix_dedup_matches_a_plain_search(docs, monkeypatch, near, hot, strings):
    monkeypatch.setattr(suffix_dedup, "NEAR", near)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    texts = repeated_texts()
    rows = [*ODD, *enumerate(texts, 100), (100, texts[9])]
    data = [(t or "").encode() for _, t in rows]
    want = Counter()
    for (key, _), text, gone in zip(rows, data, brute.removed_bytes(data, strings.length), strict=True):
        kept = bytes(b for i, b in enumerate(text) if i not in gone)
        want[key, len(text), len(gone), sum(i - 1 not in gone for i in gone), sha(kept)] += 1
    assert Counter(tuple(r) for r in suffix_dedup.judged(docs(rows, clash=True), strings).collect()) == want


def test_wide_cores_make_two_rows_for_a_segment(docs, monkeypatch):
    # Segments of cores that are not brought together are cut in two at a time, not in all classes at once.
    counts = []

    def watched(frame, name):
        kept = stored(frame, name)
        counts.append((name, kept.count()))
        return kept

    stored = suffix_dedup.stored
    monkeypatch.setattr(suffix_dedup, "stored", watched)
    monkeypatch.setattr(suffix_dedup, "NEAR", 0)
    rng = random.Random(9)
    some = lambda n: "".join(rng.choices("abcdefgh", k=n))
    common = some(350)
    suffix_dedup.judged(docs([some(200) + common + some(200) for _ in range(30)])).collect()
    cuts = [n for name, n in counts if name == "suffix-cut"]
    narrow = [n for name, n in counts if name == "suffix-narrow"]
    assert cuts[0] and narrow and all(n <= 2 * cuts[0] for n in narrow)


def test_strings_need_classes():
    with pytest.raises(ValueError):
        suffix_dedup.Strings(length=240, k=33, fine=7)
    with pytest.raises(ValueError):
        suffix_dedup.Strings(length=240, k=20, fine=8)


def test_interval_expansion_matches_a_plain_search():
    rng = random.Random(5)
    for _ in range(100):
        parts = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(1, 60))) for _ in range(rng.randrange(1, 6))]
        seen = Counter(p[i : i + 5] for p in parts for i in range(len(p) - 4))
        want, begin = [], 0
        for p in parts:
            want += [begin + i for i in range(len(p) - 4) if seen[p[i : i + 5]] > 1]
            begin += len(p) + 1
        symbols = [x for p in parts for x in [*(b + 1 for b in p), 0]]
        assert suffix_dedup.repeated_starts(np.array(symbols, np.int32), 5).tolist() == want


def test_without_repeats_keeps_rows_and_whole_characters(docs):
    texts = ["a" + "é" * 300 + "b", "c" + "é" * 300, None, "fine"]
    table = docs(texts, clash=True)
    got = suffix_dedup.without_repeats(table)
    assert got.columns == table.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == {
        0: ("ab", 2), 1: ("c", 1), 2: ("", 0), 3: ("fine", 4)
    }
    assert suffix_dedup.judged(docs([])).count() == 0


@pytest.mark.parametrize("frequent", [131_072, 3])
def test_token_counts_match_the_library(docs, tiny, monkeypatch, frequent):
    monkeypatch.setattr(terms, "FREQUENT", frequent)
    odd = ["<|startoftext|>a<|endoftext|>", "x<|endoftext|>'s", "J\u030c j\u030c ǅ ß ẞ Σας 1½²x a\x85b\xa0c \x1c\x1f", "can't I'M"]
    rows = [*ODD, *enumerate(odd, 20), *((r.doc_id + 100, r.text) for r in tiny.collect())]
    library = Tokenizer.from_file(queries.WORD_MODEL)
    want = Counter()
    for key, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want[key, len((text or "").encode()), n, n > 2048] += 1
    assert Counter(tuple(r) for r in token_counts.counted(docs(rows, clash=True), queries.WORD_MODEL).collect()) == want


def test_token_counts_of_random_characters():
    cutter, rng = token_counts.PreTokens(queries.WORD_MODEL), random.Random(6)
    pools = [range(0x20, 0x250), range(0x250, 0x3100), [*range(0x300, 0x370), *range(65, 90)], range(0x1F300, 0x1FA00)]
    for _ in range(2000):
        pool = rng.choice(pools)
        text = "".join(chr(rng.choice(pool)) if rng.random() < 0.8 else rng.choice(" \n\ta'S9") for _ in range(12))
        found, extra = cutter.cut(text)
        assert sum(map(cutter.pieces, found)) + extra == len(cutter.tokenizer.encode(text).ids), repr(text)


def test_token_counts_on_empty_table(docs):
    assert token_counts.counted(docs([]), queries.WORD_MODEL).count() == 0


def test_pieces_match_the_library(docs, tiny):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    odd = ["▁a ▁ b▁", "a  b   c ", " lead", "<s> x </s> <unk> <0x41>", "a\u00a0b\u2028c", "\ud7ff\ufffd", "tab\tnew\nline "]
    rows = [*ODD, *enumerate(odd, 20), *((r.doc_id + 100, r.text) for r in tiny.collect())]
    want = Counter()
    for key, text in rows:
        ids = library.encode(text or "")
        decoded = library.decode(ids) if ids else ""
        want[key, len(ids), sha(",".join(map(str, ids))), sha(decoded), len((text or "").encode())] += 1
    assert Counter(tuple(r) for r in pieces.digested(docs(rows, clash=True), queries.PIECE_MODEL).collect()) == want
    for r in pieces.encoded(docs(rows), queries.PIECE_MODEL).collect():
        assert r.ends == sorted(r.ends)
    assert pieces.digested(docs([]), queries.PIECE_MODEL).count() == 0


def test_piece_spans_cut_the_text():
    codec = pieces.Codec(queries.PIECE_MODEL)
    text = "  Ein Haus, zwei  Häuser\n漢 end "
    [(ids, ends)] = list(codec.encode([text.encode()]))
    starts = [0, *ends[:-1]]
    whole = b"".join(text.encode()[a:b] for a, b in zip(starts, ends, strict=True))
    assert whole == text.encode()
    for piece, a, b in zip(ids, starts, ends, strict=True):
        if not codec.library.is_byte(piece):
            surface = codec.library.id_to_piece(piece).replace("▁", " ")
            assert text.encode()[a:b].decode() in (surface, surface[1:])


def test_pieces_take_no_call_for_each_chunk():
    # Encoding a batch costs Python calls by its texts, not by the distinct chunks in them.
    codec = pieces.Codec(queries.PIECE_MODEL)
    texts = [" ".join(f"w{n}x{k}" for k in range(500)).encode() for n in range(10)]
    calls = Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        found = list(codec.encode(texts))
    finally:
        sys.setprofile(None)
    assert [ids for ids, _ in found] == codec.library.encode([t.decode() for t in texts])
    assert calls["call"] < 2500, calls  # of 5,000 chunks; collected objects of other tests may add some


def test_pieces_are_the_same_from_small_tables(monkeypatch):
    # Tables that are full after every batch, chunks taken over from the older one, long chunks and marks.
    monkeypatch.setattr(pieces, "KEPT_CHUNKS", 3)
    codec = pieces.Codec(queries.PIECE_MODEL)
    batches = [["a b c d e", "y" * 70 + " a", ""], ["a  z ", "▁a b"], [" a b " + "y" * 70, "q", "é 漢"], ["z", "  "], [], ["b"]]
    for batch in batches:
        found = list(codec.encode([t.encode() for t in batch]))
        assert [ids for ids, _ in found] == [codec.library.encode(t) for t in batch]
        for text, (ids, ends) in zip(batch, found, strict=True):
            assert ends == codec._spans(ids, codec.normalizer.run(text.encode())[1])


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc_cf"])
def test_normalizer_matches_the_library(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    proto = pieces.sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    spec = proto.normalizer_spec
    own = pieces.Normalizer(
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
    )
    assert own.map
    for text in ("ﬁne Ⅷ  ｶﾞ ① ", "  ÄÖ\u00a0Å K", "", "  ", "½ of ㍿", "e\u0301\u0327"):
        done, source = own.run(text.encode())
        assert done.decode() == library.normalize(text)
        assert len(source) == len(done) + 1 and source == sorted(source)


def test_licenses_match_a_plain_search(docs):
    full = dict(licenses.TEMPLATES[:1])["mit"]
    bsd = next(t for n, t in licenses.TEMPLATES if n == "bsd")
    rows = [
        *ODD,
        (20, "MIT license, Apache-License mit LICENSE cc by cc by-nc"),
        (21, "gnu general gnu general public license license"),
        (22, "x " * 50 + full + " y" * 50),
        (23, " ".join(bsd.split()[:45])),
        (24, " ".join(bsd.split()[:10])),
        (25, bsd.replace("binary forms", "BINARY or other forms") + full),
    ]
    got = {(r.doc_id, r.n_words): r for r in licenses.judged(docs(rows, clash=True)).collect()}
    for key, text in rows:
        words, places, labels = brute.lower_words(text), [], set()
        for phrase, label in licenses.PHRASES.items():
            held = phrase.encode().split()
            found = [i for i in range(len(words)) if words[i : i + len(held)] == held]
            places += found
            labels |= {label} if found else set()
        r = got[key, len(words)]
        assert (r.n_base, r.first_word, r.last_word) == (
            len(places), min(places, default=None), max(places, default=None)
        )
        assert r.base_labels == ",".join(sorted(labels)) and labels <= set(r.labels.split(","))| set()
        assert 0 <= r.score <= 1
    label = lambda key: next(r.labels for (k, _), r in got.items() if k == key)
    assert [label(k) for k in (22, 23, 24, 25)] == ["mit", "bsd", "", "bsd,mit"]
    assert licenses.judged(docs([])).count() == 0


def near_texts():
    rng = random.Random(7)
    some = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    base, other = some(120), some(80)
    texts = [" ".join(base), " ".join(base).upper() + "!", " ".join(other)]
    for edits in (1, 1, 2, 2, 3, 4, 8):
        copy = list(base)
        for _ in range(edits):
            copy[rng.randrange(len(copy))] = "edited"
        texts.append(" ".join(copy))
    line = " ".join(some(12))
    texts += [" ".join([line] * 30), " ".join([line] * 28), " ".join([line] * 15), "one two", "One, two.", "one three"]
    return texts


@pytest.mark.parametrize(("block", "turns"), [(1024, (16,)), (2, (4, 64)), (3, (1,))])
def test_near_classes_match_all_pairs(docs, monkeypatch, block, turns):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "TURNS", turns)
    rows = [*ODD, *enumerate(near_texts(), 100)]
    texts = [t for _, t in rows]
    got = sorted(near_dedup.classes(docs(rows, clash=True)).collect())
    order = {r.rid: n for n, r in enumerate(got)}
    assert [order[r["class"]] for r in got] == brute.near_classes(texts)


def test_near_classes_match_all_pairs_of_documents(tiny, spark):
    # A pair misses a band with a chance of 3e-6 at the least similarity, so all are found.
    rows = tiny.select("doc_id", "text").collect()
    classes = brute.near_classes([r.text for r in rows])
    got = {r.doc_id: r for r in near_dedup.grouped(tiny).collect()}
    for n, row in enumerate(rows):
        members = [rows[k].doc_id for k, c in enumerate(classes) if c == classes[n]]
        found = got[row.doc_id]
        assert (found.class_id, found.class_size) == (min(members), len(members))
    assert sum(r.kept for r in got.values()) == len(set(classes))


def test_bagminhash_estimates_weighted_jaccard():
    rng = random.Random(8)
    agree, exact = [], []
    for _ in range(60):
        lines = [" ".join(f"x{rng.randrange(10**6)}" for _ in range(8)) for _ in range(6)]
        a = " ".join(line for line in lines for _ in range(rng.randrange(6)))
        b = " ".join(line for line in lines for _ in range(rng.randrange(6)))
        first, second = near_dedup.signatures(2, *near_dedup.shingles([a.encode(), b.encode()]))
        agree.append(np.mean(first == second))
        exact.append(brute.similarity(brute.shingle_counts(a), brute.shingle_counts(b)))
    assert abs(np.mean(agree) - np.mean(exact)) < 0.03
    assert np.corrcoef(agree, exact)[0, 1] > 0.9


def test_keep_first_returns_rows_as_they_were(docs):
    table = docs([(3, "a b c d e f"), (1, "A b c d e f"), (2, "other words"), (2, None), (9, "")], clash=True)
    kept = near_dedup.keep_first(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 2, 3]
    assert near_dedup.grouped(docs([])).count() == 0


def test_pipeline_stages_match_plain_versions(spark, tmp_path):
    source = spark.read.parquet(f"{TINY}/documents.parquet")
    docs, columns, found = source, source.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name.replace(" ", "-"))
        stage(spark, docs, TINY).write.parquet(path)
        docs = spark.read.parquet(path)
        found[name] = docs
        if name != "sentencepiece":
            assert docs.columns == columns
    listed = lambda name: {r.doc_id: r.text for r in found[name].collect()}
    judged = {r.doc_id for r in quality_rules.judged(source).collect() if r.kept}
    good = listed("quality rules")
    assert set(good) == judged
    order = found["quality rules"].select("doc_id", "text").collect()
    first = brute.near_classes([r.text for r in order])
    single = listed("near-dedup")
    assert len(single) == len(set(first))
    keys = list(single)
    gone = brute.removed_bytes([single[k].encode() for k in keys], suffix_dedup.PASSAGES.length)
    short = {
        k: bytes(b for i, b in enumerate(single[k].encode()) if i not in g).decode("utf-8", "ignore")
        for k, g in zip(keys, gone, strict=True)
    }
    assert listed("suffix-array dedup") == short
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    clean = listed("decontamination")
    for key, text in short.items():
        hit, _ = brute.hit_words(text, items)
        assert (key in clean) == (not hit or 20 * len(hit) < len(brute.lower_words(text)))
        if not hit:
            assert clean[key] == text
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    for r in found["sentencepiece"].collect():
        assert list(r.ids) == library.encode(clean[r.doc_id])
    assert corpus_pipeline.run(spark, TINY).count() == len(clean)


def test_last_stage_digests_ids_and_decoded_text(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = corpus_pipeline.piece_ids(spark, docs, TINY).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id])
        assert (list(r.ids), r.n_tokens, r.ends[-1]) == (ids, len(ids), len(texts[r.doc_id].encode()))
        assert r.ids_sha256 == sha(",".join(map(str, ids)))
        assert r.decoded_sha256 == sha(library.decode(ids))


def test_last_stage_on_odd_rows(docs):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    want = Counter()
    for key, text in ODD:
        ids = library.encode(text or "")
        want[key, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids) if ids else "")] += 1
    got = pieces.encoded(docs(ODD, clash=True), queries.PIECE_MODEL)
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()) == want
    assert pieces.encoded(docs([]), queries.PIECE_MODEL).count() == 0


def test_query_columns_come_from_each_piece_span(docs, monkeypatch):
    # The query's covered bytes end where its last projected piece does, with runs of spaces and bytes alone too.
    texts = ["a  b 漢", "   👩 x", "▁a 漢", "é" * 100 + " z", " ", "", None]
    codec = pieces.Codec(queries.PIECE_MODEL)
    spans = [ends for _, ends in codec.encode([(t or "").encode() for t in texts])]
    got = {r.doc_id: r.n_covered for r in pieces.digested(docs(texts), queries.PIECE_MODEL).collect()}
    assert got == {n: ends[-1] if ends else 0 for n, ends in enumerate(spans)}
    for text, (ids, ends) in zip(texts, codec.encode([(t or "").encode() for t in texts]), strict=True):
        source = codec.normalizer.run((text or "").encode())[1]
        assert ends == codec._spans(ids, source)
        starts = [0, *ends][:-1]
        assert all(b - a == 1 for k, a, b in zip(ids, starts, ends, strict=True) if codec.library.is_byte(k))


def likely_pairs(weights, first=0, last=None, now=None, bands=None, key=1):
    """Pairs of texts of one repeated shingle each, by their numbers of it."""
    count = len(weights)
    cells = near_dedup._cells(np.arange(count), np.full(count, 7, np.uint64), np.array(weights), count)
    columns = {
        "key": [key] * count, "left": [0] * count, "right": [0] * count, "block": [0] * count, "rid": list(range(count)),
        "before": list(range(count)), "class": now or list(range(count)), "size": list(weights), "cells": cells,
        "bands": bands or [[1, n + 5] for n in range(count)],
    }
    [found] = near_dedup._likely_pairs(first, last, [pa.RecordBatch.from_pydict(columns)])
    return list(zip(*(found.column(c).to_pylist() for c in "ab"), strict=True))


def test_coarse_counts_keep_pairs_of_very_long_texts():
    # Each has more in its cell than a count holds; only the sizes bound such pairs.
    assert likely_pairs([19_000_000, 19_000_000, 16_000_000, 10_000_000]) == [(0, 1), (0, 2), (1, 2)]
    assert likely_pairs([60_000, 50_000, 40_000]) == [(0, 1), (1, 2)]


def test_turns_take_every_pair_once_and_skip_what_has_met():
    every = likely_pairs([100] * 9)
    assert len(every) == 36
    first = likely_pairs([100] * 9, 0, 2)
    assert first[-1] == (-1, -1) and max(Counter(a for a, _ in first).values()) == 2
    rest = likely_pairs([100] * 9, 2, None)
    assert sorted([*first[:-1], *rest]) == every
    assert likely_pairs([100] * 9, 2, None, now=[0] * 9) == [] == likely_pairs([100] * 9, 0, 2, now=[0] * 9)
    apart = likely_pairs([100] * 9, 2, 4, now=[0] * 8 + [8])
    assert apart[-1] == (-1, -1) and {b for _, b in apart[:-1]} == {8}
    # A pair is a matter of the first band it shares.
    shared = [[3, 1], [3, 1], [4, 1]]
    assert likely_pairs([100] * 3, bands=shared) == [(0, 2), (1, 2)]
    assert likely_pairs([100] * 2, bands=shared[:2], key=3) == [(0, 1)]


def test_links_of_one_bucket_of_many_texts_stay_few(docs, monkeypatch):
    # Copies of one text, each with an edit of its own: likely pairs of all with all.
    made = []
    verified = near_dedup._verified
    monkeypatch.setattr(near_dedup, "_verified", lambda pairs, held: made.append(pairs.count()) or verified(pairs, held))
    rng = random.Random(3)
    base = [f"w{n}" for n in range(200)]
    rows = []
    for n in range(400):
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(200)] = f"e{rng.randrange(10**6)}"
        rows.append((n, " ".join(copy)))
    table = docs(rows)
    got = near_dedup.grouped(table).collect()
    want = brute.near_classes([t for _, t in rows])
    sizes = Counter(want)
    assert sorted(r.class_size for r in got) == sorted(sizes[c] for c in want)
    assert sum(made) < 30 * len(rows)


def test_stored_steps_are_written_as_zstd(spark):
    from playlake.llm.rows import stored

    assert all(name.endswith(".zstd.parquet") for name in stored(spark.range(3), "codec").inputFiles())
