"""Language identification, token alignment, embedding whitening: brute force, held-out accuracy, adverse rows."""

import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import ADVERSE, LONG, frame  # noqa: F401
from tokenizers import Tokenizer

from tarmac.llm import embedding_whitening as ew
from tarmac.llm import language_id as li
from tarmac.llm import queries
from tarmac.llm import token_alignment as ta

# ------------------------------------------------------- language identification

SYLLABLES = {
    "aa": ["ka", "lo", "mi", "tu", "re"],
    "bb": ["sch", "tz", "ung", "kei", "ß"],
    "cc": ["漢", "字", "語", "文", "本"],
}


def prose(lang, rng, words=40):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(words)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    return [(i, prose(lang, rng), lang) for i in range(300) for lang in [rng.choice(sorted(SYLLABLES))]]


def as_rows(spark, rows):
    return spark.createDataFrame([(d, t, lang, None, None) for d, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def learned(spark, corpus):
    return li.train(as_rows(spark, [r for r in corpus if r[0] % 3]))


def test_held_out_languages(spark, corpus, learned):
    found = {r.doc_id: r for r in li.identify(as_rows(spark, corpus), learned).select("_row.*", "lang_pred", "score", "rejected").collect()}
    held = [r for r in corpus if r[0] % 3 == 0]
    assert np.mean([found[d].lang_pred == lang for d, _, lang in held]) > 0.97
    assert all(0 < found[d].score <= 1 for d, _, _ in corpus)
    assert learned.languages == sorted(SYLLABLES)


def test_predictions_ignore_everything_but_the_text(spark, corpus, learned):
    swapped = [(d + 1000, t, "zz") for d, t, _ in corpus[:50]]
    first = [r[0] for r in li.identify(as_rows(spark, corpus[:50]).coalesce(1), learned).select("score").collect()]
    assert [r[0] for r in li.identify(as_rows(spark, swapped).coalesce(1), learned).select("score").collect()] == first


def test_language_adverse_rows(spark, frame, learned):
    more = [(20, "12 + 34 = ?!"), (21, "́̂"), (22, "kalomi" * 30_000), (23, LONG)]
    rows = li.identify(frame(ADVERSE + more, clashing=True), learned).select("_row.*", "lang_pred", li.F.col("score").alias("p"), "rejected").collect()
    assert len(rows) == len(ADVERSE) + len(more)
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and (r.p == 0) == (not lettered)
        assert lettered or r.rejected
    assert {r.lang_pred for r in rows if r.doc_id == 22} == {"aa"}
    assert li.identify(frame([]), learned).count() == 0


def test_no_labels_and_one_label(spark, frame):
    none = li.train(as_rows(spark, [(1, "kalo", None), (2, "schtz", None)]))
    assert none is None
    assert {tuple(r) for r in li.identify(frame([(1, "kalo"), (2, None)]), none).select("lang_pred", "score").collect()} == {("und", 0.0)}
    one = li.train(as_rows(spark, [(1, "kalo", "aa"), (1, "kalo", "aa"), (None, None, "aa"), (2, "", "aa")]))
    assert [r[0] for r in li.identify(frame([(1, "schtz")]), one).select("lang_pred").collect()] == ["aa"]


def plain_features(text):
    """Word by word, gram by gram: the features themselves instead of buckets."""
    found, word = [], ""
    for c in text + " ":
        if c.isalpha() or (ord(c) > 127 and __import__("unicodedata").category(c)[0] == "M"):
            word += c
            continue
        if any(x.isalpha() for x in word):
            marked = f"<{word}>"
            found.append(("word", marked))
            found += [(n, marked[i : i + n]) for n in li.NGRAMS for i in range(len(marked) - n + 1)]
        word = ""
    return found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abÄß漢́ .1\n", max_size=12), max_size=6))
def test_subwords_match_plain_code(texts):
    buckets, owner = li.subword_buckets(texts)
    assert owner.tolist() == sorted(owner.tolist())
    table = {}
    for number, text in enumerate(texts):
        own, plain = Counter(buckets[owner == number].tolist()), Counter(plain_features(text))
        assert sum(own.values()) == sum(plain.values())
        for feature in plain:  # equal features share a bucket wherever they occur
            alone, _ = li.subword_buckets([feature[1][1:-1]]) if feature[0] == "word" else ([None], None)
            if feature[0] == "word":
                assert table.setdefault(feature, alone[0]) == alone[0] and alone[0] in own


def test_embedding_gradient_direction_and_calibration():
    """One step moves the mean by rate times the softmax gradient; the temperature has the least log loss."""
    rng = np.random.default_rng(0)
    documents = [(k % 2, np.array([k % 2, 2, 3]), np.array([0.5, 0.25, 0.25])) for k in range(40)]
    e, w, b = li.train_embeddings(documents, 2, epochs=20)
    right = [li.softmax(w @ (s @ e[f]) + b).argmax() == k for k, f, s in documents]
    assert all(right)
    logits, labels = rng.standard_normal((400, 3)) * 3, rng.integers(0, 3, 400)
    logits[np.arange(400), labels] += 2
    best = li.fitted_temperature(logits, labels)
    loss = lambda t: -np.log(li.softmax(logits, t)[np.arange(400), labels]).sum()
    assert loss(best) <= min(loss(best * 1.1), loss(best / 1.1))


def test_rejection_score_matches_brute_force():
    rng = random.Random(1)
    for _ in range(50):
        scores = np.array([rng.randrange(8) / 8 for _ in range(30)])
        right = np.array([rng.random() < 0.5 + s / 2 for s in scores])
        allowed = [s for s in set(scores.tolist()) if right[scores >= s].mean() >= 0.8]
        assert li.rejection_score(scores, right, 0.8) == min(allowed, default=1.0)


def test_sample_is_bounded_per_language(spark):
    rows = [(7, "same text", "aa")] * 500 + [(i, f"ka {i}", "bb") for i in range(60)] + [(i, "lo", None) for i in range(40)]
    labelled = as_rows(spark, rows).selectExpr("lang AS label", "string(doc_id) AS id", "text").where("label IS NOT NULL")
    found = li.sampled(labelled, sample=40).collect()
    assert Counter(r.label for r in found) == {"aa": 20, "bb": 20}
    assert Counter(r.label for r in li.sampled(labelled, sample=40, languages=1).collect()) == {"aa": 40}


# ------------------------------------------------------------------ token alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    with open(A, encoding="utf-8") as f:
        names = {v: k for k, v in json.load(f)["model"]["vocab"].items()}
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    value = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def expected(text):
        """(a ids, b ids, groups, links) by comparing all byte ranges."""
        if not text:
            return [], [], [], []
        full = (" " + text).encode()
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = (
            [bytes(value[c] for c in names[k]) for k in ids[0]],
            [bytes([int(b.id_to_piece(k)[3:-1], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in ids[1]],
        )
        if b"".join(raw[0]) != full or b"".join(raw[1]) != full:
            return [], [], [], []
        ranges = [[(sum(map(len, r[:k])), sum(map(len, r[: k + 1]))) for k in range(len(r))] for r in raw]
        groups, start = [], 0
        for cut in sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]}):
            groups.append("|".join(",".join(str(k) for k, (s, e) in zip(i, r) if start < e <= cut) for i, r in zip(ids, ranges)))
            start = cut
        found = [(x, y) for x, (s, e) in zip(ids[0], ranges[0]) for y, (u, v) in zip(ids[1], ranges[1]) if max(s, u) < min(e, v)]
        return *ids, groups, found

    return expected


def documents_for_alignment():
    rng = random.Random(9)
    parts = ["a", "the", "\n", " ", "  ", "é", "漢字", "🙂", ",", "'s", "\t", "12", "word", "\r", "_", "-", " but", " Cat.", "x\n", "\u0085", " ", "ﬁ", "<s>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    texts += [" ".join(rng.choice(["alpha", "Beta,", "gamma.", "épsilon", "ononedth"]) for _ in range(150)) for _ in range(6)]
    texts += ["x" * 900, "<|endoftext|> is text", "a ▁ b", "\nstarts", " starts", "ends ", "ends\n", "don't we'll", "\x00 z", *texts[:3]]
    return [(d, t) for d, t in enumerate(texts)] + ADVERSE[:-6]


@pytest.mark.parametrize(("size", "frequent"), [(1 << 15, 1 << 17), (40, 25), (7, 0)])
def test_alignment_matches_brute_force(frame, library, size, frequent):
    """Groups, links and corpus-wide counts, with very long texts in ranges and pairs looked up or joined."""
    pairs = documents_for_alignment()
    rows = ta.align(frame(pairs, clashing=True), A, B, range_chars=size, frequent=frequent).collect()
    texts = Counter(t for _, t in pairs)
    known = {t: library(t or "") for t in texts}
    totals = Counter()
    for t, n in texts.items():
        for link in known[t][3]:
            totals[link] += n
    best = Counter()
    for (x, y), n in totals.items():
        best[y] = max(best[y], n)
    expected = Counter()
    for d, t in pairs:
        a, b, groups, found = known[t]
        expected[d, len(a), len(b), len(groups), len(found), sum(totals[x] == best[x[1]] for x in found), sum(totals[x] for x in found), ";".join(groups)] += 1
    assert Counter((r._row.doc_id, *r[1:]) for r in rows) == expected


def test_alignment_query_digests_and_empty_table(spark, frame, library, tmp_path):
    pairs = [(1, "One two, three."), (2, None), (3, "a ▁ b"), (3, LONG[:5000])]
    frame(pairs).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op12_token_alignment(spark, str(tmp_path)).collect()
    assert rows[0].__fields__ == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for r in rows:
        t = next(t for d, t in pairs if d == r.doc_id and (d != 3 or bool(r.n_a) == (t[0] != "a")))
        groups = library(t or "")[2]
        assert r.groups_sha256 == (hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
    assert ta.align(frame([]), A, B).count() == 0


@pytest.fixture(scope="module")
def own():
    return ta.Aligner(A, B, cache_entries=50)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \né漢.", max_size=60), st.lists(st.integers(1, 200), min_size=3, max_size=3))
def test_composition_is_associative(own, text, cuts):
    found = own.tokens(" " + text) if text else None
    if found is None:
        return
    whole = own.finished(own.fragment(*found))
    bounds = [0, *sorted(cuts), 10_000]
    parts = []
    for low, high in zip(bounds, bounds[1:]):
        part, starts = [], []
        for ids, table in zip(found, (own.a_bytes, own.b_bytes)):
            ends = np.cumsum([len(table[k]) for k in ids])
            s, e = np.searchsorted(ends, [low, high], "right")
            part.append(ids[s:e])
            starts.append(int(ends[s - 1]) if s else 0)
        parts.append(own.fragment(*part, *starts))
    p, q, r, s = parts
    ways = [
        own.compose(own.compose(own.compose(p, q), r), s), own.compose(p, own.compose(q, own.compose(r, s))),
        own.compose(own.compose(p, q), own.compose(r, s)),
    ]
    for way in ways:
        done = own.finished(way)
        assert done.groups == whole.groups and sorted(done.pairs) == sorted(whole.pairs)


def test_ranges_of_a_long_text_are_tasks_of_their_own(frame, monkeypatch):
    """The fragments of one very long text are computed after a shuffle by its ranges."""
    seen = []
    real = ta._fragments
    monkeypatch.setattr(ta, "_fragments", lambda ranges, *paths: seen.append(ranges) or real(ranges, *paths))
    ta.align(frame([(1, LONG), (2, "short")]), A, B, range_chars=2000)
    counts = seen[0].groupBy(ta.F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in counts) > 100 and len(counts) > 4
    assert all(len(r._own) < 2000 + 4 * ta.CONTEXT_CHARS for r in seen[0].collect())


# ------------------------------------------------------------- embedding whitening


def vectors(spark, rows, extra=""):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>" + extra).repartition(3)


def plain_scatter(x):
    rows = [[int(v) for v in r] for r in x]
    d = len(rows[0])
    return [sum(r[i] for r in rows) for i in range(d)], [[sum(r[i] * r[j] for r in rows) for j in range(d)] for i in range(d)]


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 4), st.lists(st.lists(st.integers(-(1 << 62), 1 << 62) | st.integers(-70, 70), min_size=4, max_size=4), min_size=1, max_size=150))
def test_bit_sliced_scatter_is_exact(dims, rows):
    x = np.array(rows, np.int64)[:, :dims]
    sums, cross = ew.block_scatter(x)
    expected = plain_scatter(x)
    assert sums.tolist() == expected[0] and cross.tolist() == expected[1]


def test_scatter_over_partitions_and_blocks(spark):
    rng = np.random.default_rng(1)
    values = rng.standard_normal((700, 6)).astype(np.float32).astype(float)
    df = vectors(spark, [(i, v.tolist()) for i, v in enumerate(values)])
    n, sums, cross = ew.scatter(df.select("embedding"), 6, block=97)
    assert n == 700 and (sums, cross.tolist()) == plain_scatter(ew.integers(values))


def test_whitening_matches_plain_arithmetic(spark):
    rng = np.random.default_rng(2)
    mix = rng.standard_normal((5, 5))
    values = rng.standard_normal((400, 5)) @ mix
    df = vectors(spark, [(i % 390, v.tolist()) for i, v in enumerate(values)])
    model = ew.fit(df)
    x = np.floor(64 * values) + 1_000_000
    covariance = np.cov(x.T, bias=True)
    e = np.sort(np.linalg.eigvalsh(covariance))[::-1]
    assert model.eigenvalues == pytest.approx(e, rel=1e-9) and model.explained == pytest.approx(e / np.trace(covariance), rel=1e-9)
    assert np.abs(model.components @ covariance @ model.components.T - np.diag(e)).max() < 1e-8 * e[0]
    found = ew.transform(df, model)
    rows = found.select("_row.*", "deviation", "whitened").collect()
    n, s = len(x), x.sum(axis=0)
    of = {tuple(v): k for k, v in enumerate(values.tolist())}
    for r in rows:
        k = of[tuple(r.embedding)]
        assert int(r.deviation) == sum(int(n * a - b) ** 2 for a, b in zip(x[k], s))
        assert r.whitened == pytest.approx((x[k] - s / n) @ model.components.T / np.sqrt(e), abs=1e-7)
    assert len(rows) == 400 and ew.identity_error(found, 5) < 1e-9


def test_whitening_adverse_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [1.5, -1.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [1.0, 2.0, 3.0]), (8, [0.0, 0.0]), (9, [1e300, -1e300])]
    clash = ", _row string, whitened string, deviation long, i int"
    df = vectors(spark, [(*r, "row", "w", 5, 2) for r in rows], clash)
    model = ew.fit(df)
    found = ew.transform(df, model).select("_row.vec_id", "whitened").collect()
    assert sorted(str(r.vec_id) for r in found) == ["1", "1", "8", "9", "None"] and model.rows == 5
    for few in ([], rows[:2], [rows[0]], [rows[3]]):
        df = vectors(spark, few)
        model = ew.fit(df)
        assert len(model.eigenvalues) == 0 and model.rows == sum(1 for r in few if r[1])
        assert all(r.whitened == [] for r in ew.transform(df, model).collect())


def test_whitening_query(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(40).tolist()) for i in range(120)] + [(500, None)]
    vectors(spark, rows, "").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op13_embedding_whitening(spark, str(tmp_path)).collect()
    assert Counter(r.component for r in found) == {k: 120 for k in range(1, 33)}
    assert {r.n for r in found} == {120} and len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-4
    by = {r.component: r.explained for r in found}
    assert all(by[k] >= by[k + 1] > 0 for k in range(1, 32))


def test_language_query_learns_only_from_its_folds(spark, corpus, tmp_path):
    rows = [(d, t, None if d % 17 == 0 else lang) for d, t, lang in corpus]
    as_rows(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_language_id(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    lang = {d: v for d, _, v in corpus}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in found if r.held_out]) > 0.97
