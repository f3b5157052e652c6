"""SentencePiece scan, vector forest, sharding, packing, revisits, pipeline."""

import bisect
import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm_fixtures import ADVERSE, frame  # noqa: F401
from tarmac.llm import encoders, packing, queries, sentencepiece_scan, sharding, vector_forest, warc_revisits
from tarmac.llm.common import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


# ----------------------------------------------------------- SentencePiece


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_scan.Pieces(MODEL)


@pytest.fixture(scope="module")
def processor():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=MODEL)


def unigram_proto():
    """The model file with its type set to unigram, for the library."""

    def varint(v):
        out = bytearray()
        while v >= 128:
            out.append(v & 127 | 128)
            v >>= 7
        return bytes(out + bytes([v]))

    with open(MODEL, "rb") as f:
        raw = f.read()
    out = b""
    for number, body in sentencepiece_scan._fields(raw):
        if number == 2:
            body = body + varint(3 << 3) + varint(sentencepiece_scan.UNIGRAM)  # the last value of a field counts
        out += varint(number << 3 | 2) + varint(len(body)) + body
    return out


texts = st.text(alphabet=st.sampled_from(list("abetionshr  \n.,éü漢字🙂▁")), max_size=60)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_ids_are_the_librarys(pieces, processor, text):
    ids = np.frombuffer(pieces.encode_marked(sentencepiece_scan.marked(text)), sentencepiece_scan.ID_TYPE).tolist()
    assert ids == processor.encode(text)
    if "▁" not in text:
        assert pieces.decode(ids) == text


@settings(max_examples=100, deadline=None)
@given(texts, st.integers(1, 25))
def test_chunked_scan_equals_whole_path(pieces, text, size):
    whole = sentencepiece_scan.marked(text)
    parts = list(sentencepiece_scan.chunks(whole, size, pieces.longest))
    if not parts:
        return
    states = sentencepiece_scan.boundary_states([pieces.transfer(c, a, b, end) for _, c, a, b, end in parts])
    traced = b"".join(pieces.trace(c, a, b, end, states[k], states[k + 1]) for k, (_, c, a, b, end) in enumerate(parts))
    assert traced == pieces.encode_marked(whole)


def test_unigram_paths_score_as_high_as_the_librarys(tmp_path):
    from sentencepiece import SentencePieceProcessor

    path = tmp_path / "unigram.model"
    path.write_bytes(unigram_proto())
    library = SentencePieceProcessor(model_file=str(path))
    own = sentencepiece_scan.Pieces(str(path))
    assert not own.merging
    score = [library.get_score(i) for i in range(library.get_piece_size())]
    for text in ("the internationalisation of things", "a b  c", "éü xyz\nabc", "thntherone", "qqqqzzzz wordpress"):
        whole = sentencepiece_scan.marked(text)
        ids = np.frombuffer(own.encode_marked(whole), sentencepiece_scan.ID_TYPE).tolist()
        assert sum(score[i] for i in ids) >= sum(score[i] for i in library.encode(text)) - 1e-2
        parts = list(sentencepiece_scan.chunks(whole, 6, own.longest))
        states = sentencepiece_scan.boundary_states([own.transfer(c, a, b, end) for _, c, a, b, end in parts])
        assert b"".join(own.trace(c, a, b, end, states[k], states[k + 1]) for k, (_, c, a, b, end) in enumerate(parts)) == own.encode_marked(whole)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=2, max_size=9), st.integers(0, 2**31))
def test_scan_gives_all_prefix_products(widths, seed):
    rng = np.random.default_rng(seed)
    matrices = [rng.integers(-9, 9, (a, b)).astype(float) for a, b in zip([1, *widths], widths)]
    product = matrices[0]
    for got, m in zip(sentencepiece_scan.scanned(matrices)[1:], matrices[1:]):
        product = sentencepiece_scan.max_plus(product, m)
        assert (got == product).all()


def test_encode_round_trip_with_giant_texts(frame, processor):
    pairs = ADVERSE + [(50, "x" * 700), (51, "word " * 300), (51, "word " * 300), (52, " " * 500 + "end")]
    encoded = sentencepiece_scan.encode(frame(pairs, clashing=True), MODEL, chunk_chars=97)
    rows = sentencepiece_scan.decode(encoded.withColumn("n", F.octet_length("ids") / 4).withColumn("copy", F.col("ids")), MODEL).collect()
    assert collections.Counter((r.doc_id, r.decoded) for r in rows) == collections.Counter((d, t or "") for d, t in pairs)
    by_text = {r.decoded: np.frombuffer(r.copy, sentencepiece_scan.ID_TYPE).tolist() for r in rows}
    assert all(ids == processor.encode(t) for t, ids in by_text.items())
    assert max(r.chunks for r in rows) > 100
    assert sentencepiece_scan.encode(frame([]), MODEL).collect() == []


# ----------------------------------------------------------- vector forest


def test_forest_recall_order_and_ties(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 16))
    x = (centres[rng.integers(0, 30, 3000)] + 0.6 * rng.standard_normal((3000, 16))).astype(np.float32)
    x[100:400] = x[100]  # one very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(3000, None), (3050, [0.0] * 16), (3100, [float("nan")] + [1.0] * 15), (3150, [None] + [1.0] * 15), (3200, [1.0, 2.0]),
           (3250, []), (None, x[5].tolist()), (3300, [float("inf")] + [1.0] * 15)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).repartition(5)
    found = vector_forest.neighbours(df, F.col("vec_id") % 50 == 0, leaf=64).collect()
    got = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    y = x.astype(float)
    unit = y / np.linalg.norm(y, axis=1, keepdims=True)
    hits = 0
    assert set(got) == set(range(0, 3000, 50))
    for q, pairs in got.items():
        cosine = unit @ unit[q]
        assert [r["rank"] for r in found if r.query_id == q].__len__() == 5
        assert all(abs(cosine[v] - s) < 1e-12 and v != q for v, s in pairs)
        assert pairs == sorted(pairs, key=lambda p: (-p[1], p[0]))
        order = [i for i in np.lexsort((np.arange(3000), -np.round(cosine, 12))).tolist() if i != q][:5]
        hits += len(set(order) & {v for v, _ in pairs})
    assert hits / (5 * len(got)) >= 0.9
    assert [v for v, _ in got[150]] == [100, 101, 102, 103, 104]


def test_forest_few_rows(spark):
    schema = "vec_id long, embedding array<double>"
    two = spark.createDataFrame([(0, [1.0, 0.0]), (7, [2.0, 2.0]), (50, None)], schema)
    rows = vector_forest.neighbours(two, F.col("vec_id") % 50 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in rows] == [(0, 1, 7, 0.707106781)]
    assert vector_forest.neighbours(two.limit(0), F.lit(True)).collect() == []
    assert vector_forest.neighbours(two, F.lit(False)).collect() == []


def test_search_visits_every_leaf_once_nearest_first():
    rng = np.random.default_rng(2)
    forest = vector_forest.Forest.grown(rng.standard_normal((500, 8)), 3, 4)
    seen = list(forest.search(rng.standard_normal(8)))
    assert sorted(seen) == list(range(3 * 16))
    x = rng.standard_normal((20, 8))
    for row, leaves in zip(x, forest.leaves(x)):
        assert set(list(forest.search(row))[:3]) == set(leaves.tolist())  # its own leaves cost nothing


# ---------------------------------------------------------------- sharding


@pytest.mark.parametrize("rows_per_subdivision", [100_000, 7])
def test_sharding_laws(frame, monkeypatch, rows_per_subdivision):
    monkeypatch.setattr(sharding, "ROWS_PER_SUBDIVISION", rows_per_subdivision)
    rng = random.Random(1)
    pairs = ADVERSE[:8] + [(100 + i, "hot copy of a text" if i % 3 == 0 else "t " * rng.randrange(1, 60) + str(i)) for i in range(1500)]
    rows = sharding.shard(frame(pairs, clashing=True), shards=6).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == collections.Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in pairs
    )
    slots = collections.defaultdict(list)
    size = collections.Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert set(slots) == set(range(6)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(size.values()) < 1.05 * sum(size.values()) / 6
    assert sharding.shard(frame([])).collect() == []


def test_only_groups_over_a_shards_bytes_are_split(frame):
    texts = ["large " * 150] * 30 + [""] * 200 + ["whole " * 100] * 9 + [f"text {i} " * 40 for i in range(60)]
    rows = sharding.shard(frame(list(enumerate(texts))), shards=4).collect()
    sizes = {t: len(t) + sharding.ROW_BYTES for t in set(texts)}
    capacity = sum(sizes[t] for t in texts) / 4
    placed = {t: collections.Counter(r.shard for r in rows if texts[r.doc_id] == t) for t in set(texts)}
    large = "large " * 150
    fitting = int(capacity // sizes[large])
    assert 30 * sizes[large] > capacity and 200 > len(texts) / 4 and 9 * sizes["whole " * 100] <= capacity
    assert len(placed[large]) == -(-30 // fitting) and max(placed[large].values()) <= fitting
    assert all(len(s) == 1 for t, s in placed.items() if t != large)


def test_groups_of_equal_texts_stay_together(frame):
    pairs = [(i, f"text {i // 4} " * (1 + i // 4 % 9)) for i in range(1200)]
    rows = sharding.shard(frame(pairs), shards=6).collect()
    by_text = collections.defaultdict(set)
    for r in rows:
        by_text[r.doc_id // 4].add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())


# ----------------------------------------------------------------- packing


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_window_plan_uses_every_piece_once(histogram):
    plan = packing.window_plan(histogram, 64)
    used = collections.Counter()
    for combo, times in plan:
        assert times > 0 and sum(a * n for a, n in combo) <= 64
        for a, n in combo:
            used[a] += n * times
    assert dict(used) == histogram


def test_window_plan_padding_is_small():
    rng = np.random.default_rng(0)
    lengths, counts = np.unique(np.clip(rng.lognormal(5.5, 1, 20_000).astype(int), 1, 4096), return_counts=True)
    plan = packing.window_plan(dict(zip(lengths.tolist(), counts.tolist())))
    total = int((lengths * counts).sum())
    assert sum(t for _, t in plan) * 4096 < 1.005 * total + 4096


def test_solved_repeats_reproduce_a_consistent_histogram():
    combos = packing.combinations(np.array([16, 24, 40, 48]), np.array([4, 4, 4, 4]), 64)
    x = np.arange(len(combos), dtype=float)
    target = np.bincount(combos[:, 0::2].ravel(), (combos[:, 1::2] * x[:, None]).ravel(), 65)
    target[0] = 0
    solved = packing.solve_repeats(combos, target, 3000)
    used = np.bincount(combos[:, 0::2].ravel(), (combos[:, 1::2] * solved[:, None]).ravel(), 65)
    assert np.abs(used - target)[1:].max() < 0.5 and solved.min() >= 0


def test_encoder_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    encoder = encoders.WordEncoder(WORDS, cache_entries=50)
    texts = [t or "" for _, t in ADVERSE if t is None or len(t) < 10_000]
    texts += ["It's we'll I'd x'S 'TIS", "İstanbul ŉ Σίσυφος ΣΑΣ ﬁ é ́a", "<|endoftext|> a<|startoftext|>b <|endoftext|", "a\tb\x1cc\x85d　e\xa0f",
              "ﷺ ½ ⅷ ²3", "—dash… «q» “x” don’t", "AKIA123 a1b2", "​zero﻿"]
    texts += [r.text for r in table(spark, SF_SMALL, "documents").select("text").limit(60).collect()]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_texts_are_cut_at_spaces():
    text = "ab cd " * 50 + "x" * 40 + " " + "y" * 30
    parts = list(encoders.segments(text, 16))
    assert " ".join(parts) == text and len(parts) > 5


def test_packing_places_every_id_once(frame):
    encoder = encoders.WordEncoder(WORDS)
    pairs = ADVERSE + [(100 + i, "the cat sat " * (i % 23)) for i in range(150)]
    pieces = packing.tokenised_pieces(frame(pairs, clashing=True), WORDS, 2, window=64)
    placed = packing.place(pieces, window=64)
    rows = placed.collect()
    found = collections.defaultdict(list)
    for r in rows:
        found[(r.doc_id, r.doc_tokens)].append((r.start, r.length, bytes(r.ids)))
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    expected = collections.Counter(encoder.encode(t or "") + b"\x02\0\0\0" for _, t in pairs)
    whole = collections.Counter()
    for (d, tokens), spans in found.items():
        copies = collections.Counter(spans)
        n = min(copies.values())
        text = b"".join(s[2] for s in sorted(copies))
        if len(text) == 4 * tokens:
            whole[text] += n
    assert not whole - expected  # texts of one id and length may be told apart only by their ids' places
    got, want = collections.Counter(), collections.Counter()
    for r in rows:
        for k, token in enumerate(np.frombuffer(bytes(r.ids), "<u4").tolist()):
            got[r.doc_id, r.doc_tokens, r.start + k, token] += 1
    for d, t in pairs:
        ids = np.frombuffer(encoder.encode(t or "") + b"\x02\0\0\0", "<u4").tolist()
        want.update((d, len(ids), k, token) for k, token in enumerate(ids))
    assert got == want
    assert packing.place(packing.tokenised_pieces(frame([]), WORDS, 2)).collect() == []
    for r in packing.sequences(placed, 64).collect():
        assert len(r.ids) == 4 * (r.length if r.length & (r.length - 1) == 0 else 64)


# ---------------------------------------------------------------- revisits


def test_canonical_urls(spark):
    cases = [
        ("http://www.Example.com:80/a/b/?utm_source=x&b=2&a=1#top", "example.com/a/b?a=1&b=2"),
        ("https://example.com/a/b?a=1&b=2", "example.com/a/b?a=1&b=2"), ("//Example.com", "example.com"),
        ("https://user:pw@example.com:443/?ref=1", "example.com"), ("mailto:x@y", "mailto:x@y"), ("", ""), (None, None),
    ]
    df = spark.createDataFrame(cases, "url string, want string")
    assert [r for r in df.withColumn("got", warc_revisits.canonical_url(F.col("url"))).collect() if r.got != r.want] == []


RECORDS = "record_id long, url string, ts long, kind string, headers string, payload_digest string, extra string"


@pytest.mark.parametrize("buckets", [1, 4, 1024])
def test_revisits_match_brute_force(spark, buckets):
    rng = random.Random(buckets)
    records = []
    for i in range(500):
        url = "http://hot.com/" if i % 3 == 0 else f"http://www.site{rng.randrange(12)}.com/p/"
        kind = "response" if rng.random() < 0.4 else "revisit"
        tag = rng.choice("xyz")
        headers = rng.choice([f'ETag: "{tag}"\r\nServer: {i}', f'ETag: W/"{tag}"\nContent-Length: {i}', "Server: s", f"Last-Modified: day {tag}", f'ETag: "{tag}"\nLast-Modified: day y', None])
        records.append((i, url, rng.randrange(60), kind, headers, rng.choice(["d1", "d2", None]), "e"))
    records += [(900, None, 5, "revisit", None, None, "e"), (901, "http://hot.com", None, "revisit", None, None, "e"), (902, "http://hot.com", None, "response", None, None, "e")]
    got = {r.record_id: r for r in warc_revisits.resolve(spark.createDataFrame(records, RECORDS), buckets).collect()}
    assert set(got) == {r[0] for r in records if r[3] == "revisit"}

    def canonical(u):
        return None if u is None else u.replace("http://", "").replace("www.", "").rstrip("/")

    def parse(block):
        return dict((k.lower(), v.strip()) for k, v in (line.split(":", 1) for line in (block or "").splitlines()))

    for i, url, ts, kind, headers, digest, _ in records:
        if kind != "revisit":
            continue
        full = [r for r in records if r[3] == "response" and url and canonical(r[1]) == canonical(url) and ts is not None and r[2] is not None and r[2] < ts]
        best = max(full, key=lambda r: (r[2], r[0]), default=None)
        assert got[i].resolved_id == (best[0] if best else None)
        if best is None:
            assert got[i].status == "orphan"
            continue
        mine, stored = parse(headers), parse(best[4])
        checks = [(mine.get(n), stored.get(n)) for n in ("etag", "last-modified")] + [(digest, best[5])]
        checks = [(a.replace("W/", ""), b.replace("W/", "")) for a, b in checks if a and b]
        status = "unverified" if not checks else "resolved" if checks[0][0] == checks[0][1] else "mismatch"
        assert got[i].status == status
        if status == "resolved":
            assert got[i].headers == {**stored, **{k: v for k, v in mine.items() if k != "content-length"}}
        else:
            assert got[i].headers == mine


def test_an_outlying_or_hot_time_leaves_even_buckets(spark):
    """One record at time 0 and one in the year 9999, a third of the records at one time; the rest over an hour."""
    rng = random.Random(9)
    times = [0, 253_370_764_800] + [1_700_000_000 + rng.randrange(3600) for _ in range(2000)] + [1_700_001_000] * 1000
    frame = spark.createDataFrame([(t,) for t in times], "_ts long")
    bounds = warc_revisits.time_bounds(frame, 64)
    assert len(bounds) <= 63 and bounds == sorted(set(bounds))
    got = frame.withColumn("b", warc_revisits.bucket_of(F.col("_ts"), bounds)).collect()
    assert all(r.b == sum(x <= r._ts for x in bounds) for r in got)
    sizes = collections.Counter(r.b for r in got if r._ts != 1_700_001_000)
    assert max(sizes.values()) <= 2 * len(times) / 64
    for n in (0, 1, 31, 32, 33, 70):
        steps = list(range(10, 10 + 2 * n, 2))
        rows = spark.range(200).withColumn("b", warc_revisits.bucket_of(F.col("id"), steps)).collect()
        assert all(r.b == sum(x <= r.id for x in steps) for r in rows)
    records = [(i, "http://a.b/", t, "response" if i % 5 == 0 else "revisit", None, "d", "") for i, t in enumerate(times)]
    found = {r.record_id: r.resolved_id for r in warc_revisits.resolve(spark.createDataFrame(records, RECORDS), 64).collect()}
    full = sorted((t, i) for i, t in enumerate(times) if i % 5 == 0)
    assert found == {i: (full[k - 1][1] if (k := bisect.bisect_left(full, (t, -1))) else None) for i, t in enumerate(times) if i % 5}


def test_revisits_empty_and_repeated_rows(spark):
    assert warc_revisits.resolve(spark.createDataFrame([], RECORDS)).collect() == []
    rows = [(1, "http://a.b/", 1, "response", "A: 1\nA: 2\nno colon", "d", "")] + [(2, "http://a.b", 3, "revisit", None, "d", "")] * 2
    found = warc_revisits.resolve(spark.createDataFrame(rows, RECORDS)).collect()
    assert [(r.record_id, r.resolved_id, r.status, r.headers) for r in found] == [(2, 1, "resolved", {"a": "1, 2"})] * 2


# ---------------------------------------------------------------- vectors packed by the dot product


@pytest.mark.parametrize("seed", range(6))
def test_every_item_goes_where_its_dot_product_is_highest(seed):
    """Replays the choices one by one in plain Python."""
    rng = random.Random(seed)
    bins = rng.choice([1, 3, 8])
    items = [[rng.choice([1, 5, rng.randrange(1, 400)]), rng.randrange(0, 50), rng.randrange(1, 4)] for _ in range(rng.choice([0, 1, 2, 150]))]
    if seed == 5:
        items += [[10_000, 1, 1]] * 2  # larger than a bin
    chosen = sharding.pack_vectors(np.array(items, float).reshape(-1, 3), bins).tolist()
    assert len(chosen) == len(items)
    totals = [sum(w[m] for w in items) for m in range(3)]
    scaled = [[w[m] / (totals[m] / bins if totals[m] else 1.0) for m in range(3)] for w in items]
    left = [[1.0] * 3 for _ in range(bins)]
    for i in sorted(range(len(items)), key=lambda i: -max(scaled[i])):  # largest first, ties in order
        fits = [b for b in range(bins) if left[b][0] >= scaled[i][0] - 1e-12]
        dot = [sum(x * y for x, y in zip(left[b], scaled[i])) for b in range(bins)]
        if fits:
            assert chosen[i] in fits and dot[chosen[i]] >= max(dot[b] for b in fits) - 1e-9
        else:
            assert left[chosen[i]][0] >= max(each[0] for each in left) - 1e-9
        left[chosen[i]] = [x - y for x, y in zip(left[chosen[i]], scaled[i])]


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, frame, tmp_path):
    import corpus_pipeline

    rng = random.Random(3)
    clean = ["the", "cat", "house", "tree", "river", "blue", "stone", "window", "garden", "paper", "light", "road"]
    texts = [" ".join(rng.choice(clean) for _ in range(40)) + f" n{i}." for i in range(120)]
    for i in range(0, 120, 4):
        texts[i] += " what a moron."
    texts += ["EXACT copy of one text"] * 5 + ["exact COPY of one text", "password=hunter2222 in a text", None, ""]
    near = [rng.choice(clean) + str(rng.randrange(1000)) for _ in range(90)]
    texts += [" ".join(near), " ".join([*near[:45], "changed", *near[46:]])]
    frame(list(enumerate(texts))).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(100)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
    ids = {n: {r.doc_id for r in rows} for n, rows in kept.items()}
    toxic = set(range(0, 120, 4))
    assert ids["toxicity"] == set(range(len(texts))) - toxic
    assert ids["exact_dedup"] == ids["toxicity"] - {120, 121, 122, 123, 124, 127}
    assert ids["ngram_join"] == ids["exact_dedup"] - {len(texts) - 1}
    assert ids["secret_scan"] == ids["ngram_join"]
    assert {r.doc_id: r.text for r in kept["secret_scan"]}[126] == "[SECRET] in a text"
    assert all(r.n_chars == len(r.text) for r in kept["secret_scan"] if r.text is not None)
    assert ids["packing"] == ids["secret_scan"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    from tools.oracle_check import rows_of

    df = queries.QUERIES[name](spark, SF_SMALL)
    result = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, result.fetchall())


class _Counted(dict):
    looked = 0

    def get(self, *args):
        self.looked += 1
        return super().get(*args)


def test_words_are_merged_with_few_lookups(pieces):
    """A word takes about one look-up a character, and the path is that of the search over all positions."""
    rng = random.Random(5)
    words = ["▁" + "".join(rng.choice(["the", "ing", "er", "st", "qu", "é", "ß", ",", "x9"]) for _ in range(6)) for _ in range(400)]
    words += ["".join(rng.choice("▁abehinrst漢🙂\n.") for _ in range(rng.randint(1, 20))) for _ in range(400)] + ["▁" * 9, "a" * 40, ""]
    table, pieces.table = pieces.table, _Counted(pieces.table)
    try:
        fast, looked = [pieces._merged_path(w) for w in words], pieces.table.looked
    finally:
        pieces.table = table
    assert looked < 2.5 * sum(map(len, words))
    assert fast == [pieces._searched_path(w) for w in words]


def test_characters_that_only_longer_pieces_hold_are_searched(pieces, monkeypatch):
    monkeypatch.setattr(pieces, "closed", False)
    assert pieces._merged_path("▁whether") == pieces._searched_path("▁whether")
