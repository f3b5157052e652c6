"""Toxicity, secret scan, language model: held-out accuracy, brute force, adverse rows."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_fixtures import ADVERSE, LONG, frame  # noqa: F401
from tarmac.llm import language_model as lm
from tarmac.llm import queries, secrets, toxicity

# ---------------------------------------------------------------- toxicity


def labelled(n=240, seed=2):
    rng = random.Random(seed)
    clean = ["the", "cat", "house", "tree", "river", "blue", "stone", "window", "garden", "paper"]
    bad = ["moron", "moronic", "scumbag"]
    docs, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(clean) for _ in range(8)) for _ in range(rng.randrange(2, 12))]
        toxic = i % 4 == 0
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(bad)
        docs.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def trained(spark, frame):
    docs, labels = labelled()
    known = spark.createDataFrame(labels, "doc_id long, toxic int").where("doc_id % 5 <> 0")
    return docs, dict(labels), toxicity.train(frame(docs), known)


def test_toxicity_held_out_accuracy_and_location(frame, trained):
    docs, labels, model = trained
    rows = toxicity.score(frame(docs), model).select("_row.doc_id", "_row.text", "score", "predicted", "offending").collect()
    held = [r for r in rows if r.doc_id % 5 == 0]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95
    for r in rows:
        assert 0 <= r.score <= 1
        if labels[r.doc_id] and r.predicted:
            assert any("moron" in r.text[s.start : s.end] or "scum" in r.text[s.start : s.end] for s in r.offending)


def test_noisy_or_combines_sentences():
    scorer = toxicity.Scorer({toxicity.BIAS: -2.0, "bad": 3.0})
    p = 1 / (1 + math.exp(-1.0))
    q = 1 / (1 + math.exp(2.0))
    score, offending = scorer.score("a bad one. fine here! bad")
    assert score == pytest.approx(1 - (1 - p) ** 2 * (1 - q))
    assert [(s["start"], s["end"]) for s in offending] == [(0, 9), (21, 25)]


def test_toxicity_adverse_rows_and_no_labels(spark, frame, trained):
    df = frame(ADVERSE, clashing=True)
    rows = toxicity.score(df, trained[2]).select("_row.*", F.col("score").alias("p"), "predicted").collect()
    assert len(rows) == len(ADVERSE) and all(r.p == 0 for r in rows if not (r.text or "").strip())
    none = toxicity.train(df, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(df, none).select("score").collect()} == {0.0}
    assert toxicity.score(frame([]), trained[2]).count() == 0


# ----------------------------------------------------------------- secrets

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def expected_base(text):
    t = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m.group()) >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


def secret_texts():
    rng = random.Random(8)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    b64 = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n))
    texts = [None, "", "nothing here", f'Token = "{hexes(40)}" end', f"é漢🙂 API_KEY:{b64(30)}", "secret=abc", "token=token:abcdefgh",
             "password: hunter22 passwd='short' apikey = 123456", "AKIA" + "A1B2C3D4E5F6G7H8", "AKIAAKIA12", "xAKIA" + "Z" * 30,
             hexes(23), hexes(24), hexes(64) + "g" + hexes(30), f"secret={hexes(40)} secret={hexes(40)}", "a" * 50, LONG,
             'token"  :  "abc.def-ghi"', "tokens = abcdefg", "KEY api_key=\n123456", "Secret:" + "x" * 5 + " " + hexes(32)]
    texts += [f"id {i} token: {hexes(40)} and {b64(40)}" for i in range(60)]
    return [(i, t) for i, t in enumerate(texts)]


def test_base_spans_match_regular_expressions(frame):
    pairs = secret_texts()
    rows = secrets.scan(frame(pairs, clashing=True), None).select("_row.doc_id", secrets.joined("base").alias("b"), secrets.joined("spans").alias("s"))
    got = {r.doc_id: (r.b, r.s) for r in rows.collect()}
    for d, t in pairs:
        assert got[d] == (expected_base(t), expected_base(t))


def test_markov_adds_random_strings_and_leaves_identifiers(frame):
    rng = random.Random(9)
    fresh = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(44))
    words = [f"internationalization_of_{w}_configuration_settings" for w in ("window", "garden", "network", "printer", "history")]
    keys = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40)) for _ in range(300)]
    training = [(i, f"token: {k} in {' '.join(words)}") for i, k in enumerate(keys)]
    model = secrets.train(frame(training))
    assert model is not None and len(model) == len(secrets.ALPHABET) ** 2
    texts = [(1, f"look {fresh} here"), (2, " ".join(words)), (3, None), (4, f"token={fresh}")]
    rows = secrets.scan(frame(texts), model).select("_row.doc_id", secrets.joined("spans").alias("s")).collect()
    got = {r.doc_id: r.s for r in rows}
    assert got[1] == f"markov:5:{5 + len(fresh)}" and got[2] == "" and got[3] == ""
    assert got[4] == expected_base(f"token={fresh}")  # covered by the pattern: no second span


CLEAN = ["3f2504e0-4f89-41d3-9a0c-0305e82c3301", "2023-04-15/2023-04-18", "=" * 20, "-" * 20, "_" * 24,
         "user_profile_image_1024x768", "src/main/java/org/example/App"]


@pytest.fixture(scope="module")
def prose_model(frame):
    rng = random.Random(10)
    syllables = ["ta", "ren", "mo", "lis", "ver", "con", "ti", "on", "pa", "sel"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 6)))
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    texts = [f"{' '.join(word() for _ in range(40))} token={''.join(rng.choice(chars) for _ in range(32))}" for _ in range(300)]
    return secrets.train(frame([(i, t) for i, t in enumerate(texts)]))


def markov_spans(frame, model, texts):
    rows = secrets.scan(frame(list(enumerate(texts))), model).select("_row.doc_id", "_row.text", "spans").collect()
    found = {r.doc_id: [r.text[s.start : s.end] for s in r.spans if s.kind == "markov"] for r in rows}
    return [found[i] for i in range(len(texts))]


def test_short_random_strings_and_the_rest_of_split_tokens_are_found(frame, prose_model):
    fresh, rest = "x9Kq2LmZ7vRt4WpB", "Zq8Xw3Kv9Ju2Rm5T"
    texts = [f"look {fresh} here", "at Q7xZ9kW2 too", f"{rest}/{'0123456789abcdef' * 2}", f"AKIA{'A1B2C3D4' * 2}_{rest.lower()}{rest}"]
    got = markov_spans(frame, prose_model, texts)
    assert got[0] == [fresh] and got[1] == ["Q7xZ9kW2"]
    assert len(got[2]) == 1 and got[2][0].startswith(rest)
    assert len(got[3]) == 1 and got[3][0].endswith(rest)


def test_clean_tokens_with_digits_slashes_and_rules_stay(frame, prose_model):
    assert markov_spans(frame, prose_model, [f"see {t} there" for t in CLEAN]) == [[]] * len(CLEAN)
    df = frame([(0, " ".join(CLEAN))])
    assert secrets.redact(df, prose_model).first().text == " ".join(CLEAN)


def test_unseen_characters_weigh_nothing(spark):
    rows = [("aXbX" * 4, 1)] + [(w, 0) for w in ("plain", "words", "of", "several", "letters")] * 50
    model = secrets.fit(spark.createDataFrame(rows, "value string, random int"))
    at = secrets.ALPHABET.index("+")
    assert model[at * len(secrets.ALPHABET) + at] == pytest.approx((0, 0, 0, 0), abs=1e-9)


def test_redaction_keeps_everything_else(frame):
    texts = [(1, "a token=abcdef123 b"), (2, "clean text"), (3, None), (4, "é🙂 token=" + "0123456789abcdef" * 3 + " z " + "f" * 30)]
    df = frame(texts, clashing=True)
    out = secrets.redact(df, None)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: "a [SECRET] b", 2: "clean text", 3: None, 4: "é🙂 [SECRET] z [SECRET]"}


def test_secrets_without_samples(frame):
    assert secrets.train(frame([(1, "plain"), (2, None)])) is None
    assert secrets.scan(frame([]), None).count() == 0


def test_secret_query_digests(spark, frame, tmp_path):
    pairs = secret_texts()
    frame(pairs).write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.op7_secret_scan(spark, str(tmp_path)).collect():
        base = expected_base(dict(pairs)[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(base.count(k + ":") for k in ("assign", "access", "hex"))
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


# ---------------------------------------------------------- language model


def expected_base_scores(pairs, training):
    counts = collections.Counter()
    for d, t in pairs:
        if training(d):
            counts.update((t or "").encode().lower().split() + [b""])
    n, v = sum(counts.values()), len(counts)
    out = collections.Counter()
    for d, t in pairs:
        words = (t or "").encode().lower().split() + [b""]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        out[(d, len(words), sum(w in counts for w in words), n, round(base, 6))] += 1
    return out


@pytest.mark.parametrize("frequent", [5, 100_000])
def test_language_model_counts_match_brute_force(frame, frequent):
    pairs = ADVERSE + [(100 + i, f"one two three w{i % 9} W{i} x\x0by\x0cz") for i in range(60)]
    training = lambda d: d is None or zlib.crc32(str(d).encode()) % 7 != 2
    is_training = queries.fold(F.col("doc_id"), 7) != 2
    rows = lm.score(frame(pairs, clashing=True), is_training, frequent=frequent, vocabulary=8, train_documents=20).collect()
    got = collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert got == expected_base_scores(pairs, training)
    assert all(r.score < 0 for r in rows)


def test_language_model_beats_unigrams_on_held_out_text(frame):
    rng = random.Random(6)
    follow = {"a": "b", "b": "c", "c": "d", "d": "a"}
    pairs = []
    for i in range(300):
        w = [rng.choice("abcd")]
        while len(w) < 30:
            w.append(follow[w[-1]] if rng.random() < 0.9 else rng.choice("abcd"))
        pairs.append((i, " ".join(w)))
    rows = lm.score(frame(pairs), queries.fold(F.col("doc_id"), 7) != 2, train_documents=250).collect()
    held = [r for r in rows if not r.trained_on]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)  # log10: less negative


def test_language_model_trains_on_every_training_row(frame, monkeypatch):
    rng = random.Random(12)
    pairs = [(i, " ".join(f"w{rng.randrange(2500)}" for _ in range(12))) for i in range(1800)]
    monkeypatch.setattr(lm, "SHARD_TOKENS", 1500)  # more shards than partitions, each read once
    monkeypatch.setattr(lm, "PARTIAL_SUMS", 0)  # partial sums, then sums
    trained, sizes, average = [], [], lm.GatedModel.average

    def watched(model, sums):
        # part 0 holds the bias "b": its last column is the number of tokens
        trained.append(np.frombuffer(sums[0], "<f4").reshape(-1, 2)[0, 1])
        sizes.append(model.vocabulary)
        average(model, sums)

    monkeypatch.setattr(lm.GatedModel, "average", watched)
    training = {d for d, _ in pairs if zlib.crc32(str(d).encode()) % 7 != 2}
    rows = lm.score(frame(pairs), queries.fold(F.col("doc_id"), 7) != 2).collect()
    assert len(rows) == len(pairs) and all(math.isfinite(r.score) for r in rows)
    assert len(trained) == lm.ROUNDS and sum(trained) == 13 * len(training)
    counts = collections.Counter(w for d, t in pairs if d in training for w in t.split())
    assert set(sizes) == {2 + sum(n >= lm.LEAST_SEEN for n in counts.values())} and sizes[0] > 2048


def test_language_model_without_training_rows(frame):
    rows = lm.score(frame([(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in rows] == [(0, 0, 0.0)] * 2
    assert all(math.isfinite(r.score) for r in rows)
    assert lm.score(frame([]), F.lit(True)).collect() == []


def test_words_are_split_as_bytes_are():
    rng = random.Random(1)
    alphabet = "aBZ\x00\x1c\x85\xa0é🙂İK \t\n\x0b\x0c\r"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(500)] + ["", " ", ""]
    rows, found = lm.split_words(pa.array(texts))
    got = [[] for _ in texts]
    for row, word in zip(rows, found.to_pylist()):
        got[row].append(word.encode())
    assert got == [t.encode().lower().split() for t in texts]


def test_a_token_costs_the_cube_root_of_the_vocabulary():
    for vocabulary in (2, 7, 1000, 1 << 15):
        model = lm.GatedModel(vocabulary)
        assert model.groups + model.span + model.size <= 3 * vocabulary ** (1 / 3) + 5
        counts = np.random.default_rng(vocabulary).integers(0, 90, vocabulary).astype(float)
        model.start_from(counts)
        logp, _ = model.log_probabilities(np.zeros((vocabulary, model.hidden), np.float32), np.arange(vocabulary))
        assert np.exp(logp) == pytest.approx((counts + 1) / (counts.sum() + vocabulary), rel=1e-4)


def test_texts_are_read_twice_whatever_the_rounds(spark, frame, monkeypatch):
    pairs = [(i, " ".join(f"w{i * k % 50}" for k in range(12))) for i in range(700)]
    monkeypatch.setattr(lm, "SHARD_TOKENS", 500)
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    rows = lm.score(frame(pairs).withColumn("text", seen("text")), queries.fold(F.col("doc_id"), 7) != 2).collect()
    assert len(rows) == len(pairs) and read.value <= 2 * len(pairs)


def test_final_score_matches_plain_recurrence(frame, monkeypatch):
    """Words inside the vocabulary, outside it, rare ones that are joined and unknown ones."""
    pairs = [(i, " ".join(["a", "b", "C"][: 1 + i % 3] * 3 + [f"o{i % 4}", f"r{i % 11}"])) for i in range(40)] + [(90, "a new wOrd"), (91, None)]
    training = [d for d, _ in pairs if d < 90]
    rng = np.random.default_rng(4)

    def fitted(documents, shared, *rest):
        model = lm.GatedModel(shared.value.size)
        model.p = {k: v if k == "bo" else rng.standard_normal(v.shape).astype(np.float32) for k, v in model.p.items()}
        models.append(model)
        return model

    models = []
    monkeypatch.setattr(lm, "fit", fitted)
    rows = {r.doc_id: r for r in lm.score(frame(pairs), F.col("doc_id") < 90, vocabulary=5, frequent=6).collect()}
    split = lambda t: (t or "").lower().split() + [""]
    counts = collections.Counter(w for d, t in pairs if d in training for w in split(t))
    model, total = models[0], sum(counts.values()) + len(counts) + 1
    frequent = sorted(counts, key=lambda w: (-counts[w], w))[:6]
    ids = {"": 0} | {w: k for k, w in enumerate([w for w in frequent if w][:3], 2)}
    assert model.vocabulary == 5 and "" in frequent
    others = total - sum(counts[w] + 1 for w in ids)
    for d, t in pairs:
        h, previous, expected = np.zeros((1, model.hidden), np.float32), 0, 0.0
        for w in split(t):
            h, _ = model.step(np.array([previous]), h)
            previous = ids.get(w, 1)
            expected += float(model.log_probabilities(h, np.array([previous]))[0][0]) / math.log(10)
            if previous == 1:
                expected += math.log10((counts[w] + 1) / others)
        assert rows[d].score == pytest.approx(expected, rel=1e-4)


def test_model_is_a_distribution_and_state_crosses_windows():
    model = lm.GatedModel(11, hidden=5)
    rng = np.random.default_rng(0)
    for k, v in model.p.items():
        if k != "bo":
            model.p[k] = rng.standard_normal(v.shape).astype(np.float32)
    h = rng.standard_normal((1, 5)).astype(np.float32)
    total = sum(math.exp(model.log_probabilities(h, np.array([i]))[0][0]) for i in range(11))
    assert total == pytest.approx(1, abs=1e-4)
    docs = [rng.integers(0, 11, n) for n in (70, 1, 33, 64)]
    whole = model.score(docs, 0, lanes=8, window=200)
    assert model.score(docs, 0, lanes=2, window=7) == pytest.approx(whole, rel=1e-4)
    alone = np.zeros((1, 5), np.float32)
    logp, previous = 0.0, 0
    for token in docs[0]:
        alone, _ = model.step(np.array([previous]), alone)
        logp += float(model.log_probabilities(alone, np.array([token]))[0][0])
        previous = token
    assert whole[0] == pytest.approx(logp, rel=1e-4)


def test_output_gradients_match_differences():
    model = lm.GatedModel(7, hidden=4)
    rng = np.random.default_rng(1)
    for k, v in model.p.items():
        if k != "bo":
            model.p[k] = rng.standard_normal(v.shape)
    model.p["bo"] = model.p["bo"].astype(float)
    h, ids = rng.standard_normal((6, 4)), rng.integers(0, 7, 6)
    grad = {k: np.zeros_like(v) for k, v in model.p.items()}
    _, dh = model.log_probabilities(h, ids, grad)
    for name, at in (("wc", (1, 1)), ("wo", (0, 2, 1)), ("bc", (0,))):
        eps = 1e-5
        model.p[name][at] += eps
        up = -model.log_probabilities(h, ids)[0].sum()
        model.p[name][at] -= 2 * eps
        down = -model.log_probabilities(h, ids)[0].sum()
        model.p[name][at] += eps
        assert grad[name][at] == pytest.approx((up - down) / (2 * eps), abs=1e-4)


def test_gradients_through_time_match_differences():
    """Embeddings, gates and biases: a window with resets, unused targets and a carried state."""
    model = lm.GatedModel(7, hidden=4)
    rng = np.random.default_rng(5)
    model.p = {k: np.where(v <= -1e8, v, rng.standard_normal(v.shape) * 0.7).astype(float) for k, v in model.p.items()}
    training = lm.Training(model, lanes=3, window=6, rate=0.0)  # rate 0: parameters stay
    inputs, targets = rng.integers(0, 7, (3, 6)), rng.integers(0, 7, (3, 6))
    targets[2, 4:] = -1
    starts = np.zeros((3, 6), bool)
    starts[0, 3] = starts[1, 0] = True
    first = rng.standard_normal((3, 4))

    def loss() -> float:
        h, total, n = first, 0.0, 0
        for t in range(6):
            h, _ = model.step(inputs[:, t], h * ~starts[:, t, None])
            used = targets[:, t] >= 0
            total -= model.log_probabilities(h[used], targets[used, t])[0].sum()
            n += used.sum()
        return total / n

    sparse = {}
    training.sparse = lambda name, rows, grad: sparse.__setitem__(name, (rows, grad.copy()))
    training.step(inputs, targets, starts, first)
    rows, grads = sparse["e"]
    gradient = {k: training.grad[k] for k in ("w", "u", "b")} | {"e": np.zeros_like(model.p["e"])}
    gradient["e"][rows] = grads
    assert np.abs(gradient["u"]).max() > 1e-3
    for name, grad in gradient.items():
        for at in np.ndindex(grad.shape):
            old, eps = model.p[name][at], 1e-5
            model.p[name][at] = old + eps
            up = loss()
            model.p[name][at] = old - eps
            down = loss()
            model.p[name][at] = old
            assert grad[at] == pytest.approx((up - down) / (2 * eps), abs=1e-5), (name, at)


# ------------------------------------------------- secrets: evidence, many spans, plain re-computation


ENGLISH = """the of and to in is that it was for on are as with his they be at one have this from or had by hot but some what
there we can out other were all your when up use word how said an each she which do their time if will way about many then them would write
like so these her long make thing see him two has look more day could go come did my sound no most number who over know water than call first
people may down side been now find any new work part take get place made live where after back little only round man year came show every
good me give our under name very through just form great think help low line before turn cause same mean differ move right boy old too does
tell sentence set three want air well also play small end put home read hand port large spell add even land here must big high such follow
invoice window report garden sensor network printer history system question during without again problem picture change service"""


@pytest.fixture(scope="module")
def english_model(frame):
    rng = random.Random(11)
    words = ENGLISH.split()
    sentence = lambda: " ".join(rng.choice(words) for _ in range(12)).capitalize() + "."
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    texts = [f"{sentence()} {sentence()} token={''.join(rng.choice(chars) for _ in range(32))}" for _ in range(300)]
    return secrets.train(frame([(i, t) for i, t in enumerate(texts)]))


def test_formulas_names_and_numbers_are_no_secrets(frame, english_model):
    """Ordinary strings that no sample holds."""
    rng = random.Random(12)
    words = ["C6H12O6", "C2H5OH", "Mg2SiO4", "H1N1", "H5N1", "R2D2", "i18n-l10n-a11y", "MP3", "b2b", "IPv6", "ISO-8859-1", "utf8mb4", "x86_64", "RFC2616",
             "20230415T123000", "0x7ffe", "1234567890123456", "550E8400-E29B-41D4-A716-446655440000", "deadbeefcafe", "0.1.2-beta3", "3rd", "A4", "v1.2.3"]
    nouns = ["invoice", "window", "report", "garden", "sensor"]
    words += [f"{rng.choice(nouns)}{rng.choice('_-')}{rng.choice(nouns)}{rng.randrange(10**k)}" for k in range(1, 6) for _ in range(20)]
    words += [f"{rng.randrange(1990, 2030)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}" for _ in range(40)]
    words += [f"{rng.randrange(10**k)}x{rng.randrange(10**k)}" for k in range(2, 6) for _ in range(10)]
    words += [rng.choice(nouns) + rng.choice(nouns).capitalize() + rng.choice(nouns).capitalize() for _ in range(20)]
    got = markov_spans(frame, english_model, [f"see {w} there" for w in words])
    assert [w for w, g in zip(words, got) if g] == [] and len(words) > 200


def test_unseen_random_strings_are_found(frame, english_model):
    rng = random.Random(13)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    fresh = ["".join(rng.choice(chars) for _ in range(rng.randrange(16, 41))) for _ in range(200)]
    got = markov_spans(frame, english_model, [f"use {w} now" for w in fresh])
    assert sum(g == [w] for w, g in zip(fresh, got)) >= 0.9 * len(fresh)


def test_log_ratio_and_lengths_match_plain_arithmetic(spark, prose_model):
    size, alphabet = len(secrets.ALPHABET), secrets.ALPHABET
    kind = lambda t: 0 if not re.search("[0-9]", t) else 3 if re.search("[A-Z]", t) else 2 if re.search("[a-z]", t) else 1
    plain = lambda t: sum(prose_model[alphabet.index(a) * size + alphabet.index(b)][kind(t)] for a, b in zip(t, t[1:]))
    rng = random.Random(14)
    runs = ["".join(rng.choice(alphabet[:62]) for _ in range(rng.randrange(1, 30))) for _ in range(100)] + ["plain", "1234", "a1", "Q7xZ9kW2"]
    rows = spark.createDataFrame([(t,) for t in runs], "t string").select("t", secrets.log_ratio(F.col("t"), prose_model).alias("x")).collect()
    assert all(r.x == pytest.approx(plain(r.t), abs=1e-9) for r in rows)
    assert max(abs(x) for entry in prose_model for x in entry) <= secrets.MOST
    least = secrets.shortest(prose_model, secrets.THRESHOLD)
    assert all(n is None or n >= secrets.THRESHOLD / secrets.MOST for n in least)
    for t in runs:
        if plain(t) >= secrets.THRESHOLD:
            assert len(t) >= least[kind(t)]


def plain_redaction(text, spans):
    out, at = "", 0
    merged = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        out, at = out + text[at:start] + "[SECRET]", end
    return out + text[at:]


def test_redaction_and_blanking_match_plain_python(frame, prose_model):
    rng = random.Random(15)
    pairs = secret_texts()
    for i in range(40):  # overlapping kinds, touching spans, characters of several bytes, noncharacters
        parts = [rng.choice(["token=", "0123456789abcdef" * 2, "é漢🙂", " ", "x9Kq2LmZ7vRt4WpB", "﷐", "AKIA" + "Z" * 20, ".", "plain words "]) for _ in range(rng.randrange(1, 30))]
        pairs.append((1000 + i, "".join(parts) * rng.choice([1, 1, 9])))
    found = secrets.scan(frame(pairs), prose_model).select(
        "_row.doc_id", "spans", secrets.redacted(F.col("_text"), F.col("spans")).alias("r"), secrets.blanked(F.col("_text"), F.col("spans")).alias("b")
    )
    for r in found.collect():
        text = dict(pairs)[r.doc_id] or ""
        spans = [(s.start, s.end) for s in r.spans]
        assert r.r == plain_redaction(text, spans)
        assert r.b == "".join(" " if any(s <= k < e for s, e in spans) else c for k, c in enumerate(text)) if len(text) < 5000 else True


def test_many_spans_in_one_text(frame):
    """80,000 spans in one text with characters of several bytes: positions right, in seconds."""
    n, piece = 80_000, "é " + "0123456789abcdef0123456789 "
    started = time.monotonic()
    df = frame([(1, piece * n)], partitions=1)
    r = secrets.scan(df, None).select("spans", F.length("_text").alias("n")).first()
    assert len(r.spans) == n and r.n == len(piece) * n
    assert all(s.start == k * len(piece) + 2 and s.end == s.start + 26 for k, s in enumerate(r.spans))
    out = secrets.redact(df, None).first().text
    assert out == "é [SECRET] " * n
    assert time.monotonic() - started < 120


def test_clean_corpus_is_left_alone(frame, prose_model):
    rng = random.Random(16)
    texts = [" ".join(rng.choice(["taren", "molis", "vercon", "tion", "pasel", "Word,", "10%", "(see"]) for _ in range(60)) for _ in range(30)]
    df = frame(list(enumerate(texts)), clashing=True)
    assert sorted(secrets.redact(df, prose_model).collect()) == sorted(df.collect())
