import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from airtrace.llm import langid, maxent_lm
from airtrace.llm.common import fold, fold_of
from airtrace.llm.langid import fit, identify
from airtrace.llm.maxent_lm import score_texts
from airtrace.llm.quality import fit_quality, score_quality
from airtrace.llm.toxicity import Lookup, features, fit_toxicity, score_toxicity
from tests.llm.helpers import documents, with_clashes

EN = "the quick brown fox jumps over the lazy dog and then this is how they went home with that".split()
DE = "der schnelle braune fuchs springt über den faulen hund und dann ist das auch nicht so schön".split()


def _text(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_fold_is_crc32_of_the_id_as_text(spark):
    docs = documents(spark, ["a"] * 5, [0, 7, 123456789012, -3, None])
    got = docs.select("doc_id", fold("doc_id", 5).alias("f")).collect()
    assert all(r["f"] == fold_of(r["doc_id"], 5) for r in got)


def test_language_accuracy_and_edges(spark):
    rng = random.Random(1)
    texts = [_text(rng, EN if i % 2 else DE, rng.randint(3, 40)) for i in range(200)]
    lang = ["en" if i % 2 else "de" for i in range(200)]
    model = fit(documents(spark, texts[:120], lang=lang[:120]))
    held = documents(spark, [*texts[120:], None, "", "123 !!", "x" * 600_000], lang=[*lang[120:], "en", "en", "en", "en"])
    got = {r["doc_id"]: r for r in identify(with_clashes(held), model).collect()}
    assert all(got[i]["lang_pred"] == got[i]["lang"] for i in range(80))
    assert [got[i]["lang_pred"] for i in (80, 81, 82)] == ["und"] * 3
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert identify(held.limit(0), model).count() == 0


def test_language_long_texts_are_cut_without_loss(monkeypatch):
    rng = random.Random(2)
    texts = [_text(rng, EN, 30), "", None, _text(rng, DE, 200), "a"]

    def grams():
        found = Counter()
        for points, starts, owner in langid._blocks(texts):
            for k, (at, bucket) in enumerate(langid._grams(points, starts, 16)):
                of = owner[np.searchsorted(starts, at, side="right") - 1]
                found.update(zip([k] * len(at), of.tolist(), bucket.tolist(), strict=True))
        return found

    whole = grams()
    monkeypatch.setattr(langid, "BLOCK", 17)
    assert grams() == whole


def test_language_without_training_rows(spark):
    docs = documents(spark, ["some text", None], lang=[None, None])
    got = identify(docs, fit(docs)).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * 2


def _noisy(rng):
    return rng.choice([
        lambda: " ".join(w.upper() + "!!" for w in rng.choices(EN, k=30)),
        lambda: " ".join(w + rng.choice(["***", "$$$", "%%%"]) for w in rng.choices(EN, k=30)),
        lambda: (rng.choice(EN) + " ") * 60,
    ])()


def test_quality_held_out_accuracy(spark):
    rng = random.Random(3)
    good = [i % 3 != 0 for i in range(600)]
    texts = [_text(rng, EN + [f"word{j}" for j in range(200)], rng.randint(20, 60)) if g else _noisy(rng) for g in good]
    docs = documents(spark, texts)
    labels = _labels(spark, [(i, int(g), 0) for i, g in enumerate(good)] + [(None, 1, 0), (5, None, None)])
    model = fit_quality(docs, labels, where=fold("_id", 5) != 0, dictionary_where=fold("_id", 5) != 4)
    got = score_quality(with_clashes(docs).drop("score"), model).collect()
    held = [(r["score"] >= 0.3) == good[r["doc_id"]] for r in got if fold_of(r["doc_id"], 5) == 0]
    assert sum(held) / len(held) > 0.95
    odd = score_quality(documents(spark, [None, "", "x" * 300_000, "same", "same"]), model).orderBy("doc_id").collect()
    assert all(0 <= r["score"] <= 1 for r in odd)
    assert odd[0]["score"] == odd[1]["score"] and odd[3]["score"] == odd[4]["score"]
    assert score_quality(docs.limit(0), model).count() == 0


def test_quality_without_labels_of_both_classes(spark):
    docs = documents(spark, ["a b c", None])
    for rows, rate in (([], 0.0), ([(0, 1, 0), (1, 1, 0)], 1.0)):
        model = fit_quality(docs, _labels(spark, rows), where=F.lit(True))
        assert [r["score"] for r in score_quality(docs, model).collect()] == [rate, rate]


def test_toxicity_held_out_accuracy(spark):
    rng = random.Random(4)
    bad = ["zork", "blargfest", "snivelwit"]
    toxic = [i % 4 == 0 for i in range(800)]
    texts = []
    for t in toxic:
        words = rng.choices(EN, k=rng.randint(8, 50))
        if t:
            words[rng.randrange(len(words))] = rng.choice(bad)
        texts.append(" ".join(words))
    docs = documents(spark, texts)
    labels = _labels(spark, [(i, 1, int(t)) for i, t in enumerate(toxic)])
    model = fit_toxicity(docs, labels, where=fold("_id", 5) != 0, part=fold("_id", 5) - 1, trees=5)
    scored = score_toxicity(with_clashes(docs).drop("score"), model).collect()
    held = [(r["score"] >= 0.5) == toxic[r["doc_id"]] for r in scored if fold_of(r["doc_id"], 5) == 0]
    assert sum(held) / len(held) > 0.97
    odd = score_toxicity(documents(spark, [None, "", "é" * 200_000, "!!! 123"]), model).collect()
    assert len(odd) == 4 and all(0 <= r["score"] <= 1 for r in odd)
    assert score_toxicity(docs.limit(0), model).count() == 0
    unlearnt = fit_toxicity(docs, _labels(spark, [(0, 1, 0)]))
    assert {r["score"] for r in score_toxicity(docs, unlearnt).collect()} == {0.0}


def test_obfuscated_spelling_is_read_back():
    lookup = Lookup({"zork": 3.0})
    assert features("you are a z0rk today", lookup)[15] > 0
    assert features("you are a fork today", lookup)[15] == 0
    assert features("you zork", lookup)[7] == 1.0  # next to a second person


def _brute_base(ids, texts):
    tokens = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in zip(ids, texts, strict=True)}
    c = Counter()
    for i, words in tokens.items():
        if fold_of(i, 5) != 1:
            c.update(words)
    n = sum(c.values())
    z = n + 0.5 * (len(c) + 1)
    return n, {
        i: (len(w), sum(c[x] > 0 for x in w), sum(math.log10((c[x] + 0.5) / z) for x in w)) for i, w in tokens.items()
    }


def test_language_model_base_and_gain(spark, monkeypatch):
    monkeypatch.setattr(maxent_lm, "HOT_WORDS", 60)  # leave words to the join
    rng = random.Random(6)
    texts = []
    for i in range(300):
        words, out = (EN if i % 2 else DE), []
        for _ in range(rng.randint(5, 40)):
            out.append(words[(words.index(out[-1]) + 1) % len(words)] if out and out[-1] in words and rng.random() < 0.7 else rng.choice(words + [f"rare{rng.randrange(400)}"]))
        texts.append(" ".join(out))
    texts[7], texts[9], texts[11] = None, "", "THE the x"
    ids = list(range(300))
    got = {r["doc_id"]: r for r in score_texts(with_clashes(documents(spark, texts, ids)), fold("doc_id", 5) != 1).collect()}
    n, want = _brute_base(ids, texts)
    for i in ids:
        r = got[i]
        assert (r["n_tokens"], r["n_known"]) == want[i][:2] and r["train_tokens"] == n
        assert abs(r["base_score"] - want[i][2]) < 1e-8
        assert r["held_out"] == (fold_of(i, 5) == 1) and r["score"] < 0
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.1 * sum(r["n_tokens"] for r in held)


def test_language_model_is_a_distribution():
    """The probabilities of all known words and the unknown ones sum to 1."""
    rng = np.random.default_rng(0)
    named = sorted({f"w{i}{'abcdefgh'[i % 8]}" for i in range(1500)})
    counts = rng.integers(1, 50, len(named)).astype(float)
    order = np.argsort(-counts, kind="stable")
    hot = [named[i].encode() for i in order]
    masses = np.full(maxent_lm.REST, 0.5)
    for w, c in zip(hot[maxent_lm.HEAD :], counts[order][maxent_lm.HEAD :], strict=True):
        masses[maxent_lm.rest_class(w.decode())] += c + 0.5
    v = maxent_lm.Vocabulary(tuple(hot), counts[order], int(counts.sum()), len(hot), masses)
    t = maxent_lm.Tables(v)
    by_class = rng.normal(size=(1 << maxent_lm.CLASS_BITS, maxent_lm.CLASSES)).astype(np.float32)
    by_word = rng.normal(size=(1 << maxent_lm.WORD_BITS, maxent_lm.WIDTH)).astype(np.float32)
    total = 0.0
    for code in range(len(hot)):
        total += math.exp(maxent_lm.log_probs(np.array([3, 800, code]), np.array([0]), t, by_class, by_word)[2])
    for j in range(maxent_lm.REST):  # the unknown word of each rest class
        total += math.exp(maxent_lm.log_probs(np.array([3, 800, len(hot) + j]), np.array([0]), t, by_class, by_word)[2]) * 0.5 / masses[j]
    assert abs(total - 1) < 1e-4


def test_language_model_edges(spark):
    docs = documents(spark, ["a b", "a b", None], [4, 4, None])
    got = score_texts(docs, F.lit(None).cast("boolean")).collect()  # nothing to learn from
    assert len(got) == 3 and all(r["base_score"] == 0 and r["train_tokens"] == 0 for r in got)
    assert score_texts(docs.limit(0), F.lit(True)).count() == 0
    alike = score_texts(docs, F.lit(True)).where("doc_id = 4").select("score", "base_score").distinct().count()
    assert alike == 1


def _vocabulary(n):
    hot = tuple(f"w{i}".encode() for i in range(n))
    masses = np.full(maxent_lm.REST, 0.5)
    for w in hot[maxent_lm.HEAD :]:
        masses[maxent_lm.rest_class(w.decode())] += 10.5
    return maxent_lm.Vocabulary(hot, np.full(n, 10.0), 10 * n, n, masses)


def test_language_model_tells_content_words_of_a_class_apart():
    """Histories favour single words beyond the head classes, not their class alone."""
    t = maxent_lm.Tables(_vocabulary(3000))
    same = [i for i in range(2000, 3000) if t.cls[i] == t.cls[2000]]
    x, y = same[0], same[-1]
    learner = maxent_lm.Learner(
        t, np.zeros((1 << maxent_lm.CLASS_BITS, maxent_lm.CLASSES), dtype=np.float32),
        np.zeros((1 << maxent_lm.WORD_BITS, maxent_lm.WIDTH), dtype=np.float32))
    for _ in range(50):
        learner.learn(np.array([1500, x] * 50), np.arange(0, 100, 2))
    px, py = (maxent_lm.log_probs(np.array([1500, w]), np.array([0]), t, *learner.weights)[1] for w in (x, y))
    assert px > py + 1


def test_language_model_sees_the_third_word_back():
    t = maxent_lm.Tables(_vocabulary(1000))
    a, b = (t.history(np.array([w, 7, 8, 9]), np.array([0]), 3, 4) for w in (5, 6))
    assert len(a) == 4 and (a != b).any()


def test_language_model_grows_with_the_training_texts():
    """More training tokens: a longer hot list by the same Zipfian law, more weight rows held."""
    lists, held = [], []
    for total in (20_000_000, 100_000_000):
        shares = total / 14 / np.arange(1, 1_000_000)
        n = int((shares * maxent_lm.HOT_WORDS >= maxent_lm.least_hot(total)).sum())
        t = maxent_lm.Tables(v := _vocabulary(n))
        learner = maxent_lm.Learner(t, *[
            np.zeros((rows, width), dtype=np.float32)
            for rows, width in zip(maxent_lm.sizes(v), (maxent_lm.CLASSES, maxent_lm.WIDTH), strict=True)])
        learner.learn(np.random.default_rng(0).integers(0, n, 40_000), np.array([0]))
        lists.append(n)
        held.append([int((x > 0).sum()) for x in learner.touched])
    assert lists[1] > 1.5 * lists[0]
    assert all(b > 1.3 * a for a, b in zip(*held, strict=True))


def test_language_model_scores_are_a_function_of_the_table(spark, monkeypatch):
    """File layout, partitions and shuffle settings do not change a score."""
    import random

    from airtrace.llm import maxent_lm

    monkeypatch.setattr(maxent_lm, "SHARD_TOKENS", 1000)
    monkeypatch.setattr(maxent_lm, "_PASS", 300)
    rnd = random.Random(2)
    texts = [" ".join(rnd.choices(["a", "b", "c", "dd", "ee", "word", f"w{i % 40}"], k=rnd.randint(0, 60))) for i in range(300)]
    docs = documents(spark, texts)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for files, parts in ((1, "8"), (7, "3")):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            given = docs.orderBy(F.rand(files)).repartition(files)
            out = maxent_lm.score_texts(given, F.col("doc_id") % 5 != 1)
            got.append({r["doc_id"]: r["score"] for r in out.collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert set(got[0]) == set(got[1]) and len(got[0]) == 300
    assert max(abs(got[0][i] - got[1][i]) for i in got[0]) < 1e-6
    assert maxent_lm.shards(10_500) == 10 and maxent_lm.shards(0) == 1


def test_language_model_splits_texts_as_plain_python(monkeypatch):
    monkeypatch.setattr(maxent_lm, "_TEXT_BYTES", 12)  # several goes
    texts = ["  Ab c\t", "", " \n ", "ÀÉ x\x85Y z\x1cq\xa0r", "one", "a  b\x0bC\x0cd\r\ne " * 3, " "]
    got = []
    for first, n, flat in maxent_lm.split_texts(pa.array(texts)):
        assert first == len(got)
        flat = flat.to_pylist()
        for k in n:
            got.append(flat[:k])
            flat = flat[k:]
        assert not flat
    assert got == [[w.decode() for w in t.encode().lower().split()] for t in texts]
    assert not list(maxent_lm.split_texts(pa.array([], pa.string())))


def test_language_model_update_equals_a_plain_one(monkeypatch):
    """Runs of one, some and many equal rows, over several cachefuls."""
    monkeypatch.setattr(maxent_lm, "_CACHED", 7)
    rng = np.random.default_rng(3)
    t = maxent_lm.Tables(_vocabulary(1000))
    start = rng.normal(size=(90, maxent_lm.CLASSES)).astype(np.float32)
    learner = maxent_lm.Learner(t, start, np.zeros((4, maxent_lm.WIDTH), dtype=np.float32))
    rows = np.minimum(rng.geometric(0.03, size=(maxent_lm._FEATURES, 200)), 89)
    rows[0, :20] = 5
    slope = rng.normal(size=(200, maxent_lm.CLASSES)).astype(np.float32)
    learner._update(0, rows, slope.copy())
    learner._count(0)
    weights, squares, touched = start.astype(np.float64), np.ones(90), np.zeros(90, dtype=int)
    for r in rows:
        for row in set(r.tolist()):
            g = slope[r == row].astype(np.float64).sum(axis=0)
            squares[row] += (g * g).sum() / maxent_lm.WIDTH
            weights[row] -= maxent_lm.RATE / math.sqrt(squares[row]) * g
            touched[row] += (r == row).sum()
    assert np.abs(learner.weights[0] - weights).max() < 1e-4
    assert np.abs(learner.squares[0] - squares).max() < 1e-3 and (learner.touched[0] == touched).all()


def test_language_model_tables_are_built_once_a_model():
    v = _vocabulary(50)
    model = maxent_lm.MaxEnt(v, np.zeros((4, maxent_lm.CLASSES)), np.zeros((4, maxent_lm.WIDTH)))
    assert model.tables is model.tables


def _plain_buckets(text):
    """Buckets of the 2- and 3-grams of letters and blanks, one by one."""
    wide = 1 << 64
    points = [ord(c) if c.isalpha() else 32 for c in f" {text.lower()}  "]
    for i in range(len(points) - 2):
        a, b, c = points[i : i + 3]
        pair = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F) % wide
        triple = (pair * 0x165667B19E3779F9 + c * 0x27D4EB2F165667C5) % wide
        for h, gram in ((pair, (a, b)), (triple, (a, b, c))):
            if set(gram) != {32}:
                yield ((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 % wide) >> (64 - langid.BUCKET_BITS)


def test_language_scores_equal_a_plain_bayes(spark):
    rng = random.Random(4)
    texts = [_text(rng, EN if i % 3 else DE, rng.randint(1, 12)) for i in range(60)] + ["", None, "12 !?", "Ünï 🙂 𝔘x"]
    langs = ["en" if i % 3 else "de" for i in range(60)] + ["en", None, "de", "de"]
    docs = documents(spark, texts, lang=langs)
    counts, n_docs = {"en": Counter(), "de": Counter()}, Counter()
    for text, lang in zip(texts, langs, strict=True):
        if text is not None and lang is not None:
            counts[lang].update(_plain_buckets(text))
            n_docs[lang] += 1
    size = 1 << langid.BUCKET_BITS
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(docs, fit(docs)).collect()}
    for i, text in enumerate(texts):
        if text is None or not any(c.isalpha() for c in text):
            assert got[i] == ("und", 0.0)
            continue
        sums = {
            lang: math.log(n_docs[lang] / sum(n_docs.values())) + sum(
                math.log((c[b] + langid.SMOOTHING) / (sum(c.values()) + langid.SMOOTHING * size))
                for b in _plain_buckets(text))
            for lang, c in counts.items()
        }
        best = max(sums.values())
        assert sums[got[i][0]] > best - 1e-2
        assert abs(got[i][1] - 1 / sum(math.exp(s - best) for s in sums.values())) < 1e-3


def test_quality_scores_equal_a_plain_loop(spark):
    import zstandard

    rng = random.Random(8)
    good = [_text(rng, EN, rng.randint(3, 200)) for _ in range(60)]
    bad = [" ".join(rng.choices("abcdefgh", k=rng.randint(3, 200))) for _ in range(60)]
    texts = good + bad + [None, "", "x" * 50_000]
    docs = documents(spark, texts)
    labels = _labels(spark, [(i, int(i < 60), 0) for i in range(120)])
    model = fit_quality(docs, labels, where=F.lit(True), dictionary_where=fold("_id", 5) != 4)
    got = {r["doc_id"]: r["score"] for r in score_quality(docs, model).collect()}

    def size(raw, dictionary):
        own = zstandard.ZstdCompressionDict(dictionary)
        return len(zstandard.ZstdCompressor(
            level=3, dict_data=own, write_content_size=False, write_dict_id=False).compress(raw))

    for i, text in enumerate(texts):
        raw = (text or "").encode()
        n = max(1, len(raw))
        apart = min(0.5, max(-0.5, (size(raw, model.bad) - size(raw, model.good)) / n))
        left = min(1.0, size(raw, model.good) / n)
        x = [20 * apart, 20 * min(apart, 0.02), 20 * min(apart, 0), 5 * left, 20 * min(left, 0.25),
             100 * min(left, 0.05), 2 * math.log1p(min(n, 1000)) / 7, 1.0]
        z = sum(a * b for a, b in zip(x, model.curve.tolist(), strict=True))
        assert abs(got[i] - 1 / (1 + math.exp(-min(30.0, max(-30.0, z))))) < 1e-9


def test_quality_dictionaries_see_all_of_long_texts(spark, monkeypatch):
    """Pieces over the whole length, also of texts that are all longer than one piece."""
    from airtrace.llm import quality

    monkeypatch.setattr(quality, "PIECE_CHARS", 200)
    rng = random.Random(3)
    seen = []
    plain = quality._dictionary
    monkeypatch.setattr(quality, "_dictionary", lambda samples: seen.append(samples) or plain(samples))
    texts = [_text(rng, EN if i % 2 else DE, 400) for i in range(30)]
    fit_quality(documents(spark, texts), _labels(spark, [(i, i % 2, 0) for i in range(30)]), where=F.lit(True))
    assert sorted("".join(sorted(s.decode() for s in seen[0]))) == sorted("".join(t for i, t in enumerate(texts) if i % 2))
    assert max(len(s.decode()) for s in seen[1]) <= 200


def _walk(debug, x):
    """Prediction of a tree from its printed form."""
    lines = [line for line in debug.splitlines()[1:] if line.strip()]
    depth = len(lines[0]) - len(lines[0].lstrip())
    i = 0
    while True:
        line = lines[i].strip()
        if line.startswith("Predict:"):
            return float(line.split(":")[1])
        feature, bound = line.split("(feature ")[1].rstrip(")").split(" <= ")
        depth = len(lines[i]) - len(lines[i].lstrip())
        if x[int(feature)] <= float(bound):
            i += 1
            continue
        i = next(j for j in range(i + 1, len(lines))
                 if lines[j].strip().startswith("Else") and len(lines[j]) - len(lines[j].lstrip()) == depth) + 1


def _plain_features(text, lexicon):
    """The features of a text, one after the other."""
    import re

    you = set("you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous"
              " votre vos ti tus usted ustedes vosotros su".split())
    words = re.findall(r"[^\W\d_]+", text.lower())
    whole = [lexicon.get(w, 0.0) for w in words]
    start = [max([0.0] + [lexicon.get(w[:k] + "^", 0.0) for k in (4, 5, 6) if len(w) > k]) for w in words]
    hits = [i for i in range(len(words)) if whole[i] or start[i]]
    near = sum(any(abs(i - j) <= 5 for j, w in enumerate(words) if w in you) for i in hits)
    n, raw = max(1, len(words)), text.encode()
    size = max(1, len(raw))
    mixed = [m for m in re.finditer(r"[^\W\d_][0-9@$*!|.]{1,4}[^\W\d_]", text)]
    read = 0
    for m in mixed:
        at, tokens = 0, text.split(" ")
        for token in tokens:
            if at <= m.start() < at + len(token) + 1:
                plain = token.strip(".,;:!?\n").translate(str.maketrans("013457@$!|", "oieastasil", "*.-_")).lower()
                read += bool(lexicon.get(plain, 0.0))
            at += len(token) + 1
    used = [v for v in whole if v]
    began = [v for v in start if v]
    signs = "\"#$%&'()*+,-./:;<=>@[\\]^_`{|}~"
    return [
        math.log1p(len(words)), len(used) / n, math.log1p(len(used)), max(used, default=0.0), len(began) / n,
        math.log1p(len(began)), max(began, default=0.0), near / max(1, len(hits)), sum(w in you for w in words) / n,
        sum(65 <= b <= 90 for b in raw) / size, len(re.findall(r"\b[^\W\d_a-z]{2,}\b", text)) / n,
        sum(chr(b) in "!?" for b in raw) / size, sum(b < 128 and chr(b) in signs for b in raw) / size,
        sum(48 <= b <= 57 for b in raw) / size, len(mixed) / n, math.log1p(read),
        len(re.findall(r"([^\W\d_])\1\1", text)) / n,
    ]


def test_toxicity_scores_equal_a_plain_walk_of_the_trees(spark):
    rng = random.Random(6)
    bad = ["grumblor", "snorfing", "vexnot"]
    texts, rows = [], []
    for i in range(240):
        toxic = i % 3 == 0
        words = rng.choices(EN, k=rng.randint(4, 30))
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice([*bad, "sn0rf1ng", "YOU"]))
        texts.append(" ".join(words))
        rows.append((i, 0, int(toxic)))
    texts += [None, "", "y0u gr.umblor!!! " * 40, "a1b" * 3000, "zzz 99"]
    docs = documents(spark, texts)
    model = fit_toxicity(docs, _labels(spark, rows))
    assert model.trees is not None and "grumblor" in model.lexicon
    got = {r["doc_id"]: r["score"] for r in score_toxicity(docs, model).collect()}
    bounds, values = list(model.curve.boundaries.toArray()), list(model.curve.predictions.toArray())
    trees = list(zip(model.trees.treeWeights, [t.toDebugString for t in model.trees.trees], strict=True))
    for i, text in enumerate(texts):
        x = _plain_features(text or "", model.lexicon)
        assert x == features(text or "", Lookup(model.lexicon))
        margin = sum(w * _walk(t, x) for w, t in trees)
        want = float(np.interp(margin, bounds, values))
        assert abs(got[i] - min(1.0, max(0.0, want))) < 1e-6
    # equal features, equal scores
    assert got[texts.index("")] == got[texts.index(None)]
