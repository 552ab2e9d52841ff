import math
import os
import random
import zlib
from collections import Counter
from urllib.parse import urlparse

import numpy as np
import pytest

from playstats.llm import language_id, lm_score, quality
from tests.llm.helpers import docs, rows_by_id

SYLLABLES = {"xa": ["ba", "du", "ki", "mo"], "yb": ["gré", "çou", "lent", "ais"], "zc": ["stru", "ßen", "och", "ver"]}


def words(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def lang_table(spark, n=240, seed=1):
    rng = random.Random(seed)
    rows = [(i, words(lang, rng.randint(3, 60), rng), lang) for i in range(n) for lang in [rng.choice(list(SYLLABLES))]]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_languages_of_held_out_rows(spark):
    df = lang_table(spark)
    truth = {r.doc_id: r.lang for r in df.collect()}
    got = rows_by_id(language_id.held_out_predictions(df))
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (i in set(held)) for i in truth)
    assert np.mean([got[i]["lang_pred"] == truth[i] for i in held]) > 0.97
    # held-out labels are not looked at
    other = df.selectExpr("doc_id", "text", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 'q' else lang end lang")
    assert rows_by_id(language_id.held_out_predictions(other)) == got


def test_mixtures_and_edges(spark):
    rng = random.Random(8)
    model = language_id.learn(lang_table(spark))
    mixed = words("xa", 60, rng) + " " + words("zc", 30, rng)
    df = docs(spark, [mixed, words("yb", 50, rng), "", None, "123 !! 4", words("yb", 50, rng).upper(), "日本", "xx " * 5000],
              [1, 2, 3, 4, 5, 6, 7, None]).selectExpr("*", "0 as score", "'x' as lang_pred")
    got = rows_by_id(language_id.predict(df, model))
    shares = {m["lang"]: m["share"] for m in got[1]["mixture"]}
    assert set(shares) == {"xa", "zc"} and abs(shares["xa"] - 2 / 3) < 0.1
    assert got[2]["lang_pred"] == got[6]["lang_pred"] == "yb" and len(got[2]["mixture"]) == 1
    for i in (3, 4, 5):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["mixture"]) == ("und", 0.0, [])
    assert 0 <= got[7]["score"] <= 1 and None in got
    nothing = docs(spark, ["abc"]).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert language_id.held_out_predictions(nothing).first().lang_pred == "und"
    assert language_id.held_out_predictions(docs(spark, [])).count() == 0


def test_mixture_raises_the_likelihood():
    rng = np.random.default_rng(0)
    logs = np.log(rng.dirichlet([1, 1, 1], size=500))
    shares, best = language_id.mixture(logs)
    assert abs(shares.sum() - 1) < 1e-9
    for _ in range(50):
        other = rng.dirichlet([1, 1, 1])
        assert np.log(np.exp(logs) @ other).sum() <= best + 0.5


def quality_tables(spark, n=1000):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.75
        text = words("xa", 40, rng)
        if not good:
            text = rng.choice([" ".join(w + "***" for w in text.split()), (text.split()[0] + " ") * 40,
                               text.upper() + "!!"])
        rows.append((i, text, "s", "s", 0))
        if rng.random() < 0.8:
            labels.append((i, int(good), 0))
    return (spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_quality_of_held_out_rows(spark):
    df, labels = quality_tables(spark)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = rows_by_id(quality.quality_scores(df, labels, per_class=200))
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(got) == 1000 and all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())
    flipped = labels.selectExpr(
        "doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end quality")
    assert rows_by_id(quality.quality_scores(df, flipped, per_class=200)) == got


def test_quality_edges(spark):
    df, labels = quality_tables(spark, 60)
    odd = docs(spark, ["", None, "x", "y" * 100_000, "x", "퟿日本"], [1, 2, 3, 4, 3, None]).selectExpr(
        "*", "1 as quality", "2 as score", "3 as label", "4 as at")
    got = quality.score(odd, quality.learn(df, labels, per_class=20)).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    dirty = labels.unionByName(labels.selectExpr("doc_id", "1 quality", "0 toxic")).unionByName(
        labels.selectExpr("cast(null as bigint) doc_id", "cast(null as int) quality", "0 toxic"))
    assert quality.quality_scores(df, dirty, per_class=20).count() == 60
    assert {r.score for r in quality.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(docs(spark, []), labels).count() == 0


def brute_scores(texts, target, n_words, prior, matched=False):
    low = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split() for t in texts]
    counts = Counter(w for ws in low for w in ws)
    vocab = {w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:n_words]}
    toks = [[w if w in vocab else w.encode()[-1:] for w in ws] for ws in low]
    size = len(vocab) + 256

    def model(rows, prior=prior):
        pair, single, ctx = Counter(), Counter(), Counter()
        for ts in rows:
            for c, w in zip([None, *ts], ts):
                pair[c, w] += 1
                single[w] += 1
                ctx[c] += 1
        total = sum(single.values())
        return lambda c, w: -math.log((pair[c, w] + prior * (single[w] + 1) / (total + size)) / (ctx[c] + prior))

    inside = [t for t, flag in zip(toks, target) if flag]
    ratio = sum(map(len, toks)) / sum(map(len, inside)) if matched else 1.0
    a, b = model(inside), model(toks, prior * ratio)
    out = []
    for ts in toks:
        ce = [sum(m(c, w) for c, w in zip([None, *ts], ts)) / max(1, len(ts)) for m in (a, b)]
        out.append((len(ts), ce[0], ce[1], ce[0] - ce[1]))
    return out


def test_lm_scores_equal_brute_force(spark):
    rng = random.Random(6)
    texts = [words(rng.choice(["xa", "zc"]), rng.randint(0, 40), rng) for _ in range(40)]
    texts += ["", None, "***!! A*** b!!", "ONE one", "é"]
    target = [("ba" in (t or "")) for t in texts]
    ids = spark.createDataFrame([(i,) for i, f in enumerate(target) if f] + [(None,), (0,), (0,)], "doc_id bigint")
    target[0] = True
    df = docs(spark, texts).selectExpr("*", "1 as target", "2 as cell", "3 as word")
    got = rows_by_id(lm_score.cross_entropy_difference(df, ids, words=20, prior=5.0))
    for i, want in enumerate(brute_scores(texts, target, 20, 5.0)):
        assert np.allclose([got[i][c] for c in ("n_tokens", "ce_target", "ce_background", "score")], want, atol=1e-9)


def test_lm_edges(spark):
    none = spark.createDataFrame([], "doc_id bigint")
    df = docs(spark, ["a b", "a b", None], [1, 1, None])
    rows = lm_score.cross_entropy_difference(df, none).collect()
    assert sorted(r.n_tokens for r in rows) == [0, 2, 2]
    assert lm_score.cross_entropy_difference(docs(spark, []), none).count() == 0


def test_lm_whole_vocabulary_equals_brute_force(spark):
    rng = random.Random(16)
    texts = [words(rng.choice(["xa", "zc"]), rng.randint(0, 40), rng) for _ in range(40)]
    texts += ["", None, "***!! A*** b!!", "ONE one", "é", "ba qa", "ba ra", "ba qa"]
    target = [i % 3 == 0 for i in range(len(texts))]
    ids = spark.createDataFrame([(i,) for i, f in enumerate(target) if f] + [(None,), (0,), (0,)], "doc_id bigint")
    got = rows_by_id(lm_score.cross_entropy_difference(docs(spark, texts), ids, words=None, prior=5.0))
    for i, want in enumerate(brute_scores(texts, target, 10 ** 9, 5.0, matched=True)):
        assert np.allclose([got[i][c] for c in ("n_tokens", "ce_target", "ce_background", "score")], want, atol=1e-9)
    # many chunks and buckets
    small = rows_by_id(lm_score.cross_entropy_difference(docs(spark, texts).repartition(3), ids, words=None, prior=5.0,
                                                         chunk=300, bucket=200))
    for i in got:
        for c in ("n_tokens", "ce_target", "ce_background", "score"):
            assert abs(got[i][c] - small[i][c]) < 1e-9
    # words with equal last bytes keep their identity, which a capped vocabulary takes from them
    assert got[45]["score"] != got[46]["score"] and got[45]["score"] == got[47]["score"]
    few = docs(spark, ["a b", "a b", "c", None], [1, 1, None, None])
    rows = lm_score.cross_entropy_difference(few, ids.limit(0), words=None).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(0, 0), (0, 1), (1, 2), (1, 2)]
    assert lm_score.cross_entropy_difference(docs(spark, []), ids, words=None).count() == 0


def test_lm_counts_above_a_byte(spark):
    texts = ["a b " * 700, "a " * 1000 + "c", "b a " * 128, "a"]
    ids = spark.createDataFrame([(0,), (2,)], "doc_id bigint")
    got = rows_by_id(lm_score.cross_entropy_difference(docs(spark, texts), ids, words=None, prior=5.0))
    for i, want in enumerate(brute_scores(texts, [True, False, True, False], 10 ** 9, 5.0, matched=True)):
        assert np.allclose([got[i][c] for c in ("n_tokens", "ce_target", "ce_background", "score")], want, atol=1e-9)


def test_lm_stores_less_than_the_texts(spark, monkeypatch):
    """The tables that are stored on the way, in bytes of the texts."""
    rng, sizes, stored = random.Random(44), [], lm_score.stored

    def measured(df, label):
        out = stored(df, label)
        sizes.extend(os.path.getsize(urlparse(f).path) for f in out.inputFiles())
        return out

    monkeypatch.setattr(lm_score, "stored", measured)
    texts = [" ".join(words(rng.choice(["xa", "zc"]), 1, rng) + str(int(rng.paretovariate(0.5)) % 9000) for _ in range(150))
             for _ in range(600)]
    ids = spark.createDataFrame([(i,) for i in range(0, 600, 3)], "doc_id bigint")
    lm_score.cross_entropy_difference(docs(spark, texts).repartition(2), ids, words=None, chunk=1 << 18, bucket=1 << 18)
    assert 0 < sum(sizes) < 0.55 * sum(map(len, texts))


def test_lm_keys_and_counts_travel_unchanged():
    rng = np.random.default_rng(45)
    keys = np.unique(rng.integers(0, 2 ** 64, 5000, np.uint64))
    steps, none = lm_score._spread(lm_score._squeeze([np.diff(keys, prepend=np.uint64(0)), keys[:0]]), [len(keys), 0], "<u8")
    assert np.array_equal(np.cumsum(steps, dtype=np.uint64), keys) and len(none) == 0
    counts = [rng.integers(0, top, 300).astype("<u4") for top in (2, 300, 2 ** 32)]
    value = lm_score._squeeze(counts)
    assert all(map(np.array_equal, lm_score._spread(value, [300] * 3, "<u4"), counts))
    assert len(value) < 300 * (1 + 2 + 4) + 40


def test_quality_sample_holds_an_id_once(spark):
    df, labels = quality_tables(spark, 200)
    drawn = next(r.doc_id for r in labels.orderBy("doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 5)
    hot = df.filter(df.doc_id == drawn).crossJoin(spark.range(300)).drop("id")
    once, often = quality.learn(df, labels, per_class=20), quality.learn(df.unionByName(hot), labels, per_class=20)
    every = quality.learn(df.unionByName(hot), labels, per_class=200)
    assert np.array_equal(once[0], often[0]) and once[1] == often[1]
    assert np.array_equal(every[0], quality.learn(df, labels, per_class=200)[0])


def test_fit_parts_languages_from_noise(spark):
    rng = random.Random(21)
    df = lang_table(spark)
    model = language_id.learn(df)
    good = [r.fit for r in language_id.predict(lang_table(spark, 150, seed=2), model).collect()]
    assert min(good) > language_id.LEAST_FIT
    noise = ["".join(rng.choice("qwjxzvpfhkyäöüñ") for _ in range(rng.randint(4, 9))) for _ in range(400)]
    texts = [" ".join(noise[k:k + 8]) for k in range(0, 400, 8)] + ["日本語 の テキスト です", "Привет мир как дела"]
    bad = [r.fit for r in language_id.predict(docs(spark, texts), model).collect()]
    assert max(bad) < language_id.LEAST_FIT
    empty = language_id.predict(docs(spark, ["", None, "12 ..."]), model).collect()
    assert [r.fit for r in empty] == [0.0] * 3
    long = language_id.predict(docs(spark, [words("xa", 60_000, rng)]), model).first()
    assert long.lang_pred == "xa" and long.fit > 0.8


def test_predictions_equal_a_plain_mixture(spark):
    """Against plain Python: counts, expectation-maximisation, and the best language set by
    trying all of them on a table with two languages."""
    df = lang_table(spark, 40).filter("lang <> 'zc'")
    model = language_id.learn(df)
    counts = {lang: Counter() for lang in model.languages}
    for r in df.collect():
        counts[r.lang].update(language_id.grams(r.text)[0].ravel().tolist())
    total = {lang: sum(c.values()) for lang, c in counts.items()}

    def log(lang, bucket):
        return math.log((counts[lang][bucket] + 0.5) / (total[lang] + 0.5 * language_id.BUCKETS))

    rng = random.Random(31)
    texts = [words("xa", 6, rng) + " " + words("yb", k, rng) for k in (0, 1, 4, 20)]
    got = rows_by_id(language_id.predict(docs(spark, texts), model))
    for i, text in enumerate(texts):
        buckets, first = language_id.grams(text)
        edges = [*first.tolist(), len(buckets)]
        like = [[sum(log(lang, b) for b in buckets[s:e].ravel().tolist()) for lang in model.languages]
                for s, e in zip(edges, edges[1:])]
        share, best = [0.5, 0.5], None
        for _ in range(200):
            parts = []
            for row in like:
                top = max(row)
                w = [p * math.exp(x - top) for p, x in zip(share, row)]
                parts.append([x / sum(w) for x in w])
            share = [sum(p[k] for p in parts) / len(parts) for k in (0, 1)]
        both = sum(max(r) + math.log(sum(p * math.exp(x - max(r)) for p, x in zip(share, r))) for r in like)
        single = [sum(r[k] for r in like) for k in (0, 1)]
        cost = language_id.PENALTY * math.log(len(like) + 1) + language_id.SHARE_COST * len(like)
        if both - max(single) > cost:
            best = max((0, 1), key=lambda k: share[k])
            assert abs(got[i]["score"] - share[best]) < 0.02
        else:
            best = max((0, 1), key=lambda k: single[k])
            assert got[i]["score"] == 1.0
        assert got[i]["lang_pred"] == model.languages[best]


def test_a_column_of_no_languages_is_refused(spark):
    df = spark.createDataFrame([(i, "some words", f"x{i}") for i in range(30)], "doc_id bigint, text string, lang string")
    with pytest.raises(ValueError):
        language_id.learn(df, most=20)


def plain_softmax(net, bag):
    """Probabilities of both classes, number by number."""
    at, share = bag
    vector = [sum(float(s) * float(net.table[b][d]) for b, s in zip(at, share)) for d in range(quality.DIM)]
    logits = [sum(vector[d] * float(net.layer[d][c]) for d in range(quality.DIM)) + float(net.bias[c]) for c in (0, 1)]
    e = [math.exp(x - max(logits)) for x in logits]
    return [x / sum(e) for x in e]


def test_quality_step_is_the_gradient(spark):
    """One step of the classifier against difference quotients of the weighted log loss."""
    rng = np.random.default_rng(3)
    bag, label, weight, rate, h = (np.array([0, 5, 40_000]), np.array([0.5, 0.3, 0.2], np.float32)), 1, 0.7, 0.5, 1e-3
    net = quality.Classifier()
    net.table, net.layer = net.table.astype(float), rng.normal(size=(quality.DIM, 2))
    net.bias = np.array([0.2, -0.1])

    def loss():
        return -weight * math.log(plain_softmax(net, bag)[label])

    def slope(array, *at):
        kept, ends = array[at], []
        for d in (h, -h):
            array[at] = kept + d
            ends.append(loss())
        array[at] = kept
        return (ends[0] - ends[1]) / (2 * h)

    places = [(b, d) for b in (0, 5, 40_000, 7) for d in range(quality.DIM)]
    table = {p: net.table[p] - rate * slope(net.table, *p) for p in places}
    layer = {(d, c): net.layer[d, c] - rate * slope(net.layer, d, c) for d in range(quality.DIM) for c in (0, 1)}
    bias = [net.bias[c] - 0.1 * rate * slope(net.bias, c) for c in (0, 1)]
    net.fit([bag], np.array([label]), np.array([weight]), epochs=1, rate=rate)
    assert all(abs(net.table[p] - v) < 1e-5 for p, v in table.items())
    assert all(abs(net.layer[p] - v) < 1e-5 for p, v in layer.items())
    assert np.allclose(net.bias, bias, atol=1e-5)


def test_quality_score_is_the_softmax(spark):
    """The collapsed table scores as the whole network does, feature by feature."""
    net = quality.Classifier()
    rng = np.random.default_rng(5)
    net.layer, net.bias = rng.normal(size=(quality.DIM, 2)), np.array([0.3, 0.1])
    texts = ["", "one", "Two words", "a b c a b c", "é日本 ßen", "z" * 5000, None]
    got = rows_by_id(quality.score(docs(spark, texts), net.collapsed()))
    for i, text in enumerate(texts):
        found = quality.features([text or ""])[0]
        n_words, n = len((text or "").split()), len(text or "")
        assert len(found) == 1 + n_words + max(0, n_words - 1) + max(0, n - 2) + max(0, n - 3)
        bag = (found, np.full(len(found), 1 / len(found)))
        assert abs(got[i]["score"] - plain_softmax(net, bag)[1]) < 1e-6
