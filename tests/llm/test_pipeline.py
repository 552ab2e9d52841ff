import random

import corpus_pipeline
from playstats.llm import queries
from tests.llm.helpers import SCHEMA, brute_components, sentence, shingles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _folder(spark, tmp_path, rows, labels, items):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_keep_and_drop(spark, tmp_path):
    rng = random.Random(11)
    item = sentence(rng, 15)
    texts = [sentence(rng, 40) for _ in range(120)]
    texts += [" ".join(w + "***" for w in sentence(rng, 30).split()) for _ in range(40)]
    bad = set(range(120, 160))
    texts += [texts[0], texts[1] + " more", "x " + item + " y " + sentence(rng, 20), "", None, "123 ..."]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)] + [(7, texts[7], "en", "s", 9)]
    labels = [(i, int(i not in bad), 0) for i in range(160)]
    sf = _folder(spark, tmp_path, rows, labels, [(1, item), (2, None)])
    docs, ids = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        path = f"{tmp_path}/stage{k}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        ids[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
        if name != "bpe":
            assert docs.columns == COLUMNS
    everything = sorted(r[0] for r in rows)
    assert ids["language"] == [i for i in everything if i not in (163, 164, 165)]
    assert ids["quality"] == [i for i in ids["language"] if i not in bad]
    parts = brute_components({i: shingles(texts[i]) for i in set(ids["quality"])})
    assert ids["near_dedup"] == sorted(i for i in parts if parts[i] == i)
    assert ids["decontamination"] == [i for i in ids["near_dedup"] if i != 162]
    assert ids["bpe"] == ids["decontamination"]
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf).collect()) == ids["bpe"]


def test_empty_documents(spark, tmp_path):
    sf = _folder(spark, tmp_path, [], [], [])
    out = queries.pipeline(spark, sf)
    assert out.count() == 0 and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_verdicts_stay_on_their_row(spark, tmp_path):
    """Null and repeated ids with a good and a bad text in every stage."""
    rng = random.Random(12)
    item = sentence(rng, 15)
    texts = [sentence(rng, 40) for _ in range(120)]
    texts += [" ".join(w + "***" for w in sentence(rng, 30).split()) for _ in range(40)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    labels = [(i, int(i < 120), 0) for i in range(160)]
    sf = _folder(spark, tmp_path, rows, labels, [(1, item)])

    def left(name, pairs):
        more = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in pairs], SCHEMA)
        docs = spark.read.parquet(f"{sf}/documents.parquet").unionByName(more)
        out = dict(corpus_pipeline.STAGES)[name](spark, docs, sf)
        assert out.columns == COLUMNS
        ids = {i for i, _ in pairs}
        return sorted([r.text or "" for r in out.collect() if r.doc_id in ids])

    good, other = sentence(rng, 40), sentence(rng, 40)
    for i in (None, 500):
        assert left("language", [(i, good), (i, "123 ..."), (i, None), (i, good)]) == [good, good]
        bad = " ".join(w + "***" for w in other.split())
        assert left("quality", [(i, good), (i, bad), (i, good)]) == [good, good]
        passage = other + " " + item
        assert left("decontamination", [(i, good), (i, passage), (i, good), (i, None)]) == ["", good, good]
        # one row of each component: of the copies of text 3 the one with the smallest id, 3
        near = [good, good + " more"]
        got = left("near_dedup", [(i, good), (i, near[1]), (i, good), (i, texts[3]), (i, texts[3] + " more"), (i, other)])
        assert len(got) == 2 and other in got and set(got) & set(near)


def test_clashing_names_survivors_and_long_texts(spark, tmp_path):
    rng = random.Random(14)
    item = sentence(rng, 15)
    texts = [sentence(rng, 40) for _ in range(60)] + [" ".join(w + "***" for w in sentence(rng, 30).split()) for _ in range(20)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    sf = _folder(spark, tmp_path, rows, [(i, int(i < 60), 0) for i in range(80)], [(1, item)])
    long = sentence(rng, 30_000)
    more = [(100, texts[5] + " b", "en", "b", 1), (100, texts[5] + " b", None, "a", 1), (101, long, "en", "s", None),
            (102, long + " tail", "en", "s", 7), (103, sentence(rng, 20_000) + " " + item, "en", "s", 7)]
    docs = spark.createDataFrame([r for r in rows if r[0] != 5] + more, SCHEMA)
    docs = docs.selectExpr("*", "doc_id as _key", "'x' as row", "1 as digest", "2 as node", "3 as key", "map(1, 2) as _one")
    out = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, docs, sf)
        assert got.columns == docs.columns
        out[name] = got.filter("doc_id >= 100").collect()
        assert all(r._key == r.doc_id and r.row == "x" and r._one == {1: 2} for r in out[name])
    assert sorted(r.doc_id for r in out["language"]) == [100, 100, 101, 102, 103]
    assert sorted((r.doc_id, r.source) for r in out["near_dedup"]) == [(100, "b"), (101, "s"), (103, "s")]  # "en" comes before null
    assert sorted(r.doc_id for r in out["decontamination"]) == [100, 100, 101, 102]
