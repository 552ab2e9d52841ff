import hashlib
import random

from pyspark.sql import functions as F

from playstats.llm import fingerprints as f
from tests.llm.helpers import docs, rows_by_id, sentence, shingles


def _pairs(texts):
    for i, text in enumerate(texts):
        text, follow = text or "", texts[(i + 1) % len(texts)] or ""
        half = len(text) // 2
        yield text, text[:len(text) - half] + follow[:half], follow


def _jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_against_exact_sets(spark):
    rng = random.Random(2)
    texts = [sentence(rng, rng.choice([2, 4, 5, 30, 90])) for _ in range(40)]
    texts += [texts[-1]] * 3 + ["", None, "é", "日本語 テスト 😀 a b c d", "a", "A", " \t "]
    texts += [sentence(rng, 900), sentence(rng, 900)]
    texts.append(texts[-1])
    got = rows_by_id(f.fingerprint_digest(f.fingerprint_pairs(docs(spark, texts))))
    assert len(got) == len(texts)
    by_text = {}
    for i, (text, edited, follow) in enumerate(_pairs(texts)):
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        for near, other in ((r["near_edited"], edited), (r["near_next"], follow)):
            small = len(shingles(text) | shingles(other)) <= f.K
            assert abs(near - _jaccard(text, other)) < (1e-9 if small else 0.2)
    assert len({v for v in by_text.values()}) >= len({shingles(t) for t in texts})


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(4)
    parts = [sentence(rng, 1500, 10**6) for _ in range(3)]
    sk = f.sketches(docs(spark, parts))
    whole = f.merged_by(sk.withColumn("g", F.lit(1)), "g").first()["sketch"]
    union = set().union(*map(shingles, parts))
    frame = spark.createDataFrame([(whole,)], "s array<bigint>")
    n = frame.select(f.distinct_shingles(F.col("s"))).first()[0]
    assert len(whole) == f.K and abs(n / len(union) - 1) < 0.35
    part = sk.filter("doc_id = 0").first()["sketch"]
    c, r = spark.createDataFrame([(part, whole)], "a array<bigint>, b array<bigint>").select(
        f.containment(F.col("a"), F.col("b")), f.resemblance(F.col("a"), F.col("b"))).first()
    assert c > 0.7 and abs(r - len(shingles(parts[0])) / len(union)) < 0.15


def test_repeated_null_ids_one_row_and_empty(spark):
    t = "a b c d e f"
    df = docs(spark, [t, t, "z", "y", None], [3, 3, 3, None, None]).selectExpr("*", "1 as text_hash", "2 as own", "3 as kid", "4 as head")
    out = f.fingerprint_digest(f.fingerprint_pairs(df))
    assert sorted((str(r.doc_id), r.n_chars) for r in out.collect()) == [
        ("3", 1), ("3", 11), ("None", 0), ("None", 1)]
    one = f.fingerprint_digest(f.fingerprint_pairs(docs(spark, [t]))).collect()
    assert [(r.near_edited <= 1.0, r.near_next) for r in one] == [(True, 1.0)]
    assert f.fingerprint_digest(f.fingerprint_pairs(docs(spark, []))).count() == 0


def test_repeated_rows_are_one_before_the_joins(spark):
    df = docs(spark, ["a b c"] * 5 + ["d e f"] * 4 + ["g"], [1] * 5 + [2] * 4 + [None])
    assert f.fingerprint_pairs(df).count() == 3
