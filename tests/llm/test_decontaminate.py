import hashlib
import random
import re

from playstats.llm import decontaminate as d
from tests.llm.helpers import docs, rows_by_id, sentence


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(texts, items, n=10):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if (got := windows.get(tuple(w[i:i + size]))) is not None:
                    hit.update(range(i, i + size))
                    found.update(str(x) for x in got if x is not None)
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit)))
    return out


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def _tables():
    rng = random.Random(3)
    items = [(k, sentence(rng, rng.choice([12, 30]))) for k in range(8)]
    items += [(20, "Short item"), (21, "Ünï x1"), (22, None), (23, "  !!"), (24, items[0][1]), (100, items[1][1][:60]),
              (None, "nobody owns this one"), (25, "a a a a a a a a a a")]
    texts = [sentence(rng, 50) for _ in range(5)]
    for k in range(8):
        texts.append(sentence(rng, 9) + "\n-- " + items[k][1].upper().replace(" ", ", ") + "! " + sentence(rng, 7))
    texts += [items[2][1] + " " + items[2][1], items[3][1][4:], "short-item; SHORT ITEM", "ünï X1", "Ünï x1 Ünï X1",
              "", None, "nobody owns this one", "a " * 25, "\x00a\x7fa" * 6, "日本 テスト short item"]
    return texts, items


def test_equals_brute_force(spark):
    texts, items = _tables()
    for limit in (d.BROADCAST_BYTES,):
        got = rows_by_id(d.contamination_digest(d.contamination(docs(spark, texts), bench(spark, items))))
        for i, want in enumerate(brute(texts, items)):
            assert tuple(got[i][c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == want


def test_hits_alike_without_broadcast(spark):
    texts, items = _tables()
    windows = d.benchmark_windows(bench(spark, items))
    a, b = (sorted(map(str, d.window_hits(docs(spark, texts), windows, broadcast_bytes=n).drop("item_ids").collect()))
            for n in (d.BROADCAST_BYTES, 0))
    assert a == b and a


def test_spans_are_removed(spark):
    texts, items = _tables()
    df = docs(spark, texts)
    report = d.contamination(df, bench(spark, items))
    clean = d.remove_spans(df, report)
    assert clean.columns == df.columns
    cut, spans = rows_by_id(clean), rows_by_id(report)
    for i, text in enumerate(texts):
        hit = {k for s in spans[i]["spans"] for k in range(s["start"], s["stop"])}
        assert words(cut[i]["text"]) == [w for k, w in enumerate(words(text)) if k not in hit]
        if not hit:
            assert cut[i]["text"] == text


def test_spans_of_null_and_repeated_ids_are_removed(spark):
    items = [(1, "one two three"), (2, "four five six")]
    texts = ["A one two three b", "A one two three b", "c Four, five six", "clean", "x one two three y", None, "one two three " * 3000 + "z"]
    df = docs(spark, texts, [5, 5, 5, 5, None, None, None])
    clean = d.remove_spans(df, d.contamination(df, bench(spark, items)))
    assert sorted((str(r.doc_id), str(r.text)) for r in clean.collect()) == sorted(
        [("5", "A b"), ("5", "A b"), ("5", "c "), ("5", "clean"), ("None", "x y"), ("None", "None"), ("None", "z")])


def test_no_words_are_shuffled_with_every_place(spark):
    items = bench(spark, [(1, " ".join(f"w{k}" for k in range(14)))])
    df = docs(spark, ["a " * 20 + " ".join(f"w{k}" for k in range(14)), "b c"])
    plan = d.window_hits(df, d.benchmark_windows(items), broadcast_bytes=0)._jdf.queryExecution().optimizedPlan().toString()
    probe = plan[plan.index("inline"):]
    lines = [x for x in probe.splitlines() if "posexplode" in x or "explode" in x]
    assert lines and all("words" not in x.split("[")[-1] for x in lines)     # what leaves the probe: place and hash


def test_repeated_null_ids_and_empty_tables(spark):
    items = [(1, "one two three")]
    df = docs(spark, ["one two three", "zzz", "one two three", "x one two three", None], [5, 5, 5, None, None])
    df = df.selectExpr("*", "1 as n_hit", "'q' as h", "2 as at", "3 as words")
    got = sorted((str(r.doc_id), r.n_words, r.n_hit) for r in
                 d.contamination_digest(d.contamination(df, bench(spark, items))).collect())
    assert got == [("5", 1, 0), ("5", 3, 3), ("5", 3, 3), ("None", 0, 0), ("None", 4, 3)]
    assert d.contamination_digest(d.contamination(docs(spark, []), bench(spark, items))).count() == 0
    none = d.contamination_digest(d.contamination(docs(spark, ["a b"]), bench(spark, []))).collect()
    assert [(r.n_hit, r.n_items, r.items_sha256) for r in none] == [(0, 0, hashlib.sha256(b"").hexdigest())]
