"""Toxicity: the index against brute force, held-out quality."""

import zlib
from collections import Counter

import numpy as np

from triagelake.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def test_index_equals_brute_force():
    rng = np.random.default_rng(4)
    terms, rows = 50, []
    for _ in range(700):
        t = np.sort(rng.choice(terms, rng.integers(0, 9), replace=False))
        rows.append((t, rng.integers(1, 4, len(t)) / 4.0))
    index = toxicity.BlockMaxIndex.build(rows, terms, block=16)
    dense = np.zeros((700, terms))
    for i, (t, w) in enumerate(rows):
        dense[i, t] = w
    for _ in range(200):
        t = np.sort(rng.choice(terms, rng.integers(0, 6), replace=False))
        q = rng.integers(1, 4, len(t)) / 4.0
        full = dense[:, t] @ q
        best = [i for i in np.lexsort((np.arange(700), -full)) if full[i] > 0][:10]
        found, scores = index.top(t, q, 10)
        assert found.tolist() == best and np.allclose(scores, full[best])


def test_terms_of_texts():
    import pyarrow as pa
    known = pa.array(["bad", "wors*", "worse", "über"])
    texts = ["Bad, bad (worse)", "", "a-bad/worse ÜBER!", "badly b4d worst"]
    docs, terms, n = toxicity.counted(pa.array(texts), known)
    want = [(i, k, c) for i, t in enumerate(texts) for k, c in sorted(Counter(known.to_pylist().index(x) for x in toxicity.terms_of(t) if x in known.to_pylist()).items())]
    assert list(zip(docs.tolist(), terms.tolist(), n.tolist(), strict=True)) == want and (3, 1, 1) in want


def test_held_out_quality(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.op3_toxicity(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in labels]
    toxic = [p for y, p in held if y]
    clean = [p for y, p in held if not y]
    assert np.mean(toxic) >= 0.8 and np.mean(clean) <= 0.05, (np.mean(toxic), np.mean(clean), len(toxic), len(clean))


def test_edges(spark):
    rows = [(i, f"awful word{chr(97 + i % 5)} text" if i % 2 else f"kind word{chr(97 + i % 5)} text {'abcdefgh'[i % 8]}", i % 2) for i in range(120)]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t, _ in rows] + [(None, "awful", 1.0), (500, None, 1.0), (501, "", 1.0), (3, "awful", 0.0)],
                                 "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if not y or i % 3] + [(None, 1), (7, None), (5, 1)], "doc_id long, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == 124
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[None][0]["predicted"] == 1 and by[500][0]["score"] == by[501][0]["score"] < 0.5
    assert all(by[i][0]["predicted"] == i % 2 for i in range(120) if i != 3)
    none = toxicity.classify(docs, labels.limit(0)).collect()
    assert len(none) == 124 and all(0 <= r["score"] <= 1 for r in none)
    assert toxicity.classify(docs.limit(0), labels).count() == 0


def brute_force(docs, labels, model, k):
    """Every text's nearest examples by full cosines of plain dictionaries, and its votes, from the same split."""
    import math
    bags = {i: Counter(toxicity.TERM.findall((t or "").lower())) for i, t in docs}
    df = Counter(t for bag in bags.values() for t in bag)
    n = len(docs)
    idf = {t: math.log((1 + n) / (1 + c)) + 1 for t, c in df.items()}

    def vector(bag):
        v = {t: (1 + math.log(c)) * idf[t] for t, c in bag.items()}
        size = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {t: x / size for t, x in v.items()}

    examples = [vector(bags[i]) for i in model.example_ids]
    weight = dict(zip(model.example_ids, model.weight, strict=True))
    logit = lambda p: math.log(p / (1 - p))
    small = model.weight.min()
    word, out = {}, {}
    for t in {t for v in examples for t in v}:
        own = [(v[t] * weight[i], labels[i]) for i, v in zip(model.example_ids, examples, strict=True) if t in v]
        share = (sum(w * y for w, y in own) + 0.2 * small * model.prior) / (sum(w for w, _ in own) + 0.2 * small)
        word[t] = logit(share) - logit(model.prior)
    for i, bag in bags.items():
        v = vector(bag)
        cosines = [sum(x * e.get(t, 0.0) for t, x in v.items()) for e in examples]
        best = sorted((j for j, c in enumerate(cosines) if c > 0), key=lambda j: (-round(cosines[j], 12), j))[:k]
        own = sorted((word[t] for t in bag if t in word), reverse=True)
        if not own:
            out[i] = model.nothing, []
            continue
        pull = [(cosines[j] / cosines[best[0]] * model.weight[j], labels[model.example_ids[j]]) for j in best]
        share = (sum(w * y for w, y in pull) + model.doubt * model.prior) / (sum(w for w, _ in pull) + model.doubt)
        top = sorted([*own, 0.0, 0.0, 0.0], reverse=True)[:3]
        root = math.sqrt(len(own))
        x = [logit(share) - logit(model.prior), *top, sum(max(w, 0) for w in own) / root, sum(min(w, 0) for w in own) / root, math.log1p(len(own)), 1.0]
        out[i] = 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.coefficients, strict=True)))), [model.example_ids[j] for j in best]
    return out


def test_whole_scores_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    words = [f"{a}{b}{c}" for a in ("ba", "ko", "li", "mur") for b in ("na", "te", "so", "ri") for c in ("", "d", "ster")]
    rows, labels = [], {}
    for i in range(260):
        text = [words[j] for j in rng.zipf(1.4, rng.integers(0, 40)) % len(words)]
        if i % 4 == 0:
            text.insert(0, ("vile", "nasty")[i % 8 // 4])
        rows.append((f"d{i}", " ".join(text)))
        if i % 5:
            labels[f"d{i}"] = int(i % 4 == 0)
    docs = spark.createDataFrame(rows, "doc_id string, text string")  # ids of any type
    known = spark.createDataFrame(list(labels.items()), "doc_id string, toxic int")
    model = toxicity.fit(docs, known, k=9)
    assert set(model.toxic) == {0.0, 1.0} and not np.allclose(model.coefficients[1:7], 0)
    want = brute_force(rows, labels, model, 9)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    for i, (chance, near) in want.items():
        assert abs(got[i]["score"] - chance) < 1e-9
        assert got[i]["evidence"] == near
    assert all(got[i]["evidence"] for i, t in rows if t)


def test_shards_of_one_label_and_long_texts(spark):
    rows = [(i, f"word{i} common text") for i in range(20)] + [(20, "common " * 200_000), (21, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = toxicity.classify(docs, spark.createDataFrame([(i, 0) for i in range(20)], "doc_id long, toxic int")).collect()
    assert len(one) == 22 and all(0 <= r["score"] < 0.5 for r in one)
