"""Near copies and top-k search against brute force; classifiers by held-out accuracy on the test tables."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from shardstream.llm import jaccard, quality, topk, toxicity
from shardstream.llm.words import hashed_fold
from tables import changed, documents, prose

SF_DIR = "/root/testdata/sf0.01"


def shingles(text, k):
    words = (text or "").encode().lower().split()
    n = min(k, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute_groups(texts: dict, k: int, percent: int) -> dict:
    sets = {d: shingles(t, k) for d, t in texts.items()}
    group = {d: d for d in texts}

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    return {d: (len(sets[d]), root(d)) for d in ids}


def families(seed: int) -> list:
    made = random.Random(seed)
    texts = []
    for family in range(6):
        base = prose(seed * 100 + family, 90 + 20 * family)
        passage = prose(seed, 40)
        for _ in range(made.randint(1, 14)):
            text = changed(base, made.sample(range(80), made.choice([0, 1, 1, 2, 3, 5])))
            texts.append(text if made.random() < 0.7 else f"{text} {passage}")
    texts += ["one two three", "One two THREE", "one two", prose(7, 3000), changed(prose(7, 3000), list(range(0, 3000, 70))), None, ""]
    made.shuffle(texts)
    return texts


@pytest.mark.parametrize("rule, frequent", [(jaccard.Rule(4, 85), True), (jaccard.Rule(5, 80), False)])
def test_near_copies_are_brute_force(spark, monkeypatch, rule, frequent):
    if frequent:  # so that small tables too have tokens that come last in all orders
        monkeypatch.setattr(jaccard, "FREQUENT", 3)
    docs = documents(spark, families(rule.k))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_copies(docs, rule).collect()}
    assert got == brute_groups(texts, rule.k, rule.percent)
    assert len(set(got.values())) < len(got)


def test_order_never_loses_a_link():
    order, rule, made = jaccard.TokenOrder([5, 9, 1 << 40], [8, 900, 30]), jaccard.Rule(), np.random.default_rng(2)
    for _ in range(300):
        size = int(made.integers(1, 120))
        a = np.unique(np.concatenate([made.integers(0, 1 << 62, size).astype(np.uint64), np.array([5, 9], np.uint64)]))
        b = np.unique(np.concatenate([made.permutation(a)[: int(made.integers(1, len(a) + 1))], made.integers(0, 1 << 62, int(made.integers(0, 9))).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 85 * (len(a) + len(b) - common):
            for x, y in zip(order.prefixes(a, rule.prefix(len(a))), order.prefixes(b, rule.prefix(len(b)))):
                assert len(np.intersect1d(x, y))


def edited(made, reference: np.ndarray) -> np.ndarray:
    """Some tokens gone, some at one end, and some new ones; new ones are drawn from few, so that copies share them."""
    kept = reference[made.random(len(reference)) > made.choice([0, 0.02, 0.1, 0.2])]
    kept = kept[: int(len(kept) * made.choice([1, 1, 0.9, 0.7]))]
    return np.unique(np.append(kept, made.integers(1, 60, int(made.integers(0, 14))).astype(np.uint64)))


@pytest.mark.parametrize("rule", [jaccard.Rule(4, 85), jaccard.Rule(5, 80), jaccard.Rule(4, 60)])
def test_marks_never_lose_a_link(rule):
    """Linked sets of one family that are not both linked to its reference share marks on different sides, under every order."""
    made, order, seen = np.random.default_rng(3), jaccard.TokenOrder([5, 9, 17, 1 << 40], [8, 900, 30, 9]), [0, 0]
    for _ in range(1500):
        reference = np.unique(made.integers(40, 1 << 62, int(made.integers(20, 90))).astype(np.uint64))
        first = edited(made, reference)
        second = edited(made, first) if made.random() < 0.7 else edited(made, reference)
        sets, far, marks = (first, second), [], []
        for one in sets:
            common = len(np.intersect1d(one, reference))
            far.append(100 * common < rule.percent * (len(one) + len(reference) - common))
            marks.append(jaccard.marks_of(one, reference, common, 77, order, rule))
        common = len(np.intersect1d(*sets))
        if None in marks or not any(far) or 100 * common < rule.percent * (len(first) + len(second) - common) or common == len(first) == len(second):
            continue
        seen[all(far)] += 1
        met = set()
        for m in marks[0]:
            for n in marks[1]:
                reach = [x[c] for c in ("behind", "apart", "n") for x in (m, n)]
                if n["token"] == m["token"] and (m["side"] is None or m["side"] != n["side"]) and jaccard.within_reach(rule, *reach):
                    met.add(n["token"] & 3)
        assert met == set(range(jaccard.ORDERS))
    assert min(seen) > 20


@pytest.mark.parametrize("rule", [jaccard.Rule(4, 85), jaccard.Rule(5, 80)])
def test_a_large_family(spark, rule):
    """Copies of one text, most of which are linked to few others or to none, cut copies, and rows without an id."""
    made = random.Random(11)
    base = prose(50, 150, 3000)
    texts = [changed(base, made.sample(range(150), made.choice([0, 1, 2, 3, 3, 4, 5, 6, 8]))) for _ in range(220)]
    texts += [" ".join(changed(base, made.sample(range(100), made.choice([0, 2, 4]))).split(" ")[: made.choice([149, 130, 125, 118, 100])]) for _ in range(80)]
    docs = documents(spark, texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_copies(docs, rule).collect()}
    want = brute_groups({r["doc_id"]: r["text"] for r in docs.collect()}, rule.k, rule.percent)
    assert got == want and 5 < len({c for _, c in want.values()}) < 250
    lost = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")))
    sizes = sorted(tuple(r) for r in jaccard.near_copies(lost, rule).groupBy("component_id").count().collect() if r[0] is not None)
    group = defaultdict(list)
    for doc, (_, root) in want.items():
        group[root].append(doc)
    assert sizes == sorted((min(d for d in g if d % 3), len(g)) for g in group.values() if any(d % 3 for d in g))


def counted_candidates(monkeypatch) -> list[int]:
    counts, found = [], jaccard.candidates

    def counting(*args):
        pairs = jaccard.materialize(found(*args))
        counts.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard, "candidates", counting)
    return counts


@pytest.mark.parametrize("rule", [jaccard.Rule(4, 85), jaccard.Rule(5, 80)])
def test_candidates_of_a_family_do_not_grow_with_its_square(spark, monkeypatch, rule):
    """Every text lacks words of its own, so any reference lacks some that all the others have: what they share then says nothing."""
    made, words, counts = random.Random(21), prose(52, 150, 3000).split(" "), counted_candidates(monkeypatch)
    gone = [made.sample(range(150), made.choice([5, 6, 7])) for _ in range(120)]
    docs = documents(spark, [" ".join(w for i, w in enumerate(words) if i not in places) for places in gone])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_copies(docs, rule).collect()}
    assert got == brute_groups({r["doc_id"]: r["text"] for r in docs.collect()}, rule.k, rule.percent)
    assert counts[0] <= 8 * len(gone)


def test_sets_out_of_reach_are_no_candidates(spark, monkeypatch):
    counts, texts = counted_candidates(monkeypatch), []
    for i in range(80):
        texts += [prose(700 + i, 20, 3000), f"{prose(700 + i, 20, 3000)} {prose(900 + i, 60, 3000)}"]
    got = jaccard.near_copies(documents(spark, texts)).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got) and counts == [0]


def test_recentred_takes_the_middle(spark):
    middle = set(range(100))
    sets = {0: middle - set(range(20)) | {500, 501}, 1: middle - {30}}
    sets |= {i: middle - {40 + i, 60 + i} | {600 + i} for i in range(2, 14)}
    sets |= {50: {1, 2, 3, 4}, 51: {1, 2, 3, 5}}  # a small family stays as it is
    near = [(i, 50 if i > 50 else 0) for i in sets if i not in (0, 50)]
    rows = [(a, b, len(sets[a]), len(sets[b]), sorted(sets[a] ^ sets[b])) for a, b in near]
    members = spark.createDataFrame(rows, "a long, b long, size_a long, size_b long, diff array<long>")
    got = {r["a"]: (r["b"], r["size_a"], r["size_b"], sorted(r["diff"])) for r in jaccard.recentred(members).collect()}
    want = {a: (b, len(sets[a]), len(sets[b]), sorted(sets[a] ^ sets[b])) for a, b in [(i, 1) for i in (0, *range(2, 14))] + [(51, 50)]}
    assert got == want


def test_one_of_each_keeps_unrelated_texts(spark):
    a, x, y, z = prose(60, 80), prose(61, 80), prose(62, 80), prose(63, 80)
    rows = [(1, a), (2, changed(a, [70])), (2, x), (3, y), (3, z), (4, y), (4, y), (5, None), (5, ""), (5, ""), (None, a), (None, prose(64, 70)), (None, prose(64, 70)), (None, ""), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", None, None, 0.5, "x", 3, 1, 7, None) for i, t in rows], documents(spark).schema)
    kept = [(r["doc_id"], r["text"]) for r in jaccard.one_of_each(docs).collect()]
    want = [(1, a), (2, x), (3, y), (3, z), (5, None), (5, ""), (None, prose(64, 70)), (None, ""), (None, "")]
    assert sorted(kept, key=repr) == sorted(want, key=repr)


def test_near_copies_of_odd_rows(spark):
    docs = documents(spark)
    out = jaccard.near_copies(docs).collect()
    assert len(out) == docs.count()
    by = {r["doc_id"]: r["component_id"] for r in out if r["doc_id"] is not None}
    assert by[0] == 0 and by[1] == 1 and by[2] == 2 and by[5] == by[6] == by[7] == 5 and by[14] == by[15] == 14 and by[9] == by[13] == 9
    assert [r["component_id"] for r in out if r["doc_id"] is None] == [None, None]
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({v for v in by.values()}) and ids.count(None) == 2
    assert jaccard.near_copies(docs.limit(0)).count() == 0 and jaccard.one_of_each(docs.limit(0)).count() == 0


def test_components(spark):
    made = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(made.randrange(100, 160), made.randrange(100, 160)) for _ in range(50)]
    got = {r["node"]: r["root"] for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61))
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b), near[b].add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x), todo.append(x)
        assert got.get(node, node) == min(seen)


def test_top_k_is_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 150)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    monkeypatch.setattr(topk, "TASK_BLOCKS", 2)
    monkeypatch.setattr(topk, "LEAF", 16)
    made = np.random.default_rng(1)
    rows = [(i, [float(x) for x in made.normal(0, 0.3, 8)], 0) for i in range(500)]
    rows += [(500 + i, rows[i][1], 1) for i in range(40)]  # ties
    rows += [(600, None, 0), (620, [0.1, None], 0), (640, [float("nan")] * 8, 0), (660, [float("inf")] + [0.0] * 7, 0), (None, rows[0][1], 0), rows[3], (680, [1.0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    usable = {i: np.floor(np.array(v, np.float32).astype(np.float64) * 64).astype(np.int64) for i, v, _ in rows[:540]}
    want = []
    for q in (i for i in usable if i % 20 == 0):
        best = sorted(((-int(usable[q] @ v), i) for i, v in usable.items() if i != q))[:20]
        want += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    got = topk.top_k(table, F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = topk.top_k(table.filter("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert [(r["query_id"], r["rank"]) for r in few] == [(0, 1), (0, 2)]


def accuracy(spark, scores, label, folds, held_out):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = scores.join(labels, "doc_id").filter(hashed_fold("doc_id", folds) == held_out).select("score", F.col(label).alias("y")).collect()
    return sum((r["score"] >= 0.3) == (r["y"] == 1) for r in rows) / len(rows)


def tables(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")


def test_quality_on_held_out_rows(spark):
    docs, labels = tables(spark)
    assert accuracy(spark, quality.quality_scores(docs, labels), "quality", quality.FOLDS, quality.HELD_OUT) >= 0.95


def test_toxicity_on_held_out_rows(spark):
    docs, labels = tables(spark)
    assert accuracy(spark, toxicity.toxicity_scores(docs, labels), "toxic", toxicity.FOLDS, toxicity.HELD_OUT) >= 0.93


@pytest.mark.parametrize("score", [quality.quality_scores, toxicity.toxicity_scores])
def test_classifiers_take_odd_rows(spark, score):
    docs = documents(spark)
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(18)] + [(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = score(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    same = {r["score"] for r in out if r["doc_id"] in (5, 6)}
    assert len(same) == 1
    assert score(docs, labels.limit(0)).count() == docs.count()  # without labels
    assert score(docs.limit(0), labels).count() == 0
    assert quality.good_documents(docs, labels.limit(0)).count() == docs.count()


def test_grammar_reads_clauses():
    grammar = toxicity.Grammar({"zork": 2.0})

    def weight(text):
        return sum(grammar.clauses(text.encode()))

    assert weight("The clown") < weight("You clown") < weight("You zorkling")
    assert 0 < weight("he is not a clown") < weight("he is a clown")
    assert 0 < weight("she said he is a clown") < weight("he is a clown")
    assert weight("kill time") < weight("I will kill you")
    assert weight("you are kind. A moron") == weight("moron") and weight("you and me") == 0 and weight("") == 0


def test_random_indexing_counts_neighbours(spark):
    docs = documents(spark, ["aa bb aa", None, "cc"])
    sums, (places, signs) = quality.context_sums(docs), quality.index_vectors()
    memo = quality.Terms()
    (a, b, _), _ = memo.of(b"aa bb aa")
    want = np.zeros(quality.DIMENSIONS)
    want[places[b]] += 2 * signs[b]
    assert (sums[a] == want).all() and (sums[memo.of(b"cc")[0][0]] == 0).all()
