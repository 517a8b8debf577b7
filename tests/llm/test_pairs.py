"""Searches and joins against brute force, with copies, ties and odd rows."""

import numpy as np
import pytest

import corpus_pipeline
from pacegrid.llm import chosen_path, pivot_search, queries, stages, subspace_join
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, vector string, cell int"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) == ""


def vectors(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.15 * draw.normal(size=8)).tolist(), i % 2) for i in range(240)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(60)]  # copies
    rows += [(2000, None, 1), (2001, [1.0, None], 1), (2002, [float("nan")] * 8, 1), (2003, [0.0] * 8, 1), (2004, rows[0][1], None)]
    rows += [(2005, [], 1), (2006, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1), (None, rows[0][1], 0), (5, rows[5][1], 1)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)


def test_near_vectors_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(subspace_join, "CHUNK_ROWS", 16)  # several chunks, so several tiles
    frame = vectors(spark)
    held = {}
    for r in frame.collect():
        ok = r.embedding and r.label is not None and all(x is not None and np.isfinite(x) for x in r.embedding) and any(r.embedding)
        if r.vec_id is not None:
            held[r.vec_id] = (r.label, np.array(r.embedding, float)) if ok else None
    links = {i: set() for i in held}
    for i, a in held.items():
        for j, b in held.items():
            if i != j and a and b and a[0] == b[0] and len(a[1]) == len(b[1]):
                if a[1] @ b[1] / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.93:
                    links[i].add(j)
    smallest = {i: i for i in links}
    changed = True
    while changed:
        reached = {i: min([smallest[i], *(smallest[j] for j in links[i])]) for i in links}
        changed, smallest = reached != smallest, reached
    found = {r.vec_id: r for r in subspace_join.near_duplicates(frame).collect()}
    assert found.pop(None).n_links == 0
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in found.items()} == {i: (len(links[i]), smallest[i], smallest[i] == i) for i in links}
    assert subspace_join.near_duplicates(frame.limit(0)).isEmpty()


def test_top_k_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(pivot_search, "CHUNK_ROWS", 16)
    monkeypatch.setattr(pivot_search, "BLOCK_QUERIES", 8)
    frame = vectors(spark)
    rows = []
    for r in frame.collect():
        if r.vec_id is not None and r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding):
            rows.append((r.vec_id, np.floor(1024 * np.pad(np.array(r.embedding, float), (0, 8 - len(r.embedding)))).astype(int)))
    expected = set()
    for q, v in {q: min((v.tolist() for p, v in rows if p == q)) for q, _ in rows if q % 7 == 0}.items():
        best = sorted((-int(np.dot(v, w)), i) for i, w in rows if i != q)[:10]
        expected |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    found = pivot_search.top_k(frame, lambda v: v % 7 == 0, pivots=4, rings=3, sample_rows=64).collect()
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)
    assert pivot_search.top_k(frame.limit(0), lambda v: v % 7 == 0).isEmpty()
    assert pivot_search.top_k(frame.limit(4), lambda v: v == 0).count() == 3


def test_large_components_are_multiplied_exactly():
    rows = np.array([[2**32, 3], [-(2**32), 5], [7, -9]], np.int64)
    found = pivot_search.best_k(rows[2:], np.array([9]), rows[:2], np.array([1, 2]), 2, np.array([-np.inf]))
    assert found == [(0, 1, 7 * 2**32 - 27), (0, 2, -7 * 2**32 - 45)]
    big = pivot_search.best_k(np.array([[2**31 - 1, 1]]), np.array([9]), np.array([[2**31 - 3, 1]]), np.array([1]), 1, np.array([-np.inf]))
    assert big == [(0, 1, (2**31 - 1) * (2**31 - 3) + 1)]


def test_a_row_that_is_there_very_often(spark, monkeypatch):
    monkeypatch.setattr(pivot_search, "CHUNK_ROWS", 8)
    rows = [(1, [1.0, 2.0])] * 60 + [(i, [float(i), 1.0]) for i in range(2, 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    found = pivot_search.top_k(frame, lambda v: v == 4, pivots=2, rings=2, sample_rows=20).collect()
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"])][:5] == [8, 7, 6, 5, 3]
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"])][5:] in ([2, 1, 1, 1, 1], [1, 1, 1, 1, 2], [1, 1, 1, 1, 1])


def shingled(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute_classes(docs):
    sets = {i: shingled(t) for i, t in docs}
    links = {i: {j for j in sets if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])} for i in sets}
    smallest = {i: i for i in links}
    while True:
        reached = {i: min([smallest[i], *(smallest[j] for j in links[i])]) for i in links}
        if reached == smallest:
            return {i: (len(links[i]), smallest[i]) for i in links}
        smallest = reached


def test_jaccard_join_with_hot_groups(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(chosen_path, "BUCKET_ROWS", 8)
    monkeypatch.setattr(chosen_path, "CHUNK_ROWS", 16)
    draw = np.random.default_rng(5)
    word = lambda: f"w{draw.integers(5000)}"
    base, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    docs = []
    for i in range(150):  # one group of near copies, of which some are copies
        text = list(base)
        for place in draw.integers(0, 120, i % 4):
            text[place] = word()
        docs.append((i, " ".join(text)))
    docs += [(500 + i, " ".join(passage + [word() for _ in range(80)])) for i in range(120)]  # one shared passage
    docs += [(900, None), (901, ""), (902, " \t"), (903, "Two words"), (904, "two  WORDS")]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, path string, n long")
    found = {r.doc_id: (r.n_links, r.component_id) for r in chosen_path.jaccard_join(frame).collect()}
    assert found == brute_classes(docs)
    kept = {r.doc_id for r in chosen_path.first_of_each(frame).collect()}
    assert kept == {i for i, (_, c) in brute_classes(docs).items() if i == c}
    odd = chosen_path.jaccard_join(odd_docs)
    assert odd.count() == odd_docs.select("doc_id").distinct().count() and chosen_path.jaccard_join(no_docs).isEmpty()


def test_jaccard_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = {r.doc_id: (r.n_links, r.component_id) for r in queries.QUERIES["op9_chosen_path"](spark, SF).collect()}
    assert found == brute_classes(docs)


def test_runs_reach_the_recall_with_shared_minima():
    draw = np.random.default_rng(8)
    runs, coordinates = chosen_path.runs_for(0.9999, 0.8), chosen_path.COORDINATES
    equal = draw.binomial(coordinates, 0.8, 400_000)
    p, share = np.ones(len(equal)), equal / coordinates
    for _ in range(chosen_path.DEPTH):  # two distinct coordinates: both, one or none agree
        both, none = share * (equal - 1) / (coordinates - 1), (1 - share) * (coordinates - equal - 1) / (coordinates - 1)
        p = both * (1 - (1 - p) ** 2) + (1 - both - none) * p
    assert np.mean((1 - p) ** runs) + np.mean(share < 0.8 - chosen_path.MARGIN) <= 1e-4


def test_components_of_chains_and_rings(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100 + i, 100 + (i + 1) % 9) for i in range(9)] + [(7, 7), (300, 200), (300, 200)]
    found = dict(map(tuple, stages.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(9)}, 200: 200, 300: 200}
    assert stages.components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_pipeline_stages(spark):
    """Each stage against what its own operator says of its own input, by brute force where there is one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, held = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs, _ = stages.staged(stage(spark, docs, SF), name)
        held[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before, after = held["quality"]
    assert after.join(labels, "doc_id").where("quality = 0").count() <= 1
    good = before.join(labels.where("quality = 1"), "doc_id")
    assert good.join(after, "doc_id", "left_anti").count() <= 0.02 * good.count()
    before, after = held["language"]
    assert before.subtract(after).count() <= 0.02 * before.count()
    before, after = held["near_duplicates"]
    classes = brute_classes([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in classes.items() if i == c}
    before, after = held["personal_data"]
    assert after.count() == before.count() and after.where("text rlike '@[a-z0-9]+[.]example'").isEmpty()
    before, after = held["packing"]
    assert after.select("doc_id").distinct().count() == before.count()
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(whole.collect()) == sorted(after.collect())


def test_first_of_each_decides_by_row(spark):
    base, other, third = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    near, close = base + " more", third + " more"
    rows = [(1, base, "x"), (1, base, "x"), (2, base, "x"), (2, other, "x"), (3, near, "x"), (3, other + " more", "y"), (4, "one of its own", "b"), (4, "one of its own", "a")]
    rows += [(5, third, "x"), (5, close, "x"), (6, None, "x"), (6, None, "x"), (6, "", "x"), (7, "", "x"), (None, base, "x"), (None, base, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark string")
    found = [tuple(r) for r in chosen_path.first_of_each(docs).collect()]
    expected = [(1, base, "x"), (2, other, "x"), (4, "one of its own", "a"), (6, None, "x"), (6, "", "x"), (7, "", "x"), (None, base, "x"), (None, base, "x")]
    assert sorted((r for r in found if r[0] != 5), key=str) == sorted(expected, key=str)
    assert [r[1] in (third, close) for r in found if r[0] == 5] == [True]


def test_odd_docs_through_every_stage(spark, odd_docs):
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, odd_docs, SF)
        if name == "packing":
            assert {r.doc_id for r in after.collect()} == {i for i, _ in texts}
            continue
        assert after.columns == odd_docs.columns
        held = [(r.doc_id, r.text) for r in after.collect()]
        if name == "near_duplicates":
            assert sorted(held, key=str) == sorted(set(texts), key=str)
        else:
            assert len(held) == len(texts) if name == "personal_data" else len(held) <= len(texts)
