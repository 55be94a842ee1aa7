"""Steps that have to grow no faster than their input: what is shuffled, written and scored."""

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from evidentia.functions import segment
from evidentia.operators import catalogs
from evidentia.operators import graph as G
from evidentia.operators import names
from evidentia.operators import qa as Q
from evidentia.operators import retrieval as R
from evidentia.operators.index import Index
from evidentia.plans import modes
from evidentia.sources import listings


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_question_and_document_are_not_shuffled(spark, tmp_path):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c word"), F.col("id").cast("string")).alias("text"))
    asked = spark.createDataFrame([(1, "a b"), (2, "c word7 a")], "qid int, question string")
    direct, stored = R.bm25(docs, asked, 3), Index(spark, f"file://{tmp_path}/index").add(docs).bm25(asked, 3)
    for found in (direct, stored):
        assert not re.search(r"hashpartitioning\(qid#\d+, doc#", _plan(found))
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, stored.collect()))


def _counting(monkeypatch):
    rows = {}

    def written(df, name, keep=G.written):
        out = keep(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(G, "written", written)
    return rows


def _star(spark, places, people):
    """People and four makers of each place; a question about each maker."""
    fact = lambda who, kind, n: (f"f{who}", who, kind, "located_in", f"place{n}", "REGION", "s", "high" if len(who) % 2 else "low", "u")
    rows = [fact(f"person{i}", "PERSON", i % places) for i in range(people)] + [fact(f"maker{i}.", "ICH_PROJECT", i % places) for i in range(256)]
    facts = spark.createDataFrame(rows, "fact_id string, subject string, subject_type string, predicate string, object string, object_type string, evidence_source_id string, confidence string, evidence_url string")
    facts = facts.withColumns({"subject_name": F.col("subject"), "object_name": F.col("object")})
    names = facts.select(F.col("subject").alias("name"), F.col("subject_type").alias("type")).union(facts.select("object", "object_type")).distinct()
    entities = names.withColumn("aliases", F.array().cast("array<string>"))
    sources = spark.createDataFrame([], "source_id string, title string")
    questions = spark.range(256).select(F.col("id").alias("qid"), F.concat(F.lit("where is maker"), F.col("id").cast("string"), F.lit(". located")).alias("question"))
    return questions, entities, facts, sources


def test_questions_of_one_neighbourhood_share_words(spark, monkeypatch):
    questions, entities, facts, sources = _star(spark, 4, 400)
    rows = _counting(monkeypatch)
    found = G.khop(G.mentions(questions, entities), G.build_graph(entities, facts, sources)[1], 2)
    assert found.count() == 256 * (1 + 1 + 100 + 63)
    # A person or maker is reached by the 64 questions of its place: one word or two, not all four.
    assert rows["khop"] < 2 * (400 + 256) + 600


def test_hubs_pass_words_where_their_edges_lie(spark, tmp_path):
    """Edges are shuffled, not the words of all questions over each of them."""
    n, people = 2048, 6000
    edges = spark.range(n + people).select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("u"), F.concat(F.lit("place"), (F.col("id") % 2).cast("string")).alias("v"))
    seeds = spark.range(n).select(F.col("id").alias("qid"), F.concat(F.lit("x"), F.col("id").cast("string")).alias("node"))
    before = max((x.stageId() for x in _stages(spark)), default=-1)
    G.khop(seeds, edges, 2).write.parquet(f"file://{tmp_path}/found")
    # 16 words or more over each of 8,048 edges are 128,768 rows.
    assert 0 < sum(x.shuffleWriteBytes() for x in _stages(spark, before)) < 8_048 * 100
    odd = F.coalesce(F.expr("try_cast(substr(node, 2) as int)"), F.expr("cast(substr(node, 6) as int)")) % 2
    found = spark.read.parquet(f"file://{tmp_path}/found").groupBy("qid", "distance").agg(F.count("*").alias("n"), F.count_distinct("node").alias("nodes"), F.sum(odd).alias("odd")).collect()
    want = {(q, d): (c, c, c * (q % 2)) for q in range(n) for d, c in enumerate((1, 1, (n + people) // 2 - 1))}
    assert {(r.qid, r.distance): (r.n, r.nodes, r.odd) for r in found} == want


def test_graph_retrieval_scores_few_of_a_hub(spark, monkeypatch):
    questions, entities, facts, sources = _star(spark, 2, 2000)
    rows = _counting(monkeypatch)
    k = 3
    found = G.graph_retrieve(questions, entities, facts, sources, k, 1, {"located_in": ("where",)}).select("qid", "fact_id", "distance", "score", "rank").collect()
    assert max(rows.values()) < 256 * 100
    told = {r.fact_id: r for r in facts.collect()}
    for qid in (0, 7, 200):
        q = f"where is maker{qid}. located"
        own = {c for c in q if c.isalnum()}
        scored = []
        for f in told.values():
            if f.object != f"place{qid % 2}":
                continue
            d = 0 if f.subject == f"maker{qid}." else 1
            text = f"{f.subject} — located_in — {f.object}"
            score = min(1.0, 0.5 / (1 + d) + 0.3 * {"high": 1.0, "low": 0.4}[f.confidence] + 0.2 * len(own & set(text)) / len(own) + 0.2)
            scored.append((-round(score, 6), f.fact_id, d))
        want = [(f, d, -s, i) for i, (s, f, d) in enumerate(sorted(scored)[:k], 1)]
        assert sorted(((r.fact_id, r.distance, r.score, r["rank"]) for r in found if r.qid == qid), key=lambda r: r[3]) == want


def test_graph_retrieval_scores_texts_with_the_same_letters_as_one(spark, monkeypatch):
    questions, entities, facts, sources = _star(spark, 2, 4000)
    seen = []

    def ranked(df, *rest, keep=G.ranked):
        seen.append(df.count())
        return keep(df, *rest)

    monkeypatch.setattr(G, "ranked", ranked)
    found = G.graph_retrieve(questions, entities, facts, sources, 3, 1, {"located_in": ("where",)})
    assert found.count() == 256 * 3
    # Each place has 2,128 facts; a question puts few of them in order.
    assert max(seen) < 256 * 100
    told = spark.createDataFrame([("tea_9",), ("",), ("é9é",)], "text string").select(F.split("text", "").alias("chars"))
    letters = sorted({*map(chr, range(0x4E00, 0x4E64)), *"aet9_é"})
    own = F.array(*map(F.lit, ["t", "9", "é", "一"]))
    shared = told.select(G._marks("chars", letters).alias("a"), own.alias("own")).select("a", G._marks("own", letters).alias("b")).select(G._shared("a", "b"))
    assert [r[0] for r in shared.collect()] == [2, 0, 2]


def test_review_sample_limits_each_kind_before_its_rows_meet(spark):
    questions = spark.range(2000).select(F.concat(F.lit("q"), F.col("id").cast("string")).alias("question_id"), F.when(F.col("id") % 3 == 0, "multi_hop").otherwise("single_fact").alias("answer_type"))
    sample = Q.review_sample(questions, "r", 30)
    assert "WindowGroupLimit" in _plan(sample)
    assert {(r[0], r[1]) for r in sample.groupBy("answer_type").count().collect()} == {("single_fact", 18), ("multi_hop", 12)}


def test_pairs_of_blocks_meet_once_and_blocks_are_bounded(spark, monkeypatch):
    subjects = spark.range(60).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("s"), F.when(F.col("id") < 50, "A").otherwise("B").alias("type"))
    subjects = subjects.withColumn("h", F.sha2(F.concat_ws("\0", "type", "s"), 256))
    monkeypatch.setattr(Q, "BLOCK_SUBJECTS", 2)
    monkeypatch.setattr(Q, "MOST_BLOCKS", 4, raising=False)
    pairs = [tuple(r) for r in Q._pairs(subjects, 1.0).select("type", "l", "r").collect()]
    by = {(r.type, r.s): r.h for r in subjects.collect()}
    want = {(t, a, b) for t, a in by for u, b in by if t == u and by[t, a] < by[u, b]}
    assert len(pairs) == len(want) and set(pairs) == want
    # Ranges that begin or end with a subject's own block: no two blocks are compared twice.
    plan = Q._pairs(subjects, 1.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(block" in plan and "sequence(0, block" in plan


def test_a_pair_only_hashes_what_is_its_own(spark):
    rows = [(t, f"s{i}", hashlib.sha256(f"{t}\0s{i}".encode()).hexdigest()) for t in "AB" for i in range(60)]
    pairs = Q._pairs(spark.createDataFrame(rows, "type string, s string, h string"), 0.25)
    # The type and the left subject are joined once for a subject, not for each of its pairs.
    assert "concat_ws" not in _plan(pairs)
    want = {(t, a, b, o) for t, a, x in rows for u, b, y in rows if t == u and x < y and (o := hashlib.sha256(f"{t}\0{a}\0{b}".encode()).hexdigest()) < "4"}
    assert {tuple(r) for r in pairs.collect()} == want


def _pages(spark, n):
    return spark.range(0, n, 1, 1).select(F.col("id").alias("page"), F.concat(F.lit('<div class="page"><span class="total">共 2 条信息 / 共 3 页</span></div><a class="app-article-item" href="/content/'), F.col("id").cast("string"), F.lit('"><p class="app-article-title">t</p></a>')).alias("html"))


def test_pages_are_dealt_and_their_elements_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(listings, "ELEMENTS_AT_ONCE", 7, raising=False)
    pages = _pages(spark, 90)
    assert listings.elements(pages).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    found, totals = listings.search_candidates(pages, "http://h"), listings.county_totals(pages)
    assert "Broadcast" not in _plan(found) and "Broadcast" not in _plan(totals)
    assert found.count() == 90 and {tuple(r)[1:] for r in totals.collect()} == {(2, 3)}


def test_runs_are_cut_in_slices():
    assert list(segment._slices(["aa", "b", "cccc", "d"], 3)) == [["aa", "b"], ["cccc"], ["d"]]
    trie = segment.Trie([("ab", 1), ("a", 5), ("b", 5)], 9)
    runs = ["ab", "ba", "abab"]
    assert [t for part in segment._slices(runs, 4) for t in trie.segment(part)] == trie.segment(runs)


def test_catalog_facts_sort_one_row_of_equals_in_many_tasks(spark):
    rows = spark.range(0, 40, 1, 1).select(F.concat(F.lit("s"), (F.col("id") % 4).cast("string")).alias("s"), F.concat(F.lit("e"), F.col("id").cast("string")).alias("e"))
    found = catalogs._facts(rows, F.col("s"), [("p", F.lit("o"), "T", F.col("s"), "K", F.lit(True))], F.lit("src"), F.col("e"))
    assert {(r.subject, r.evidence_text) for r in found.collect()} == {("s0", "e0"), ("s1", "e1"), ("s2", "e10"), ("s3", "e11")}
    assert _plan(found).count("min_by(") <= 4 and "RoundRobin" in _plan(found)


def test_few_windows_pass_the_table_by_chance(spark):
    n = 1_000_000
    stored = spark.range(n).select(F.concat(F.lit("#"), (F.col("id") + 1_000_000).cast("string")).alias("name"))
    texts = spark.range(40).select(F.concat(F.lit("x#1000007 "), *(F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"-{i}")), 256) for i in range(20))).alias("text"))
    found = [r[0] for r in texts.select(names.finder(stored)(F.col("text"))).collect()]
    assert all("#1000007" in f for f in found)
    # A million names: of 1,283 windows a text one in sixteen finds its first bit by chance, few both.
    assert sum(map(len, found)) - 40 < 40 * 1283 * 0.01
    assert names.table_bits(0) == names.LEAST_BITS and names.table_bits(1 << 40) == names.MOST_BITS


def test_models_of_one_name_stay_apart(spark):
    texts = spark.createDataFrame([("ab",)], "text string").coalesce(1)
    for letters in ("ab", "abc"):
        load = lambda letters=letters: lambda rows: [[t.count(c) for c in letters] for t in rows]
        assert len(texts.select(R.encoder(load, "same")(F.col("text"))).first()[0]) == len(letters)


def test_a_vector_is_evaluated_once_however_often_it_is_used(spark):
    texts = spark.createDataFrame([("Tea on a sea",), ("",), (None,)], "text string")
    found = texts.select(modes.encode(F.col("text")).alias("v"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # One for each letter at most: not again for each element, nor for each use of the length.
    assert plan.count("lower(") == 1 and plan.count("replace(") == 8
    rows = [[round(x, 6) for x in r.v] for r in found.collect()]
    assert rows == [[round(n / 17**0.5, 6) for n in (3, 2, 0, 1, 1, 0, 1, 1)], [0.0] * 8, [0.0] * 8]


def _shuffled(spark):
    """Bytes shuffled so far."""
    store, jvm = spark._jsc.sc().statusStore(), spark._jvm
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def _stages(spark, after=-1):
    """The stages later than one. Spark forgets the oldest of a long session, so sums over all of them may shrink."""
    store, jvm = spark._jsc.sc().statusStore(), spark._jvm
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return [x for x in map(stages.apply, range(stages.size())) if x.stageId() > after]


def test_dense_search_shuffles_rows_not_pairs(spark, monkeypatch):
    monkeypatch.setattr("evidentia.operators.dense.LEAST_ROWS", 16)
    rng, took = np.random.default_rng(5), []
    for n in (1000, 4000):
        x = rng.normal(size=(n, 32)).astype(np.float32)
        vectors = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>")
        before = _shuffled(spark)
        found = R.dense(vectors, vectors.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("query")), 3).collect()
        took.append(_shuffled(spark) - before)
        assert len(found) == 3 * n and {r.id for r in found if r["rank"] == 1 and r.qid < 9} == {int((x.astype(float) @ x[i].astype(float)).argmax()) for i in range(9)}
    # Without clusters each block meets each query, and yet a vector is sent a few times only.
    assert 0 < took[1] < 6 * took[0] and took[1] < 4000 * 32 * 4 * 12


def test_equal_vectors_keep_the_least_ids(spark, monkeypatch):
    monkeypatch.setattr("evidentia.operators.dense.LEAST_ROWS", 16)
    vectors = spark.range(3000).select(F.format_string("v%04d", F.lit(2999) - F.col("id")).alias("vec_id"), F.array(F.lit(0.6), F.lit(0.8), F.when(F.col("id") < 2000, 0.1).otherwise(F.rand(1) * 0.09)).cast("array<float>").alias("embedding"))
    asked = spark.createDataFrame([(i, [1.0, 1.0, 1.0]) for i in range(300)], "qid int, query array<double>")
    found = R.dense(vectors, asked, 4).collect()
    assert len(found) == 1200 and {(r.id, r["rank"]) for r in found} == {(f"v{1000 + i}", i + 1) for i in range(4)}


def test_a_search_encodes_each_text_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("array<float>")
    def encode(texts: pd.Series) -> pd.Series:
        seen.add(len(texts))
        return texts.map(lambda t: [float(t.count(c)) for c in "123"] if t else None)

    texts = spark.range(300).select(F.col("id").alias("vec_id"), F.when(F.col("id") != 7, F.col("id").cast("string")).alias("text"))
    asked = spark.createDataFrame([(1, [1.0, 0.0, 0.0])], "qid int, query array<double>")
    found = R.dense(texts.select("vec_id", encode("text").alias("embedding")), asked, 3).collect()
    assert [(r.id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [(111, 3.0), (11, 2.0), (101, 2.0)]
    assert seen.value == 300
    letters = texts.select("vec_id", modes.encode(F.col("text")).alias("embedding"))
    assert R.dense(letters, spark.createDataFrame([(1, [1.0] * 8)], "qid int, query array<double>"), 2).count() == 2


def test_few_queries_meet_vectors_where_these_lie(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6000, 32)).astype(np.float32)
    x[4000:] = x[:2000]  # equal scores: the least ids count
    q = rng.normal(size=(40, 32))
    vectors = spark.createDataFrame([(f"v{i:04d}", v) for i, v in enumerate(x.tolist())], "vec_id string, embedding array<float>").repartition(7)
    asked = spark.createDataFrame(list(enumerate(q.tolist())), "qid int, query array<double>")
    vectors = spark.createDataFrame(vectors.collect(), vectors.schema)
    before = _shuffled(spark)
    found = {(r.qid, r["rank"]): (r.id, r.score) for r in R.dense(vectors, asked, 5).collect()}
    # 768,000 bytes of vectors stay where they are; each task's five best of a query are shuffled.
    assert _shuffled(spark) - before < 100_000
    scores = np.round(q @ x.astype(float).T, 6)
    for i in range(40):
        best = sorted(range(6000), key=lambda j: (-scores[i, j], j))[:5]
        assert [found[i, r] for r in range(1, 6)] == [(f"v{j:04d}", scores[i, j]) for j in best]
