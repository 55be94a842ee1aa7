"""Scenarios with known outcomes for the operators, and properties on random input."""

import hashlib
import json
import os
import random
import re
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from evidentia.functions import ids, urls
from evidentia.functions import segment as S
from evidentia.functions import text as T
from evidentia.operators import audit as A
from evidentia.operators import chunking as C
from evidentia.operators import entities as E
from evidentia.operators import graph as G
from evidentia.operators import merge as M
from evidentia.operators import names as N
from evidentia.operators import policy as P
from evidentia.operators import qa as Q
from evidentia.operators import retrieval as R
from evidentia.operators.index import Index
from evidentia.sources import html, jsonl, release

FACT = "fact_id string, subject string, subject_type string, predicate string, object string, object_type string, evidence_source_id string, evidence_text string, verified boolean, confidence string, manual_checked boolean, notes string"


def fact(spark, *rows):
    base = dict(subject_type="ICH_PROJECT", object_type="REGION", evidence_source_id="s1", evidence_text="e", verified=True, confidence="high", manual_checked=False, notes="")
    out = []
    for i, r in enumerate(rows):
        r = {"fact_id": f"f{i}"} | base | r
        out.append(tuple(r[c.split()[0]] for c in FACT.split(", ")))
    return spark.createDataFrame(out, FACT)


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def sha(*parts, n=12, sep="\0"):
    return hashlib.sha256(sep.join(parts).encode()).hexdigest()[:n]


def test_ids(spark):
    lit = F.lit
    assert one(spark, ids.entity_id(lit("REGION"), lit("西宁市"))) == "ent_" + sha("REGION", "西宁市")
    assert one(spark, ids.chunk_id(lit("d"), lit(3), lit(9), lit("𠀀"))) == "chk_" + sha("d", "3", "9", "𠀀")
    assert one(spark, ids.synthetic_document_id(lit("a"), lit("b"))) == "doc_synthetic_" + sha("a", "b", sep="")
    for key in ("x", "塔尔寺", "a\0b"):
        for n in (2, 3, 7):
            assert one(spark, ids.template_variant(lit(key), n)) == int(hashlib.sha256(key.encode()).hexdigest(), 16) % n
    row = dict(question_id="q", question="问", answer="a", answer_type="t", evidence_fact_ids=["f"], evidence_source_ids=[], required_entities=["é"], difficulty="easy", unanswerable=False)
    df = spark.createDataFrame([tuple(row.values())], "question_id string, question string, answer string, answer_type string, evidence_fact_ids array<string>, evidence_source_ids array<string>, required_entities array<string>, difficulty string, unanswerable boolean")
    assert df.select(ids.qa_sha256()).first()[0] == hashlib.sha256(json.dumps(row, ensure_ascii=False, sort_keys=True).encode()).hexdigest()


def test_normalisation_is_not_idempotent(spark):
    name = lambda x: one(spark, T.entity_name(F.lit(x)))
    assert name("格萨尔") == "格萨（斯）尔"
    assert name("格萨（斯）尔") == "格萨(斯)尔"
    assert name(" 青 海　") == "青海省" and name("堆绣。") == "湟中堆绣" and name("ＡＢ()") == "AB"


def test_urls(spark):
    canon = lambda u: one(spark, urls.canonical_url(F.lit(u)))
    assert canon("https://www.ihchina.cn/project_details/12.html?b=2&a=1#x") == "ihchina.cn/project_details/12?a=1&b=2"
    assert canon("http://Example.org/a//") == "example.org/a" and canon("http://example.org") == "example.org/"
    assert canon("https://example.org/x?q=%E5%A1%94&p=") == "example.org/x?p=&q=%E5%A1%94"
    assert one(spark, urls.in_domains(F.lit("a.b.org"), ["b.org"])) and not one(spark, urls.in_domains(F.lit("ab.org"), ["b.org"]))


def test_policy_order(spark):
    config = {"excluded_domains": ["bad.org"], "restricted_domains": ["r.org"], "government_domains": ["gov.cn"], "strong_restriction_phrases": ["禁止", "不得"], "defaults": {}}
    decide = lambda *a: tuple(one(spark, P.decide(*map(F.lit, a), config)))[:3]
    assert decide("http://x.bad.org", "禁止", "open", "full_text_allowed") == ("forbidden", "exclude", False)
    assert decide("http://gov.cn", "不得转载", "open", "government_public") == ("restricted", "metadata_and_facts_only", False)
    assert decide("http://www.gov.cn", "", "", "government_public") == ("government_public", "government_public", True)
    assert decide("http://o.org", "", "open", "full_text_allowed") == ("open", "full_text_allowed", True)
    assert decide("http://o.org", "", "", "local_only") == ("unclear", "local_only", False)


def test_chunk_invariants():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("甲乙丙。！\n ；ab") for _ in range(rng.randint(0, 300)))
        size = rng.randint(2, 60)
        overlap = rng.randint(0, size - 1)
        bare, found = text.strip(), list(C.spans(text, size, overlap))
        assert all(bare[a:z] == t and 0 < len(t) <= size for a, z, t in found)
        starts = [a for a, _, _ in found]
        assert starts == sorted(starts)
        covered = {i for a, z, _ in found for i in range(a, z)}
        assert all(i in covered for i, c in enumerate(bare) if not c.isspace())
    found = list(C.spans("".join(f"第{i}句话很短。" for i in range(80)) + "尾" * 200, 120, 20))
    assert len(found) <= 12 and found[-1][1] == len("".join(f"第{i}句话很短。" for i in range(80)) + "尾" * 200)
    with pytest.raises(ValueError):
        list(C.spans("a", 5, 5))


def test_closed_sources_give_no_open_chunks(spark):
    docs = spark.createDataFrame([("d1", "a", "text"), ("d2", "b", "西宁市的非遗。"), ("d3", "zz", "text")], "doc_id string, source_id string, text string")
    sources = spark.createDataFrame([("a", "local_only", True, [], []), ("b", "full_text_allowed", True, ["t"], ["r"])], "source_id string, release_policy string, raw_text_release boolean, topic array<string>, region array<string>")
    names = spark.createDataFrame([("西宁市", "REGION", ["西宁"])], "name string, type string, aliases array<string>")
    rows = C.open_chunks(docs, sources, names).collect()
    assert [(r.source_id, r.topic_labels, r.region_labels) for r in rows] == [("b", ["t", "非遗"], ["r", "西宁市"])]


def test_names_of_any_table_are_found(spark):
    rng = random.Random(9)
    word = lambda a, z: "".join(rng.choice("ab山é😀") for _ in range(rng.randrange(a, z)))
    texts = [word(0, 60) for _ in range(80)] + ["", None, "aaaa" * 50]
    spelled = sorted({word(1, 6) for _ in range(60)} | {"aaaa", "x" * 300})
    find = N.finder(spark.createDataFrame([(n,) for n in [*spelled, "", None]], "name string"))
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", find(F.col("t")).alias("hits")).collect()
    for i, hits in rows:
        assert sorted(h for h in hits if h in spelled) == [n for n in spelled if n in (texts[i] or "")] and all(h in texts[i] for h in hits)
    nothing = N.finder(spark.createDataFrame([], "name string"))
    assert spark.createDataFrame([("abc",)], "t string").select(nothing(F.col("t"))).first()[0] == []


def test_labels_by_brute_force(spark):
    rng = random.Random(4)
    kinds = ("REGION", "CATEGORY", "X")
    entities = [("".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))), kinds[k % 3], ["".join(rng.choice("abc") for _ in range(3))] * (k % 2) + [""] * (k % 5 == 0)) for k in range(30)]
    chunks = [(k, "".join(rng.choice("abcd ") for _ in range(rng.randrange(0, 40))) + ("博物馆" if k % 7 == 0 else "")) for k in range(40)] + [(3, "abc"), (3, "abc")]
    out = C.infer_labels(spark.createDataFrame(chunks, "id int, text string"), spark.createDataFrame(entities, "name string, type string, aliases array<string>")).collect()

    def slow(text):
        hit = [e for e in entities if any(n and n in text for n in (e[0], *e[2]))]
        of = lambda kind: {e[0] for e in hit if e[1] == kind}
        return sorted(of("CATEGORY") | ({"博物馆"} if "博物馆" in text else set())), sorted(of("REGION")), sorted({e[0] for e in hit})

    assert sorted((r.id, r.text, r.topics, r.regions, r.entity_mentions) for r in out) == sorted((i, t, *slow(t)) for i, t in chunks)


def test_segments_are_cheapest_paths(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("山水日月") for _ in range(rng.choice((1, 2, 2, 3, 4, 6)))): rng.randrange(1, 40) for _ in range(40)}
    cost = {w: round(1000 * f) for w, f in words.items()}
    single = 90_000
    runs = ["", "山"] + ["".join(rng.choice("山水日月木") for _ in range(rng.randrange(1, 14))) for _ in range(60)]

    def brute(run):
        @lru_cache(None)
        def best(i):
            if i == len(run):
                return 0, ()
            found = [(cost.get(run[i:j], single if j == i + 1 else None), j) for j in range(i + 1, len(run) + 1)]
            return min(((c + best(j)[0], (j, *best(j)[1])) for c, j in found if c is not None), key=lambda x: (x[0], -x[1][0]))

        out, at = [], 0
        for to in best(0)[1]:
            w = run[at:to]
            out += [w[i : i + g] for g in (2, 3) if len(w) > g for i in range(len(w) - g + 1) if w[i : i + g] in cost]
            out.append(w)
            at = to
        return out

    assert S.Trie(cost.items(), single).segment(runs) == [brute(r) for r in runs]
    assert S.Trie([], 7).segment(["山水"]) == [["山", "水"]]
    texts = spark.createDataFrame([("山水 abc日月",)] * 6 + [(None,), ("",)], "text string")
    learned = S.learn_dictionary(texts, spark.createDataFrame([("金木X",), (None,)], "name string"), least=5, cohesion=2)
    assert {r.word: r.freq for r in learned.collect()} == {"山": 6, "水": 6, "日": 6, "月": 6, "山水": 6, "日月": 6, "金木": 5}
    assert [r[0] for r in texts.distinct().select(S.segmenter(learned)(F.col("text"))).collect() if r[0]] == [["山水", "abc", "日月"]]


def test_bm25_ranking(spark):
    docs = spark.createDataFrame([("c1", "塔尔寺酥油花"), ("c2", "青海湖"), ("c3", "the lake"), ("c4", None)], "id string, text string")
    ask = spark.createDataFrame([("q1", "酥油花"), ("q2", " "), ("q3", "nothing here")], "qid string, question string")
    words = S.segmenter(spark.createDataFrame([("塔尔寺", 5), ("酥油花", 5), ("青海湖", 5)], "word string, freq long"))
    rows = R.bm25(docs, ask, 3, id_col="id", tokens=words).collect()
    assert {(r.qid, r.doc) for r in rows if r["rank"] == 1} == {("q1", "c1")} and all(r.score > 0 for r in rows)
    with pytest.raises(ValueError):
        R.bm25(docs, ask, 3, k1=0)


def test_dataset_report_of_small_and_empty_tables(spark):
    from evidentia.operators.report import dataset_report

    sources = spark.createDataFrame([("a", "web", "open", "full_text_allowed", "x.org", ["t", "u"], []), ("b", "api", "open", "local_only", "y.org", None, ["r"]), ("c", "api", "open", "full_text_allowed", "sub.z.org", [], [])], "source_id string, source_type string, license_status string, release_policy string, domain string, topic array<string>, region array<string>")
    entities = spark.createDataFrame([("REGION",), (None,)], "type string")
    facts = spark.createDataFrame([("p", "a", True, False), ("p", "gone", False, True), (None, "c", None, None)], "predicate string, evidence_source_id string, verified boolean, manual_checked boolean")
    chunks = spark.createDataFrame([("b", "synthetic_fact", "1234"), ("b", "open_text", "12"), ("a", "open_text", None), (None, "open_text", "123456789")], "source_id string, chunk_kind string, text string")
    questions = spark.createDataFrame([("k", True, True, ["a", "a", "gone"]), ("k", False, None, None)], "answer_type string, unanswerable boolean, manual_checked boolean, evidence_source_ids array<string>")
    tables = sources, entities, facts, chunks, questions
    got = {(r.section, r.key): r.value for r in dataset_report(*tables, ["z.org"]).collect()}
    want = {("counts", "sources"): 3, ("counts", "entities"): 2, ("counts", "facts"): 3, ("counts", "manually_checked_facts"): 1, ("facts", "verified"): 1, ("relation", "p"): 2, ("topic", "t"): 1, ("region", "r"): 1, ("entity_type", "REGION"): 1, ("chunks", "average_length_chars"): 3.75, ("chunks", "median_length_chars"): 3}
    want |= {("qa", "unanswerable_ratio"): 0.5, ("average_per_source", "qa"): 0.666667, ("source_facts", "a"): 1, ("source_facts", "b"): 0, ("source_qa", "a"): 1, ("source_chunks", "b"): 2, ("restricted_audit", "sources"): 2, ("restricted_audit", "all_chunk_records"): 2, ("restricted_audit", "open_text_violations"): 1, ("restricted_audit", "passed"): 0}
    assert want.items() <= got.items() and not any(k == "gone" for _, k in got) and sum(s == "source_qa" for s, _ in got) == 3
    none = {(r.section, r.key): r.value for r in dataset_report(*(t.limit(0) for t in tables)).collect()}
    assert {k: v for k, v in none.items() if v} == {("restricted_audit", "passed"): 1} and none["chunks", "median_length_chars"] == 0 and len(none) == 20


def test_models_load_once_a_worker_and_vectors_follow_changes(spark, tmp_path):
    from evidentia.operators import hybrid as H

    log = f"{tmp_path}/loads"

    def load():
        with open(log, "a") as f:
            f.write(f"{os.getpid()}\n")
        return lambda texts: [[len(t), sum(len(x) <= len(t) for x in texts)] for t in texts]

    encode = R.encoder(load, f"counted-{tmp_path}", normalise=False, at_once=5)
    rows = spark.createDataFrame([(f"c{i:03d}", "x" * (i * 7 % 41)) for i in range(200)], "chunk_id string, text string").repartition(6)
    for _ in range(2):
        assert {r.chunk_id: r.v[0] for r in rows.select("chunk_id", encode(F.col("text")).alias("v")).collect()} == {f"c{i:03d}": i * 7 % 41 for i in range(200)}
    loads = open(log).read().split()
    assert len(loads) == len(set(loads))
    path = f"{tmp_path}/index"
    changed = rows.filter("chunk_id <> 'c007'").withColumn("text", F.when(F.col("chunk_id") == "c100", F.lit("new")).otherwise(F.col("text"))).union(spark.createDataFrame([("d", "yy")], "chunk_id string, text string"))
    told = [(m["encoded"], m["removed"], m["count"], again) for m, again in (H.build_index(x, path, encode, "m") for x in (rows, rows, changed, changed, rows))]
    assert told == [(200, 0, 200, False), (0, 0, 200, True), (2, 1, 200, False), (0, 0, 200, True), (2, 1, 200, False)]
    assert {r.chunk_id: r.embedding[0] for r in H.read_vectors(spark, path).collect()} == {f"c{i:03d}": i * 7 % 41 for i in range(200)}


def test_many_searches_at_once(spark):
    rng = random.Random(12)
    edges = [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(70)]
    seeds = [(q, f"n{rng.randrange(60)}") for q in range(150) for _ in range(1 + q % 2)] + [(900, "nowhere")]
    near = {}
    for u, v in edges:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    want = set()
    for q in {q for q, _ in seeds}:
        reached = {n: 0 for k, n in seeds if k == q}
        for step in (1, 2, 3):
            for n in [n for n, d in reached.items() if d == step - 1]:
                for m in near.get(n, ()):
                    reached.setdefault(m, step)
        want |= {(q, n, d) for n, d in reached.items()}
    got = G.khop(spark.createDataFrame(seeds, "qid int, node string").repartition(3), spark.createDataFrame(edges, "u string, v string"), 3).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_dense_topk_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr("evidentia.operators.dense.LEAST_ROWS", 8)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(6, 5))
    x = np.vstack((centres[rng.integers(0, 6, 90)] + 0.05 * rng.normal(size=(90, 5)), np.tile(centres[0], (40, 1)), np.zeros((3, 5)))).round(3)
    vectors = [(f"v{i:03d}", v.tolist()) for i, v in enumerate(x)] + [("none", None)]
    asked = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(25, 5)).round(3))] + [(90, [0.0] * 5), (91, None)]
    frames = spark.createDataFrame(vectors, "vec_id string, embedding array<float>"), spark.createDataFrame(asked, "qid int, query array<double>")
    want = {}
    for q, a in asked:
        if a is not None:
            scores = [(-round(float(np.dot(np.float32(v).astype(float), a)), 6), i) for i, v in vectors if v is not None]
            want[q] = [(i, -s) for s, i in sorted(scores)]
    for k in (1, 4, 60, 500, None):
        got = {}
        for r in R.dense(*frames, k).orderBy("qid", "rank").collect():
            got.setdefault(r.qid, []).append((r.id, r.score + 0.0))
        assert {q: [(i, pytest.approx(s, abs=1e-9)) for i, s in rows[:k]] for q, rows in want.items()} == got
    assert R.dense(frames[0].limit(0), frames[1], 3).count() == 0 and R.dense(frames[0], frames[1].limit(0), 3).count() == 0
    assert "NestedLoop" not in R.dense(*frames, 3)._jdf.queryExecution().toString()


def test_stored_index_grows_and_answers_alike(spark, tmp_path):
    rng = random.Random(8)
    docs = [(k, None if k == 3 else " ".join(rng.choice("ab bc cd de ef fg".split()) for _ in range(rng.randrange(0, 9)))) for k in range(30)]
    ask = spark.createDataFrame([(1, "ab cd cd"), (2, "zz"), (3, None), (4, "fg ef ab bc")], "qid int, question string")
    index = Index(spark, f"file://{tmp_path}/ix")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(index.bm25(ask)) == []
    for at in range(0, 30, 6):
        index.add(spark.createDataFrame(docs[at : at + 6], "doc_id int, text string"))
        part = spark.createDataFrame(docs[: at + 6], "doc_id int, text string")
        assert rows(index.bm25(ask, 4)) == rows(R.bm25(part, ask, 4, id_col="doc_id"))
    assert [s.level for s in index.segments()] == [0, 1] and sum(s.n_docs for s in index.segments()) == 30
    # An older version stays readable until it is cleaned up; afterwards only live segments are left.
    early = spark.createDataFrame(docs[:12], "doc_id int, text string")
    assert rows(index.bm25(ask, 4, version=2)) == rows(R.bm25(early, ask, 4, id_col="doc_id"))
    now = rows(index.bm25(ask, None))
    index.vacuum()
    assert rows(index.bm25(ask, None)) == now and len(index.versions.known()) == 1
    assert len(list((tmp_path / "ix" / "postings").iterdir())) == 2
    empty = Index(spark, f"file://{tmp_path}/empty").add(spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string"))
    assert rows(empty.bm25(ask)) == []
    with pytest.raises(ValueError):
        index.bm25(ask, k1=0)


def test_fusion_and_allocation(spark):
    dense = spark.createDataFrame([("q", "c1", 0.9), ("q", "c2", 0.6)], "qid string, id string, score double")
    sparse = spark.createDataFrame([("q", "c1", 7.5), ("q", "c3", 3.0)], "qid string, id string, score double")
    rows = sorted(R.fuse(dense, sparse).collect(), key=lambda r: -r.score)
    assert (rows[0].id, rows[0].kind, rows[0].score) == ("c1", "vector+bm25", 1.0) and all(0 <= r.score <= 1 for r in rows)
    shape = "qid string, question string, id string, source_id string, score double, text string, confidence string, kind string, retrieval_score double"
    ev = spark.createDataFrame([("q", "x", "a", "s1", 0.9, "t", None, "vector", None), ("q", "x", "b", "s1", 0.8, "t", None, "vector", None), ("q", "x", "g", "s2", 0.5, "t", "high", "graph", None)], shape)
    assert {r.source_id for r in R.allocate(ev, 2).collect()} == {"s1", "s2"}
    long = spark.createDataFrame([("q", "x", f"c{i}", f"s{i}", 0.9 - i / 100, "t", None, "vector", 0.1) for i in range(3)] + [("q", "x", "g1", "s8", 0.1, "t", None, "graph", 0.4), ("q", "x", "g2", "s9", 0.2, "t", None, "graph", 0.6)], shape)
    picked = sorted(R.allocate(long, 2).collect(), key=lambda r: r.place)
    assert picked[-1].id == "g2" and len(picked) == 2


def test_allocation_is_the_greedy_one(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for q in range(40):
        items = [(f"e{i}", f"s{rng.randint(0, 3)}", round(rng.random(), 4) + i * 1e-5) for i in range(rng.randint(1, 9))]
        rows += [(f"q{q}", "", i, s, x, "", None, "vector", None) for i, s, x in items]
        taken, left = [], list(items)
        while left and len(taken) < 4:
            best = min(left, key=lambda e: (sum(t[1] == e[1] for t in taken), -e[2], e[0]))
            taken.append(best)
            left.remove(best)
        want[f"q{q}"] = [t[0] for t in taken]
    ev = spark.createDataFrame(rows, "qid string, question string, id string, source_id string, score double, text string, confidence string, kind string, retrieval_score double")
    got = {}
    for r in sorted(R.allocate(ev, 4).collect(), key=lambda r: r.place):
        got.setdefault(r.qid, []).append(r.id)
    assert got == want


def test_answer_gate(spark):
    ask = spark.createDataFrame([("1", "塔尔寺门票多少钱"), ("2", "塔尔寺在哪里"), ("3", "保护评估得分"), ("4", "票价")], "qid string, question string")
    ev = spark.createDataFrame([("1", 0.9, "塔尔寺在湟中", "s", "u", 1), ("2", 0.9, "塔尔寺在湟中", "s", "u", 1), ("2", 0.1, "weak", "s", "u", 2), ("4", 0.5, "门票四十元", "s", "u", 1)], "qid string, score double, text string, source_id string, source_url string, rank int")
    got = {r.qid: (r.refused, r.n_evidence) for r in R.answer(ask, ev).collect()}
    assert got == {"1": (True, 0), "2": (False, 1), "3": (True, 0), "4": (False, 1)}


def test_merges(spark):
    old = fact(spark, dict(fact_id="r", subject="a", predicate="p", object="x"), dict(fact_id="stale", subject="a", predicate="p", object="y", verified=False))
    new = fact(spark, dict(fact_id="r", subject="a", predicate="p", object="z"), dict(fact_id="n2", subject="b", predicate="p", object="x"), dict(fact_id="n1", subject="b", predicate="p", object="x", evidence_source_id="s2"), dict(fact_id="n3", subject="a", predicate="p", object="x"))
    got = {r.fact_id: r.object for r in M.merge_extracted(old, new).collect()}
    assert got == {"r": "x", "n1": "x"}
    rows = spark.createDataFrame([("a", "u1", 1), ("b", "u1", 2), ("a", "u2", 3)], "id string, url string, n int")
    held = lambda old, new: {(r.id, r.url) for r in M.upsert_owned(old, new, "id", F.col("url"), "n").collect()}
    assert held(rows.limit(0), rows) == {("a", "u2")}
    moves = spark.createDataFrame([("a", "u1", 1), ("a", "u2", 2), ("b", "u1", 3)], "id string, url string, n int")
    assert held(moves.filter("n = 1"), moves.filter("n > 1")) == {("a", "u2"), ("b", "u1")}
    assert held(moves, moves.limit(0)) == {("a", "u2"), ("b", "u1")} and held(moves.limit(0), moves.limit(0)) == set()


def test_registry_replay_is_sequential(spark):
    rng = random.Random(5)
    for turn in range(3):
        rows = [(f"i{rng.randrange(12)}", f"u{rng.randrange(9)}", n) for n in range(60)] + [(f"z{k}", f"own{k}", 100 + k) for k in range(5)]
        old, new = rows[:10], rows[10:]
        held = {}
        for i, u, n in old:
            held[i] = (u, n)
        owners = {u: i for i, (u, n) in sorted(held.items(), key=lambda e: e[1][1])}
        for i, u, n in new:
            if owners.get(u, i) != i:
                continue
            if i in held:
                owners.pop(held[i][0], None)
            held[i], owners[u] = (u, n), i
        frames = [spark.createDataFrame(x, "id string, url string, n int") for x in (old, new)]
        assert {(r.id, r.url, r.n) for r in M.upsert_owned(*frames, "id", F.col("url"), "n").collect()} == {(i, u, n) for i, (u, n) in held.items()}


def test_graph(spark):
    f = fact(spark, dict(subject="甲", predicate="located_in", object="青海湖区"), dict(subject="甲", predicate="has_level", object="国家级", object_type="CONCEPT"), dict(subject="乙", predicate="located_in", object="青海湖区"))
    f = f.withColumns({"subject_name": F.col("subject"), "object_name": F.col("object"), "evidence_url": F.lit("u")})
    entities = E.build_entities(f)
    sources = spark.createDataFrame([("s1", "S")], "source_id string, title string")
    nodes, edges = G.build_graph(entities, f, sources)
    assert nodes.count() == 5 and edges.count() == 6
    ask = spark.createDataFrame([("q", "青海湖区位于哪里"), ("p", "青海")], "qid string, question string")
    found = G.graph_retrieve(ask, entities, f, sources, k=2).collect()
    assert {r.qid for r in found} == {"q"} and sorted(r["rank"] for r in found) == [1, 2]
    places = spark.createDataFrame([("青海湖", "REGION", []), ("青海湖区", "REGION", ["青海"]), ("乙", "X", [])], "name string, type string, aliases array<string>")
    assert {(r.mention) for r in G.mentions(ask.filter("qid = 'q'"), places).collect()} == {"青海湖区"}


def test_questions(spark):
    rows = [dict(subject=f"项目{i}", predicate="located_in", object="甲县" if i < 6 else "乙县") for i in range(11)]
    rows += [dict(subject="项目0", predicate="has_level", object="国家级"), dict(subject="项目1", predicate="has_level", object="省级"), dict(subject="项目2", predicate="has_level", object="国家级"), dict(subject="项目2", predicate="has_level", object="县级")]
    f = fact(spark, *rows)
    regions = Q.regional(f, None).collect()
    assert [len(r.evidence_fact_ids) for r in regions] == [5]
    assert Q.single_fact(f, None).count() == 13
    assert all("：" in r.answer for r in Q.multi_hop(f, None).collect()) and Q.multi_hop(f, None).count() == 3
    pairs = Q.comparison(f, None).collect()
    assert len(pairs) == 6 * 5 + 1
    values = {r.question: r.answer for r in pairs}
    assert all(len(set(a.rstrip("。").split("；"))) == 2 for a in values.values())
    assert {r.question_id for r in Q.comparison(f, None).collect()} == {r.question_id for r in Q.comparison(f.repartition(7), None).collect()}
    least = sorted(pairs, key=lambda r: sha("ICH_PROJECT", *r.required_entities[:2], n=64))[:7]
    assert {r.question_id for r in Q.comparison(f, 7).collect()} == {r.question_id for r in least}
    assert {r.question_id for r in Q.comparison(f, 1000).collect()} == {r.question_id for r in pairs}
    assert Q.comparison(f.limit(0), 5).count() == 0
    assert Q.unanswerable(f.limit(0), 3).count() == 3
    many = fact(spark, *[dict(fact_id=f"m{i}", subject=f"s{i}", predicate="located_in", object=f"o{i % 30}", subject_type="PERSON") for i in range(100)])
    first = {r.question_id for r in Q.generate(many, 100).collect()}
    assert len(first) >= 100 and first == {r.question_id for r in Q.generate(many.orderBy(F.desc("fact_id")), 100).collect()}


def test_review(spark):
    kinds = ["single_fact"] * 40 + ["regional_aggregation"] * 20 + ["multi_hop"] * 20 + ["comparison"] * 10 + ["unanswerable"] * 10
    rows = [(f"q{i}", k) for i, k in enumerate(kinds)]
    df = spark.createDataFrame(rows, "question_id string, answer_type string")
    taken = Q.review_sample(df, "r", 30)
    counts = {r[0]: r[1] for r in taken.groupBy("answer_type").count().collect()}
    assert counts == {"single_fact": 12, "regional_aggregation": 6, "multi_hop": 6, "comparison": 3, "unanswerable": 3}
    assert {r.question_id for r in taken.collect()} == {r.question_id for r in Q.review_sample(df.orderBy(F.desc("question_id")), "r", 30).collect()}
    questions = df.withColumns({"manual_checked": F.lit(False), "notes": F.lit("")})
    h = F.sha2("question_id", 256)
    decided = lambda d, review="r": d.select(F.lit(review).alias("review_id"), F.lit("batch_001").alias("batch_id"), "question_id", h.alias("qa_sha256"), F.lit("2024-01-01").alias("reviewed_at"), F.lit("me").alias("reviewer"))
    good = decided(df.limit(10)).cache()
    apply = lambda decisions, minimum, allowed=None: (lambda out: (out[0].filter("manual_checked").count(), sorted(r.issue for r in out[1].collect())))(Q.apply_review(questions, decisions, h, minimum, "r", allowed))
    assert apply(good, 10) == (10, []) and apply(good.union(good), 10) == (10, [])
    assert apply(good, 11) == (0, ["accepted_below_minimum"]) and apply(good.union(good), 11)[0] == 0
    marked = Q.apply_review(questions, good, h, 10, "r")[0].filter("manual_checked").first()
    assert marked.notes == f"qa_manual_review_id=r; reviewed_at=2024-01-01; reviewer=me; qa_sha256={hashlib.sha256(marked.question_id.encode()).hexdigest()}"
    # Another review's decision counts nothing, one outside the sample neither; inside, a changed text or a second one closes the gate.
    odd = decided(spark.createDataFrame([("q99", "x")], df.schema), "other").withColumn("qa_sha256", F.lit("changed"))
    assert apply(good.union(odd), 10) == (10, [])
    stale = good.union(odd.withColumn("review_id", F.lit("r")))
    assert apply(stale, 10) == (0, ["qa_snapshot_changed"]) and apply(stale, 10, df.limit(10)) == (10, [])
    assert apply(stale.union(decided(spark.createDataFrame([("q99", "x"), ("zz", "x")], df.schema))), 1)[1][:2] == ["conflicting_review_snapshots", "missing_qa_record"]
    batch, report = Q.prepare_batch(questions, good.union(odd.withColumn("review_id", F.lit("r"))), h, "r", 100, 7)
    r = report.first()
    assert (r.accepted, r.remaining, r.batch_id, r.batch_size, r.stale, r.superseded, batch.count()) == (10, 90, "batch_002", 7, 1, 0, 7)
    assert Q.batch_decisions(batch, h, "r", "batch_002", "me").filter("decision = 'accepted'").count() == 7
    for bad in (lambda: Q.batch_decisions(batch, h, "r", "b", " "), lambda: Q.allocation({"single_fact": 3}, 4), lambda: Q.minimum_questions(0, {}), lambda: Q.minimum_questions(None, {})):
        with pytest.raises(ValueError):
            bad()
    assert Q.minimum_questions(None, {"tiers": {"v0.1": {"qa": {"min": 9}}}}) == 9
    batches = spark.createDataFrame([("batch_005",), ("x",), ("batch_z",)], "batch_id string")
    assert batches.agg(Q.next_batch(F.col("batch_id"))).first()[0] == "batch_006"


def test_quality_audit(spark):
    sources = spark.createDataFrame([("a", "parsed", ""), ("b", "parsed", "n"), ("c", "pending", "")], "source_id string, crawl_status string, notes string")
    docs = spark.createDataFrame([("a", "x" * 500, "2024-01-01", 1), ("a", "short", "2024-02-01", 2), ("b", "y" * 300, "2024-01-01", 3)], "source_id string, text string, retrieved_at string, ordinal int")
    got = {r.source_id: r for r in A.audit_quality(sources, docs, 100).collect()}
    assert got["a"].crawl_status == "fetched" and "cleaned_text_chars=5" in got["a"].notes and got["b"].crawl_status == "parsed" and got["c"].length is None
    again = A.audit_quality(A.audit_quality(sources, docs, 100).select("source_id", F.lit("parsed").alias("crawl_status"), "notes"), docs, 100)
    assert {r.source_id: r.notes for r in again.collect()}["a"] == got["a"].notes


def test_html_tables(spark):
    page = "<table><tr><th>项目名称</th><th>类别</th><th>保护单位</th></tr><tr><td>项目名称 甲</td><td>传统美术</td><td>馆一、馆二</td></tr><tr><td>乙</td></tr></table>"
    pages = spark.createDataFrame([("s1", page), ("s2", None)], "source_id string, html string")
    sources = spark.createDataFrame([("s1", "t", "example.org", "", [], "u")], "source_id string, title string, domain string, province string, region array<string>, url string")
    got = {(r.subject, r.predicate, r.object) for r in html.table_facts(pages, sources).collect()}
    assert got == {("甲", "belongs_to_category", "传统美术"), ("甲", "protected_by", "馆一"), ("甲", "protected_by", "馆二")}
    text = html.clean_pages(spark.createDataFrame([("p", "<title>T</title><body><nav>menu</nav><article><h1>题</h1><p>一, 二</p><p>一,  二</p></article></body>")], "id string, html string"), "id", "html").first()
    assert "menu" not in text.text and text.title == "T" and "一， 二" in text.text


def test_jsonl_and_manifest(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2), ("a", 1)], "k string, n int")
    path = str(tmp_path / "t")
    jsonl.write_jsonl(rows, path, "k", 1)
    assert [r.k for r in jsonl.read_jsonl(spark, path, rows.schema).collect()] == ["a", "b"]
    assert jsonl.read_jsonl(spark, str(tmp_path / "none"), rows.schema).count() == 0
    (tmp_path / "bad.json").write_text('{"k": "x", "z": 1}\n\n{broken\n')
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, str(tmp_path / "bad.json"), rows.schema).collect()
    (tmp_path / "more.json").write_text('{"k": " x ", "z": 1}\n')
    assert jsonl.read_jsonl(spark, str(tmp_path / "more.json"), rows.schema).first().k == "x"
    assert [tuple(r) for r in jsonl.unknown_fields(spark, str(tmp_path / "more.json"), rows.schema).collect()] == [("z", 1)]
    m = jsonl.stage_manifest([rows], {"a": 1})
    assert m == jsonl.stage_manifest([rows.orderBy("n")], {"a": 1}) != jsonl.stage_manifest([rows], {"a": 2})
    jsonl.commit(rows, str(tmp_path / "stage"), m)
    assert jsonl.current(spark, str(tmp_path / "stage"), m) and not jsonl.current(spark, str(tmp_path / "stage"), "x")


def test_release_package_notices_changes(spark, tmp_path):
    path = str(tmp_path / "p")
    (tmp_path / "a.md").write_text("report")
    (tmp_path / "c.yaml").write_text("x: 1")
    table = {"t": spark.range(3).select(F.col("id").cast("string").alias("evidence_text"))}
    with pytest.raises(FileNotFoundError):
        release.package(table, path, {"a.md": str(tmp_path / "none")})
    with pytest.raises(FileNotFoundError):
        release.package(table, path, {}, {"c.yaml": str(tmp_path / "none")}, True)
    manifest = spark.createDataFrame(release.package(table, path, {"a.md": str(tmp_path / "a.md"), "b.md": str(tmp_path / "none")}, {"c.yaml": str(tmp_path / "c.yaml")}, True).collect(), release.MANIFEST)
    assert {r.file for r in manifest.filter("name <> 't'").collect()} == {"reports/a.md", "configs/c.yaml"}
    release.write_manifest(manifest, str(tmp_path / "m"), {"version": "1"})
    assert sorted(map(tuple, release.read_manifest(spark, str(tmp_path / "m")).collect())) == sorted(map(tuple, manifest.collect()))
    assert release.check_package(spark, path, manifest, ("reports/a.md",)).count() == 0
    assert [r.problem for r in release.check_package(spark, path, manifest, ("reports/b.md",)).collect()] == ["missing required file"]
    rows = [("电话号码：1",), ("see /root/x",), ("Reviewer: a.b@c.org",)]
    spark.createDataFrame(rows, "evidence_text string").write.mode("append").parquet(f"{path}/t")
    (tmp_path / "p/reports/.a.md.crc").unlink(missing_ok=True)
    (tmp_path / "p/reports/a.md").write_text("other")
    assert {r.problem for r in release.check_package(spark, path, manifest).collect()} == {"row count mismatch", "checksum mismatch", "private path", "reviewer address", "personal field"}
    # An address alone, or a path elsewhere, is no problem.
    clean = str(tmp_path / "clean")
    manifest = spark.createDataFrame(release.package({"t": spark.createDataFrame([("mail a@b.org, see /home/x",)], "note string")}, clean).collect(), release.MANIFEST)
    assert release.check_package(spark, clean, manifest).count() == 0


def test_personal_fields_and_minimal_evidence(spark):
    for field in ("性别", "出生日期", "出生年月", "出生时间", "详细地址", "地址", "联系电话", "电话号码", "身份证", "身份证号"):
        assert one(spark, T.has_personal_field(F.lit(f"姓名：甲；{field} ： 乙")))
    for field in ("住址", "电话", "手机", "姓名", "地址在"):
        assert not one(spark, T.has_personal_field(F.lit(f"{field}：乙")))
    f = fact(spark, dict(subject="甲", subject_type="PERSON", predicate="inherited_by", object="乙", evidence_text="性别：女", notes="n "), dict(subject="丙", subject_type="X", predicate="made_of", object="木", evidence_text="联系电话:1", notes=A.MINIMISED), dict(subject="丁", predicate="located_in", object="乙"))
    got = [(r.evidence_text, r.notes) for r in A.minimise_evidence(f).orderBy("fact_id").collect()]
    assert got == [("姓名：甲；代表性传承人：乙", "n " + A.MINIMISED), ("主体：丙；质地：木", A.MINIMISED), ("e", "")]
    assert [tuple(r) for r in A.minimisation_report(f).collect()] == [(3, 2, 0, ["f0", "f1"])]


def test_similar_names_are_all_found(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randint(1, 24))) for _ in range(60)]
    names = set(base)
    for b in base[:40]:
        x = list(b)
        for _ in range(rng.randint(1, 3)):
            at = rng.randint(0, len(x))
            if rng.random() < 0.4:
                x.insert(at, rng.choice("abcd"))
            elif x:
                x[min(at, len(x) - 1)] = rng.choice("abcd")
        names.add("".join(x))
    names = sorted(names)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, p in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, q in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != q))
        return row[-1]

    table = spark.createDataFrame([(n,) for n in names], "name string")
    for threshold in (0.9, 0.75):
        want = {(a, b) for a in names for b in names if a != b and round(1 - distance(a, b) / max(len(a), len(b)), 6) >= threshold}
        assert {(r.name, r.match) for r in A.similar_names(table, table, threshold, 1000).collect()} == want


def test_modes_and_index(spark, tmp_path):
    from evidentia.operators import hybrid as H

    chunks = spark.createDataFrame([("c1", "s1", "alpha beta", "u1"), ("c2", "s2", "beta gamma gamma", "u2"), ("c3", "s1", "delta", "u3")], "chunk_id string, source_id string, text string, source_url string")
    encode = R.encoder(lambda: lambda texts: [[t.count("a"), t.count("g"), 1.0] for t in texts], "letters")
    manifest, reused = H.build_index(chunks, str(tmp_path / "index"), encode, "m")
    assert (manifest["count"], manifest["dimension"], reused) == (3, 3, False) and H.build_index(chunks, str(tmp_path / "index"), encode, "m")[1]
    assert not H.build_index(chunks.limit(2), str(tmp_path / "index"), encode, "m")[1] and not H.build_index(chunks, str(tmp_path / "index"), encode, "m", normalised=False)[1]
    with pytest.raises(ValueError):
        H.build_index(chunks.limit(0), str(tmp_path / "none"), encode, "m")
    assert all(abs(sum(x * x for x in r.embedding) - 1) < 1e-6 for r in H.read_vectors(spark, str(tmp_path / "index")).collect())

    f = fact(spark, dict(subject="alpha", predicate="located_in", object="beta", evidence_source_id="s9")).withColumns({"subject_name": F.col("subject"), "object_name": F.col("object"), "evidence_url": F.lit("u9")})
    sources = spark.createDataFrame([("s9", "S")], "source_id string, title string")
    for name, df in (("chunks", chunks), ("facts", f), ("sources", sources), ("entities", E.build_entities(f))):
        df.write.parquet(str(tmp_path / name))
    r = H.open_retriever(spark, str(tmp_path), {"m": encode}, R.pair_scorer(lambda: lambda pairs: [float(len(t)) for _, t in pairs], "lengths"))
    assert r.modes() == ["vector-only", "bm25-only", "graph-only", "hybrid"] + [f"{m}+rerank" for m in ("vector-only", "bm25-only", "graph-only", "hybrid")]
    assert H.Retriever(bm25=r.bm25).modes() == ["bm25-only"] and H.Retriever().modes() == []
    ask = spark.createDataFrame([("q1", "alpha beta"), ("q2", " ")], "qid string, question string")
    got = {m: [(x.qid, x.evidence_id, x.kind) for x in r.retrieve(ask, m, 2, 2).orderBy("qid", "rank").collect()] for m in r.modes()}
    assert got["bm25-only"] == [("q1", "c1", "bm25"), ("q1", "c2", "bm25")] and got["graph-only"] == [("q1", "f0", "graph")]
    assert {k for _, _, k in got["hybrid"]} >= {"graph"} and len(got["hybrid"]) == 2 and got["bm25-only+rerank"][0][1] == "c2"
    assert all(len(v) <= 2 for v in got.values()) and all(q == "q1" for v in got.values() for q, _, _ in v)
    for mode in ("nothing", "hybrid+x", "vector-only+rerank+"):
        with pytest.raises(ValueError):
            r.retrieve(ask, mode)
    with pytest.raises(ValueError):
        H.Retriever(bm25=r.bm25).retrieve(ask, "hybrid")
    gold = ask.select("qid", "question", F.array(F.lit("s2")).alias("gold_sources"), F.array(F.lit("f0")).alias("gold_facts"), (F.col("qid") == "q2").alias("unanswerable"))
    rows = {x.mode: x for x in H.run_evaluation(gold, r, 2, ["bm25-only", "graph-only"]).collect()}
    assert (rows["bm25-only"].recall_at_k, rows["bm25-only"].mrr, rows["bm25-only"].refusal_rate, rows["bm25-only"].citation_rate, rows["bm25-only"].source_diversity) == (1.0, 0.5, 1.0, 1.0, 1.0)
    assert (rows["graph-only"].recall_at_k, rows["graph-only"].hit_rate) == (0.0, 1.0)
    with pytest.raises(ValueError):
        H.run_evaluation(gold, H.Retriever())
    answer, found = H.ask(spark, "alpha beta", r, "hybrid", 2, 3)
    assert not answer.first().refused and found.count() == 3
    assert [x.sources for x in R.examples(r.retrieve(ask, "bm25-only", 2), ask, 1).collect()] == [["s1", "s2"]]


def test_fusion_keeps_rows_that_count_nothing(spark):
    shape = "qid string, id string, score double"
    dense = spark.createDataFrame([("q", "a", 0.5), ("q", "b", -0.2), ("r", "x", -1.0), ("r", "y", 0.0)], shape)
    sparse = spark.createDataFrame([("q", "b", 3.0)], shape)
    got = {(r.qid, r.id): (r.score, r.kind) for r in R.fuse(dense, sparse).collect()}
    assert got == {("q", "a"): (0.6, "vector"), ("q", "b"): (0.4, "vector"), ("r", "x"): (0.6, "vector"), ("r", "y"): (0.6, "vector")}


def test_readers_of_reviews(spark, tmp_path):
    pytest.importorskip("yaml")
    from evidentia.operators import catalogs as K
    from evidentia.operators import validate
    from evidentia.sources import reviews

    head = "review_id: r1\nreviewed_at: 2024-05-06\nreviewer_role: x\nreview_method: y\nsource_id: src_1\ntitle: T\npublisher: P\nparent_page_url: u\nattachment_url: https://www.a.org/f.pdf\nattachment_sha256: %s\nraw_path: %s\nregion: [青海省]\ntopic: []\nbatch: 第一批\nexpected_rows: 1\n"
    digest = hashlib.sha256(b"file").hexdigest()
    (tmp_path / "f.pdf").write_bytes(b"file")
    raw = str(tmp_path / "f.pdf")
    (tmp_path / "a.yaml").write_text(head % (digest, raw) + "level: 省级\nrows:\n- {sequence: 1, project_name: ' 甲 ', category: 民俗, circulation_area: 西宁, inheritors: [乙]}\n")
    (tmp_path / "b.yaml").write_text(head % (digest, raw) + "catalog_kind: inheritor\nexcluded_fields: [x]\nrows:\n- {sequence: 2, project_name: 甲, person_name: 乙, project_level: 国家级}\n")
    header, rows = reviews.reviewed_catalog(spark, str(tmp_path / "a.yaml"))
    assert K.catalog_problems(rows, header).count() == K.header_problems(header).count() == 0
    facts = {(r.predicate, r.object): r.evidence_text for r in K.reviewed_catalog_facts(rows, header).collect()}
    assert set(facts) == {("belongs_to_category", "民俗"), ("located_in", "西宁市"), ("has_level", "省级"), ("inherited_by", "乙")}
    assert set(facts.values()) == {"人工核验官方材料表格第1条（源表序号1）：项目名称：甲；项目类别：民俗；流传地区：西宁；项目级别：省级；传承人：乙；名录批次：第一批"}
    assert K.attachment_problems(header, reviews.attachments(spark, [raw])).count() == 0
    assert [r.problem for r in K.attachment_problems(header, reviews.attachments(spark, [raw + "x"])).collect()] == ["missing"]
    source = K.catalog_sources(header).first()
    assert (source.domain, source.crawl_status, source.raw_text_release) == ("a.org", "parsed", False) and "review_id=r1" in source.notes
    header, rows = reviews.reviewed_catalog(spark, str(tmp_path / "b.yaml"))
    assert [r.problem for r in K.inheritor_catalog_problems(rows, header).collect()] == ["sequence"]
    assert {(r.predicate, r.object) for r in K.reviewed_inheritor_facts(rows, header).collect()} == {("inherited_by", "乙"), ("has_level", "国家级")}
    (tmp_path / "bad.yaml").write_text(head % ("ABC", raw) + "level: x\nrows:\n- {sequence: 1, colour: red}\n")
    with pytest.raises(ValueError):
        reviews.reviewed_catalog(spark, str(tmp_path / "bad.yaml"))
    (tmp_path / "m.yaml").write_text("review_id: m\nreviewed_at: 2024-01-01\nexpected_sources: 1\nexpected_facts: 4\nrows:\n- {source_id: src_tibetan_museum_exhibit_3, exhibit_id: 4, name: n, category: c, period: p, museum: m, material: x}\n")
    document, rows = reviews.museum_review(spark, str(tmp_path / "m.yaml"))
    assert [tuple(r) for r in K.review_problems(rows, document["expected_sources"], document["expected_facts"]).collect()] == [("src_tibetan_museum_exhibit_3", "exhibit id")]
    (tmp_path / "c.yaml").write_text("reviewed_at: 2024-01-01\nreview_method: hand\nrecords:\n- {audit_id: audit_c1, record_snapshot: s, source_ids: [a], extra: 1}\n")
    fixed = reviews.corrections(spark, str(tmp_path / "c.yaml"))
    assert fixed.first().snapshot_sha256 == hashlib.sha256(b"s").hexdigest() and reviews.corrections(spark, str(tmp_path / "no.yaml")).count() == 0
    f = fact(spark, dict(subject="a", predicate="p", object="b", manual_checked=True, notes="qa_manual_review_id=q; manual_review_id=; reviewed_at= 2024 ")).withColumn("evidence_url", F.lit("u"))
    none = spark.createDataFrame([], "question_id string, question string, answer string, answer_type string, evidence_fact_ids array<string>, evidence_source_ids array<string>, required_entities array<string>, difficulty string, unanswerable boolean, manual_checked boolean, notes string")
    got = {r.audit_id: r for r in validate.audit_samples(f, none, fixed).collect()}
    # The shorter key is found within the longer one.
    assert got["audit_fact_f0"].review_method == "q" and got["audit_fact_f0"].reviewed_at == "2024" and got["audit_c1"].review_method == "hand"
    assert json.loads(got["audit_fact_f0"].record_snapshot)["subject"] == "a" and got["audit_fact_f0"].snapshot_sha256 == hashlib.sha256(got["audit_fact_f0"].record_snapshot.encode()).hexdigest()


def test_schemas_and_validation(spark, tmp_path):
    from evidentia.functions import schemas
    from evidentia.operators import validate

    days = ["2024-02-29", "2023-02-29", "2024-2-9", "20240229", "", None]
    assert [r[0] for r in spark.createDataFrame([(d,) for d in days], "d string").select(schemas.is_date(F.col("d"))).collect()] == [True, False, False, False, False, False]
    row = dict(source_id=" s1 ", title="t", publisher="", source_type="other", url="u", domain="d", language="zh", province="p", region=[], topic=[], retrieved_at="2024-01-01", license_status="open", release_policy="local_only", raw_text_release=True, crawl_status="parsed", content_sha256="", notes="")
    make = lambda name, *rows: spark.createDataFrame([tuple(r[c] for c in schemas.SCHEMAS[name].fieldNames()) for r in rows], schemas.SCHEMAS[name])
    assert [tuple(r) for r in schemas.record_problems(make("sources", row), "sources").collect()] == [("s1", "closed_policy_releases_text")]
    good = row | dict(release_policy="full_text_allowed")
    question = dict(question_id="q", question="x", answer="y", answer_type="single_fact", evidence_fact_ids=["f"], evidence_source_ids=["s1"], required_entities=[], difficulty="easy", unanswerable=False, manual_checked=False, notes="")
    bad = [question | dict(question_id="a", unanswerable=True), question | dict(question_id="b", evidence_fact_ids=[]), question | dict(question_id="c", answer_type="unanswerable", unanswerable=True, evidence_fact_ids=[], evidence_source_ids=[])]
    assert {tuple(r) for r in schemas.record_problems(make("questions", question, *bad), "questions").collect()} == {("a", "evidence_or_unanswerable"), ("b", "evidence_or_unanswerable")}
    fact_row = dict(fact_id="f", subject="a", subject_type="X", predicate="made_of", object="b", object_type="Y", evidence_source_id="s1", evidence_url="u", evidence_text=None, extraction_method="rule", verified=True, confidence="low", manual_checked=False, notes="")
    chunk = dict(chunk_id="c", doc_id="d", source_id="s1", text="t", char_start=0, char_end=1, topic_labels=[], region_labels=[], entity_mentions=[], license_status="open", release_policy="full_text_allowed", source_url="u", retrieved_at="x", chunk_kind="open_text", notes="")
    entity = dict(entity_id="e", name="n", type="PERSON", aliases=[], description="", province="", regions=[], canonical_source_id="s1", confidence="low", notes="")
    tables = {"sources": make("sources", good | dict(source_id="s1")), "facts": make("facts", fact_row), "chunks": make("chunks", chunk), "entities": make("entities", entity), "questions": make("questions", question)}
    assert validate.validate(tables, []).count() == 0 and "PASS" in validate.validation_report(validate.validate(tables, []))
    assert [r.check for r in validate.validate(tables, ["d"], ["raw/x", "raw/.gitkeep"]).orderBy("check").collect()] == ["open_text_domain", "tracked_raw_file"]
    lost = {k: v for k, v in tables.items() if k != "facts"}
    assert [tuple(r) for r in validate.validate(lost, []).collect()] == [("missing_table", None, "facts")]
    broken = tables | {"entities": make("entities", entity | dict(type="CITY", canonical_source_id="s7"))}
    assert [tuple(r) for r in validate.validate(broken, []).collect()] == [("schema_entities", "e", "type")]
    assert "FAIL" in validate.validation_report(validate.validate(broken, []))
    validate.write_json(spark, {"b": [1, "é"]}, str(tmp_path / "r"))
    assert validate.read_json(spark, str(tmp_path / "r")) == {"b": [1, "é"]} and validate.read_json(spark, str(tmp_path / "none"), 3) == 3
    text = validate.markdown_table(spark.createDataFrame([("a|b", 0.5), (None, 1.0)], "x string, y double"))
    assert text.splitlines()[2:] == ["| a\\|b | 0.5000 |", "|  | 1.0000 |"]


def test_listing_totals_and_pages(spark):
    from evidentia.sources import listings as L

    rows = [(1, '<div class="page"><p><span class="total">no</span></p><span class="total">共 12 条信息/共3页</span></div>'), (2, "<p>x</p>"), (3, None)]
    assert sorted(map(tuple, L.county_totals(spark.createDataFrame(rows, "page int, html string")).collect())) == [(1, 12, 3), (2, 0, 1), (3, 0, 1)]
    totals = spark.createDataFrame([("jd", 3), ("wl", 0)], "section string, total_pages int")
    assert sorted(map(tuple, L.page_numbers(totals).collect())) == [("jd", 1), ("jd", 2), ("jd", 3), ("wl", 1)] and L.page_numbers(totals, 1).count() == 2
    with pytest.raises(ValueError):
        L.page_numbers(totals, 0)


def test_merged_table(spark, tmp_path, monkeypatch):
    from evidentia.streaming import collect as S

    monkeypatch.setattr(S, "FAN_IN", 2)
    monkeypatch.setattr(S, "BUCKETS", 2)
    table = S.MergedTable(spark, f"file://{tmp_path}/t", "k", "n")
    assert table.read() is None
    written, store = [], S.MergedTable._store
    monkeypatch.setattr(S.MergedTable, "_store", lambda self, rows: written.append(rows.count()) or store(self, rows))
    best, before = {}, None
    for turn in range(8):
        rows = [(k, turn * 10 + k % 3, f"{turn}") for k in range(turn % 4, 6)] if turn != 5 else []
        best |= {k: max(best.get(k, (-1, "")), (n, v)) for k, n, v in rows}
        for again in range(1 + turn % 2):  # a replayed batch changes nothing
            assert table.add(spark.createDataFrame(rows, "k int, n int, v string"), "a", turn) is not bool(again)
        assert {r.k: (r.n, r.v) for r in table.read().collect()} == best
        if before:  # a reader of the version before still finds its parts
            assert {r.k: (r.n, r.v) for r in table.read(table.versions.known()[-2]).collect()} == before
        before = dict(best)
    # Eight batches of at most six rows are merged three times each; what no kept version has is gone.
    assert sum(written) <= 8 * 6 * 4 and [level for _, level in table._state()[0]] == [3]
    assert len(table.versions.known()) == 2 and len(table.versions.names("parts")) <= 4
    found = table.lookup(spark.createDataFrame([(3,), (77,)], "k int")).collect()
    assert [(r.k, r.n, r.v) for r in found] == [(3, *best[3])]


def test_registry_stream_frees_addresses(spark, tmp_path):
    from evidentia.streaming import collect as S

    schema = T_.StructType([T_.StructField("id", T_.StringType()), T_.StructField("url", T_.StringType()), T_.StructField("n", T_.IntegerType())])
    land = lambda *rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    take = lambda: {(r.id, r.url) for r in S.collect_owned(spark, f"{tmp_path}/in", schema, f"file://{tmp_path}/t", "id", F.col("url"), "n", f"{tmp_path}/ck").collect()}
    land(("a", "u1", 1))
    assert take() == {("a", "u1")}
    land(("c", "u1", 2))
    assert take() == {("a", "u1")}
    land(("a", "u2", 3), ("b", "u1", 4))
    assert take() == {("a", "u2"), ("b", "u1")}
    land(("a", "u1", 5), ("c", "u9", 6), ("b", "u3", 7))
    assert take() == {("a", "u2"), ("b", "u3"), ("c", "u9")} == take()


def test_tokens_follow_the_pattern(spark):
    text = "Ab_1 ÄÖ, 塔尔寺! x-y"
    want = re.findall(r"\w+", text.lower())
    assert one(spark, T.tokens(F.lit(text))) == want
    words = S.segmenter(spark.createDataFrame([("塔尔寺", 5), ("塔尔", 2)], "word string, freq long"))
    assert one(spark, words(F.lit("塔尔寺大a A_1"))) == ["塔尔", "塔尔寺", "大", "a", "a_1"]
    assert one(spark, words(F.lit(None).cast("string"))) == [] and one(spark, words(F.lit("No Han"))) == ["no", "han"]


def test_listing_pages(spark):
    from evidentia.sources import listings as L

    page = """<div class="search-info"><span class="total">共 1,204 条</span></div>
    <a class="app-article-item" href="//host/content/77" cid="5" contentid="9"><p class="app-article-title">非遗 展</p><span class="app-article-date">2024-01-02</span></a>
    <a class="app-article-item" href="/about/us"><p class="app-article-title">关于</p></a><a class="app-article-item" href="/x/a1.html"><p class="app-article-title">别的</p></a>
    <div class="app-pagination"><a href="/s?page=2">2</a><a href="/s?a=1&page=7">7</a></div>"""
    pages = spark.createDataFrame([(1, page), (2, None)], "page int, html string")
    got = {r.source_id: r for r in L.search_candidates(pages, "http://host").collect()}
    assert got["src_whlyt_content_77"].title == "非遗 展" and got["src_whlyt_content_77"].published_at == "2024-01-02" and len(got) == 2
    assert [tuple(r) for r in L.search_totals(pages).collect()] == [(1, 1204, 7)]

    article = lambda who, author, text: f'<meta name="ContentSource" content="{who}"><meta name="Author" content="{author}"><div class="app-content-body"><p>{text}</p></div>'
    rows = [(1, article("厅", "", "正文")), (2, article("报", "张", "禁止转载")), (3, "<p>x</p>")]
    found = {r.page: (r.eligible, r.reasons) for r in L.inspect_articles(spark.createDataFrame(rows, "page int, html string"), "厅").collect()}
    assert found == {1: (True, []), 2: (False, ["third_party_or_missing_content_source", "signed_article", "page_specific_restriction"]), 3: (False, ["missing_article_body", "third_party_or_missing_content_source"])}

    listing = '<a href="/gdly/jd/content_12" title="标题：湿地公园\r\n点击数：3\r\n发表时间：2024年1月1日">湿…</a><a href="https://other.cn/gdly/jd/content_13" title="标题：x">x</a><a href="/gdly/jd/list">l</a>'
    rows = L.county_candidates(spark.createDataFrame([(1, listing)], "page int, html string"), "jd", ["景区与文化地点"], "https://www.county.cn").collect()
    assert [(r.source_id, r.title, r.published_at, r.topic) for r in rows] == [("src_guide_content_12", "湿地公园", "2024年1月1日", ["景区与文化地点", "生态旅游"])]


def test_catalog_builders(spark):
    from evidentia.operators import catalogs as K

    review = spark.createDataFrame([("s1", "甲", "瓷", "唐", "馆", "土")], "source_id string, name string, category string, period string, museum string, material string")
    sources = spark.createDataFrame([("s1", "parsed", "a" * 64)], "source_id string, crawl_status string, content_sha256 string")
    rows = [dict(subject="甲", subject_type="MUSEUM_OBJECT", predicate=p, object=o) for p, o in (("belongs_to_category", "瓷"), ("created_in_period", "唐"), ("held_by", "馆"), ("made_of", "土"))]
    marked, issues = K.mark_reviewed(fact(spark, *rows), sources, review, "r", "2024-01-01")
    assert marked.filter("manual_checked").count() == 4 and issues.count() == 0
    marked, issues = K.mark_reviewed(fact(spark, *rows[:3]), sources, review, "r", "2024-01-01")
    assert marked.filter("manual_checked").count() == 0 and issues.count() == 1
