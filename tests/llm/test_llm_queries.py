"""The registered queries on a small folder of tables, each against brute force or its contract."""

import math
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parent.parent))

from test_llm_operators import WORD, base_of, brute_components, check_packing, prose, slow_line_dedup  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with copies, near copies, benchmark passages, junk, a very long text, nulls; pages, labels and a benchmark."""
    rng = random.Random(77)
    items = [(k, prose(rng, rng.choice((20, 45, 90)))) for k in range(12)]
    texts = [prose(rng, rng.choice((0, 8, 60, 140, 300))) for _ in range(60)]
    texts += [texts[3], texts[3].replace(" ", "  ", 1), texts[5] + " the", None, "", "### $$ " * 60, prose(rng, 30_000), "日本 語\tx\n\n" * 40]
    texts += [prose(rng, 70) + " " + t + " " + prose(rng, 40) for _, t in items[:8]] + [items[9][1]]
    docs = [(i, t, ("en", "de", None)[i % 3], f"s{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    page = lambda k, own: f"<html><head><title>t{k}</title></head><body><div>Site</div><nav><a>menu</a></nav><article>{''.join(f'<p>{x}</p>' for x in own)}</article><div>Legal {k % 2}</div></body></html>"
    hosts = ["http://a.org/x/", "http://a.org/y/", "https://www.b.org/"]
    pages = [(k, f"{hosts[k % 3]}{k}.html", page(k, ["Read on"] * (k % 4 > 0) + [prose(rng, 9).replace("\n", " ") for _ in range(4)])) for k in range(24)] + [(90, None, None), (91, "http://[bad", ""), (92, "http://a.org/x/0.html?copy", page(0, ["only"]))]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, int(bool(t) and "#" not in t), 0) for i, t, *_ in docs if i % 3], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return str(path), docs, items, pages


def rows_of(spark, folder, name):
    from evidentia.llm.queries import QUERIES

    df = QUERIES[name](spark, folder[0])
    return df.columns, df.collect()


def test_statistics_and_counts(spark, folder):
    import sentencepiece

    docs = folder[1]
    columns, rows = rows_of(spark, folder, "op1_adaptive_thresholds")
    assert columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert {r.doc_id: tuple(r)[1:6] for r in rows} == {i: base_of(t) for i, t, *_ in docs}
    model = sentencepiece.SentencePieceProcessor(model_file=str(P.path("piece_bpe_32k.model")))
    _, rows = rows_of(spark, folder, "op3_token_counts")
    want = {i: (len((t or "").encode()), len(model.encode(t or ""))) for i, t, *_ in docs}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == want and all(r.over_limit == (r.n_tokens > 4096) for r in rows) and any(r.over_limit for r in rows)


def test_fingerprints_and_components(spark, folder):
    import xxhash

    def slow(text):
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    docs = folder[1]
    fps = [slow(t) for _, t, *_ in docs]
    roots = brute_components(fps)
    least = {}
    for (i, *_), root in zip(docs, roots):
        least[root] = min(i, least.get(root, i))
    _, rows = rows_of(spark, folder, "op2_simhash_pigeonring")
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {d[0]: (f"{f:016x}", least[k]) for d, f, k in zip(docs, fps, roots)}


def test_packed_and_sharded(spark, folder):
    docs = folder[1]
    _, rows = rows_of(spark, folder, "op4_min_bin_slack")
    sequences, total = check_packing(rows, docs)
    # No more sequences than first fit over falling lengths takes.
    bins = []
    for n in sorted((r.length for r in rows), reverse=True):
        at = next((k for k, used in enumerate(bins) if used + n <= 1024), None)
        if at is None:
            bins.append(n)
        else:
            bins[at] += n
    assert math.ceil(total / 1024) <= sequences <= len(bins)
    _, rows = rows_of(spark, folder, "op6_virtual_slots")
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in docs}
    for shard in range(8):
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def test_leaks_end_to_end(spark, folder):
    """Every passage against every part of every item, without index, bound or early end."""
    from evidentia.llm import decontam as D

    docs, items = folder[1], folder[2]
    own = {k: D.question_and_answer(t) for k, t in items}
    df = Counter(w for _, t in items for w in set(D.tokens(t)))
    mean = sum(len(D.tokens(t)) for _, t in items) / len(items)
    want = {}
    for i, text, *_ in docs:
        words = D.tokens(text)
        for start in range(0, max(1, len(words) - D.STRIDE), D.STRIDE) if words else ():
            passage = set(words[start : start + D.PASSAGE])
            for k, (question, answer) in own.items():
                whole = question + answer
                count = max(1, -(-len(whole) // D.PART))
                for c in range(count):
                    part = Counter(whole[len(whole) * c // count : len(whole) * (c + 1) // count])
                    norm = D.K1 * (1 - D.B + D.B * sum(part.values()) / mean)
                    weight = {w: math.log(1 + (len(items) - df[w] + 0.5) / (df[w] + 0.5)) * n * (D.K1 + 1) / (n + norm) for w, n in part.items()}
                    score = sum(x for w, x in weight.items() if w in passage) / sum(weight.values())
                    region = words[max(0, start - len(whole)) : start + D.PASSAGE + len(whole)]
                    if score >= D.THRESHOLD and D.share_of_shingles(question, region) >= D.QUESTION_OVERLAP and D.share_of_words(answer, region) >= D.ANSWER_OVERLAP:
                        want[i, k] = max(want.get((i, k), 0), score)
    _, rows = rows_of(spark, folder, "op5_block_max_wand")
    got = {(r.doc_id, r.item_id): r.score for r in rows}
    assert got.keys() == want.keys() and len(want) >= 9
    assert all(got[k] == pytest.approx(want[k], abs=1e-6) for k in got)


def test_scores_of_a_language_model(spark, folder):
    docs = folder[1]
    _, rows = rows_of(spark, folder, "op7_subword_lattice")
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in docs}
    c = Counter(w for i, t, *_ in docs if not held[i] for w in [*(t or "").encode().lower().split(), None])
    n, kinds = sum(c.values()), len(c)
    for r in rows:
        own = [*(docs[r.doc_id][1] or "").encode().lower().split(), None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(c[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in own))
        assert r.score < 0 and r.lattice_score < 0
    assert len(rows) == len(docs)


def test_lines(spark, folder):
    docs = folder[1]
    _, rows = rows_of(spark, folder, "op8_line_windows")
    assert {r.doc_id: (r.text, r.n_removed) for r in rows} == slow_line_dedup(docs)


def test_lines_beside_sql(spark):
    import oracle
    from evidentia.llm.queries import ORACLE_SQL, QUERIES

    sf = Path("/root/testdata/sf0.001")
    if not sf.is_dir():
        pytest.skip("driver tables aren't here")
    mine, theirs = oracle.compare(spark, oracle.connect(str(sf)), QUERIES["op8_line_windows"], ORACLE_SQL["op8_line_windows"], str(sf))
    assert mine == theirs


def test_quality_scores(spark, folder):
    docs = folder[1]
    _, rows = rows_of(spark, folder, "op9_fourier_ridge")
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in docs}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_ridge_is_the_direct_solution(spark):
    from evidentia.llm import classifier as C

    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, len(C.NAMES)))
    y = (x[:, 0] + 0.3 * rng.normal(size=400) > 0).astype(float)
    fold = np.arange(400) % 5 == 0
    table = spark.createDataFrame([(list(map(float, a)), float(b), bool(c)) for a, b, c in zip(x, y, fold)], "x array<double>, y double, fold boolean").repartition(7)
    model = C.fit(table)
    rest = x[~fold]
    plain = C.Model(rest.mean(0), rest.std(0))
    f = plain.features(rest)
    weights = np.linalg.solve(f.T @ f + C.RIDGE * len(rest) / f.shape[1] * np.eye(f.shape[1]), f.T @ y[~fold])
    assert np.allclose(model.raw(x), plain.features(x) @ weights, atol=1e-6)
    # The features' inner products are near a Gaussian kernel's.
    z = (x[:40] - plain.mean) / plain.deviation
    waves = plain.features(x[:40])[:, : C.FEATURES]
    spread = np.median(((plain.directions**2).mean(axis=1)))
    kernel = np.exp(-0.5 * spread * ((z[:, None] - z[None]) ** 2).sum(-1))
    assert np.abs(waves @ waves.T - kernel).mean() < 0.1
    scores = model.probability(x[fold])
    assert ((scores >= 0.5) == (y[fold] > 0)).mean() > 0.6


def test_pages_and_their_neighbours(spark, folder):
    """Pairing, alignment and deletion page by page."""
    from evidentia.llm import htmltext as H

    pages = folder[3]
    lines = {k: H.blocks(html) for k, _, html in pages}
    hashes = {k: [H._hash(t) for t, _ in b] for k, b in lines.items()}
    sig = {r.k: r.s for r in spark.createDataFrame([(k, h) for k, h in hashes.items() if h], "k long, h array<int>").select("k", F.xxhash64("h").alias("s")).collect()}
    below = {}
    for k, url, _ in pages:
        for p in H.prefixes(url) if k in sig else ():
            below.setdefault(p, {})[sig[k]] = hashes[k]
    _, rows = rows_of(spark, folder, "op10_page_differencing")
    got = {r.page_id: (r.text, r.n_chars, r.n_shared) for r in rows}
    for k, url, _ in pages:
        others = None
        for p in H.prefixes(url) if k in sig else ():
            if len(below[p]) > 1:
                sides = sorted({*sorted(below[p])[:2], max(below[p])})
                others = [below[p][s] for s in sides if s != sig[k]][:2]
                break
        stay, n = H.keep_lines(hashes[k], [f for _, f in lines[k]], others)
        text = "\n".join(lines[k][i][0] for i in stay)
        assert got[k] == (text, len(text), n), k
    assert not any("Site" in t or "menu" in t for t, _, _ in got.values()) and sum("Read on" in t for t, _, _ in got.values()) < sum("Read on" in (h or "") for _, _, h in pages)
