"""Each operator against brute force, and on null, empty, repeated and missing rows."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, root string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = "th er on an re nd at en es or ti st ar ou it is ha ing ble ly".split()


def prose(rng, words):
    out = []
    for k in range(words):
        w = "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
        out.append(w + ("." if k % 11 == 10 else "") + ("\n" if k % 33 == 32 else " "))
    return "".join(out).strip()


def texts():
    rng = random.Random(5)
    base = [prose(rng, rng.choice((3, 60, 90, 150, 400))) for _ in range(40)]
    near = [base[5].replace(" ", "  ", 1), base[5] + " the", base[7].upper(), base[7].lower()]
    passage = prose(rng, 70)
    shared = [prose(rng, 60) + "\n" + passage + "\n" + prose(rng, 60) for _ in range(3)]
    odd = [None, "", " \n\t", "a", "a b", "ä ö\n\nü\r\nß", "日本 語" * 50, "x " * 300, "### $$$ %%% " * 40, "WORD!! " * 60, base[1], base[1], "<|endoftext|> </s> x", prose(rng, 3000)]
    return base + near + shared + odd


@pytest.fixture(scope="module")
def rows():
    return [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, None, "clash", "clash") for i, t in enumerate(texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def with_repeats(spark, rows):
    return spark.createDataFrame(rows + rows[:3] + [(None, "null id " * 30, None, None, None, "", "")] * 2, DOCS)


def base_of(text):
    w = WORD.findall(text or "")
    c = Counter(zip(w, w[1:], w[2:]))
    covered = {k + d for k in range(len(w) - 2) if c[w[k], w[k + 1], w[k + 2]] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, rows, docs, none):
    from evidentia.llm.quality import judge, keep_good

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = {r.doc_id: r for r in judge(docs).collect()}
    for i, text, *_ in rows:
        want = base_of(text)
        assert tuple(got[i][n] for n in names) == want
        assert got[i].base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (got[i].base_failed and got[i].kept)
    assert got[0].fp == "clash"
    assert not got[[i for i, r in enumerate(rows) if r[1] and r[1].startswith("###")][0]].kept
    assert judge(none).count() == 0
    kept = keep_good(with_repeats(spark, rows))
    assert kept.columns == docs.columns
    assert kept.filter("doc_id = 1").count() == 2 * (1 if got[1].kept else 0)


def test_quality_verdict_is_brute_force(spark):
    from evidentia.llm.quality import LEAST_WORDS, REACH, judge

    rng = random.Random(21)
    rows = []
    for i in range(900):
        words = prose(rng, rng.choice((30, 60, 120, 250))).split()
        odd = rng.random()
        if odd < 0.1:
            words = [w + rng.choice("#*$") * rng.randint(0, 2) for w in words]
        elif odd < 0.2:
            words = [w.upper() if rng.random() < 0.6 else w for w in words]
        elif odd < 0.3:
            words = [w * rng.randint(1, 3) for w in words]
        rows.append((i, " ".join(words), rng.choice(("en", "de", None)), rng.choice(("a", "b", None)) if i < 870 else "rare"))
    values, groups = {}, {}
    for i, text, lang, source in rows:
        n, chars, symbols, _, _ = base_of(text)
        if n >= LEAST_WORDS:
            values[i] = {"symbol_ratio": symbols / chars, "upper_ratio": sum(c.isupper() for c in text) / chars, "word_length": chars / n, "chars": float(chars), "words": float(n)}
            for g in ((lang, source), (lang,), ()):
                groups.setdefault(g, []).append(values[i])

    def fences(g, rule):
        own = lambda name, q: (x := sorted(v[name] for v in groups[g]))[max(0, math.ceil(q * len(x)) - 1)]
        middle = own(rule, 0.5)
        error = middle / 2 / math.sqrt(own("words", 0.5)) if rule == "word_length" else math.sqrt(max(1.0, middle * own("chars", 0.5))) / own("chars", 0.5)
        reach = REACH * max(middle - own(rule, 0.1), error)
        return (middle - reach if rule == "word_length" else -math.inf), middle + reach

    got = {r.doc_id: r for r in judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    verdicts = set()
    for i, _, lang, source in rows:
        g = next(g for g in ((lang, source), (lang,), ()) if len(groups.get(g, ())) >= 100)
        # Sketches of so few values are exact up to a rank or two: rows that close to a fence aren't compared.
        inside = [[a * s < values[i][rule] < z / s if rule == "word_length" else values[i][rule] < z / s for s in (0.97, 1.03)] for rule in ("symbol_ratio", "upper_ratio", "word_length") for a, z in [fences(g, rule)]] if i in values else [[True, True]]
        if all(a == b for a, b in inside):
            want = not got[i].base_failed and all(a for a, _ in inside)
            assert got[i].kept == want, (i, inside)
            verdicts.add((got[i].base_failed, got[i].kept))
    assert verdicts == {(True, False), (False, True), (False, False)}


def test_quality_thresholds_follow_the_group(spark):
    from evidentia.llm.quality import judge

    rng = random.Random(2)
    mixed = lambda share: " ".join(w + ("#" if k < share else "") for k, w in enumerate(prose(rng, 100).split()))
    rows = [(i, mixed(30 + i % 9), "code", "a") for i in range(120)] + [(1000 + i, mixed(0), "en", "b") for i in range(120)] + [(5000, mixed(34), "en", "b"), (5001, mixed(34), "code", "a")]
    kept = {r.doc_id for r in judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).filter("kept").collect()}
    assert 5001 in kept and 5000 not in kept


def brute_components(fps, budget=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_simhash_links(spark):
    from evidentia.llm.simhash import link_fingerprints

    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(30)]
    fps = set(centres)
    for c in centres[:6]:
        for _ in range(40):
            x = c
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    for budget, segments in ((4, 5), (3, 5), (0, 4), (2, 8)):
        found = {r.fp: r.root for r in link_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp long"), budget, segments).collect()}
        mine = [found.get(x, x) for x in signed]
        want = brute_components(fps, budget)
        assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_simhash_keys_are_those_of_viable_chains():
    from evidentia.llm.simhash import Ring

    rng = random.Random(14)
    ring = Ring(4, 5)
    assert len(ring.keys) == 60 and len({m for _, m in ring.keys}) == 60
    full = (1 << 64) - 1
    chain = lambda s, k: ring.chain(s, k) & full
    for _ in range(20_000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 9)))
        viable = {s for s in range(5) if all((diff & chain(s, k)).bit_count() <= ring.allowed[k] for k in range(1, 4))}
        shared = {s for s, mask in ring.keys if not diff & mask}
        # Every chain of three that stays within its budgets has a key; keys of other chains need a piece with several differences.
        assert viable <= shared
        if diff.bit_count() <= 4:
            assert any(all((diff & chain(s, k)).bit_count() <= ring.allowed[k] for k in range(1, 6)) for s in viable)


def test_simhash_components(spark, rows, docs, none):
    import numpy as np
    import xxhash

    from evidentia.llm.simhash import keep_first, simhash_components

    def slow(text):
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        s = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0

    fps = [slow(r[1]) for r in rows]
    roots = brute_components(fps)
    least = {}
    for (i, *_), root in zip(rows, roots):
        least[root] = min(least.get(root, i), i)
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash_components(docs).collect()}
    assert got == {r[0]: (int(np.uint64(f).astype(np.int64)), least[k]) for r, f, k in zip(rows, fps, roots)}
    assert simhash_components(none).count() == 0
    kept = keep_first(with_repeats(spark, rows))
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == sorted(set(least.values()))
    assert kept.columns == docs.columns


def test_keep_first_keeps_one_row_of_each_component(spark):
    from evidentia.llm.simhash import keep_first

    rng = random.Random(17)
    a, b, c, d, e = (prose(rng, 120) for _ in range(5))
    # Texts differ in null ids and in the repeated id 7; of 7 and 8 the copy with the greater id goes.
    rows = [(None, a), (None, b), (None, b), (7, c), (7, d), (7, d), (8, d), (3, e), (7, e), (None, e), (None, None), (9, "")]
    kept = keep_first(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    want = [(None, a), (None, b), (7, c), (7, d), (3, e), (9, "")]
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, want))


def test_token_counts(spark, rows, docs, none):
    import sentencepiece

    from evidentia.llm.tokens import count_tokens

    path = str(P.path("piece_bpe_32k.model"))
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in count_tokens(docs, path).collect()}
    assert got == {i: (len((t or "").encode()), len(model.encode(t or ""))) for i, t, *_ in rows}
    assert count_tokens(none, path).count() == 0
    assert count_tokens(with_repeats(spark, rows), path).count() == len(rows) + 5


def test_byte_encoder_is_the_library():
    from tokenizers import Tokenizer

    from evidentia.llm.tokens import ByteEncoder, PieceCounter

    rng = random.Random(1)
    parts = ["a", "b", "the", " ", " ", "\n", "é", "'s", "1", "!", "\t", "<s>", "日", "​", "  ", "\n\n", " \n", "\u3000", "\r", "\x1c", "\x85", "\xa0", "▁", "<|endoftext|>"]
    path = str(P.path("byte_bpe_50k.json"))
    own, library = ByteEncoder(path), Tokenizer.from_file(path)
    counter = PieceCounter(str(P.path("piece_bpe_32k.model")))
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert own.encode(text) == own.pack(library.encode(text, add_special_tokens=False).ids)
        assert counter.count(text) == len(counter.model.encode(text))


def check_packing(out, rows, capacity=1024):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(str(P.path("byte_bpe_50k.json")))
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t, *_ in rows}
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == ids.keys()
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        at = 0
        for k, r in enumerate(pieces):
            assert r.start == at and 0 < r.length <= capacity and (k == 0 or r.length == capacity)
            assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[i][at : at + r.length]))
            at += r.length
        assert at == len(ids[i])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence), sum(map(len, ids.values()))


def test_packing(spark, rows, docs, none):
    from evidentia.llm.packing import pack

    path = str(P.path("byte_bpe_50k.json"))
    sequences, total = check_packing(pack(docs, path).collect(), rows)
    assert sequences <= math.ceil(total / 1024) + 1
    assert pack(none, path).count() == 0
    again = pack(with_repeats(spark, rows), path)
    assert again.count() > pack(docs, path).count()
    assert again.groupBy("sequence_id", "offset").count().filter("count > 1").count() == 0


def test_min_bin_slack_is_the_bin_by_bin_search():
    from evidentia.llm.packing import fullest_bin, plan_bins

    rng = random.Random(4)
    for _ in range(60):
        capacity = rng.randint(5, 40)
        counts = dict(Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 60))))
        grouped = [chosen for times, chosen in plan_bins(counts, capacity) for _ in range(times)]
        left, single = dict(counts), []
        while left:
            chosen = fullest_bin(left, capacity)
            single.append(chosen)
            sums = {0}
            rest = Counter(left)
            rest[max(left)] -= 1
            for n in rest.elements():
                sums |= {s + n for s in sums if s + n <= capacity - max(left)}
            assert sum(n * k for n, k in chosen.items()) == max(left) + max(sums)
            left = {n: c - chosen.get(n, 0) for n, c in left.items() if c > chosen.get(n, 0)}
        assert len(grouped) == len(single)
        used = Counter()
        for chosen in grouped:
            used.update(chosen)
        assert used == Counter(counts)


def test_leaks(spark, docs, none):
    from evidentia.llm.decontam import Index, find_leaks, remove_leaked, tokens

    rng = random.Random(8)
    items = [(k, prose(rng, rng.choice((15, 30, 60)))) for k in range(30)] + [(97, None), (98, ""), (99, "one word")]
    body = lambda n: prose(rng, n)
    found_in = [(1000 + k, body(rng.randint(0, 200)) + " " + t + " " + body(rng.randint(0, 200)), "en", "s", 0, "", "") for k, t in items[:30]]
    part = [(2000 + k, body(50) + " " + " ".join(t.split()[: len(t.split()) // 3]) + " " + body(50), "en", "s", 0, "", "") for k, t in items[:30]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    both = docs.union(spark.createDataFrame(found_in + part, DOCS))
    got = {(r.id, r.item) for r in find_leaks(both, bench).collect()}
    assert got == {(1000 + k, k) for k in range(30)}
    kept = remove_leaked(both, bench)
    assert kept.count() == both.count() - 30 and kept.columns == both.columns
    assert find_leaks(none, bench).count() == 0 and find_leaks(docs, bench.limit(0)).count() == 0

    words = [tokens(t) for _, t in items]
    df = Counter(w for x in words for w in set(x))
    index = Index([(k, t or "") for k, t in items], df, len(items), 30.0)
    for _, text, *_ in found_in + part:
        query = set(tokens(text)[:64])
        for threshold in (0.2, 0.6):
            exact = {}
            for w in query:
                t = index.terms.get(w)
                if t is not None:
                    for d, x in zip(index.docs[t], index.impacts[t]):
                        exact[d] = exact.get(d, 0) + x
            assert dict((d, round(s, 9)) for d, s in index.search(query, threshold)) == {d: round(s, 9) for d, s in exact.items() if s >= threshold - 1e-9}


def test_sharding(spark, rows, docs, none, tmp_path):
    from evidentia.llm.sharding import edited_map, read_map, rebalance, shard

    got = shard(docs, 3).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        text = rows[r.doc_id][1] or ""
        assert (r.size, r.text_crc32) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
        by.setdefault(r.shard, []).append(r)
    for own in by.values():
        assert sorted(r.place for r in own) == list(range(len(own)))
    same = {}
    for r in got:
        same.setdefault(rows[r.doc_id][1] or "", set()).add(r.shard)
    assert all(len(s) == 1 for s in same.values())
    hot = spark.createDataFrame([(i, "same text " * 20) for i in range(3000)] + [(9000 + i, f"t{i} " * 9) for i in range(3000)], "doc_id long, text string")
    sums = [r[1] for r in shard(hot, 8).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sums) == 8 and max(sums) < 1.1 * sum(sums) / 8
    assert shard(none, 8).count() == 0

    path = str(tmp_path / "maps")
    shard(docs, 3, map_path=path).count()
    shard(docs, 4, map_path=path).count()
    maps = spark.read.parquet(path + "/maps")
    assert {r[0] for r in maps.select("version").distinct().collect()} == {1, 2}
    one, two = read_map(maps, 1), read_map(maps, 2)
    assert all(two[k] == one[k] or two[k] == 3 or one[k] != two[k] for k in two) and set(two.values()) == {0, 1, 2, 3}
    sizes = {k: 10 for k in range(100)}
    start = {k: k % 4 for k in sizes}
    moved = edited_map(start, sizes, 5)
    assert sum(start[k] != moved[k] for k in sizes) == 20
    assert rebalance(maps, {r.part: r.bytes for r in maps.filter("version = 2").collect()}, 4).agg(F.max("version")).first()[0] == 3


def test_sharding_parts_copies_of_a_heavy_text_only(spark):
    from evidentia.llm.sharding import shard

    rows = [(None if i % 2 else 5, "hot text " * 30) for i in range(4000)] + [(i, f"pair {i // 2} " * 3) for i in range(8000)]
    got = shard(spark.createDataFrame(rows, "doc_id long, text string"), 4, slots=8)
    apart = got.groupBy("text_crc32", "size").agg(F.countDistinct("shard").alias("n"), F.count("*").alias("rows"))
    assert {(r.n, r.rows) for r in apart.filter("rows > 2").collect()} == {(4, 4000)}
    assert apart.filter("rows = 2 and n > 1").count() == 0 and apart.filter("rows = 2").count() == 4000
    sums = [r for r in got.groupBy("shard").agg(F.sum("size"), F.min("place"), F.max("place"), F.count("*"), F.countDistinct("place")).collect()]
    assert len(sums) == 4 and max(r[1] for r in sums) < 1.1 * sum(r[1] for r in sums) / 4
    assert all((r[2], r[3] + 1, r[5]) == (0, r[4], r[4]) for r in sums)


def test_lattice_of_long_words():
    import time

    from evidentia.llm.lattice import LONG, Lattice

    rng = random.Random(4)
    scores = {p: math.log(rng.random() / 50) for p in ["a", "b", "c", "ab", "bc", "abc", "cab", "bca", "▁", "▁a", "▁ab", "aaaa"]}
    lattice = Lattice.of(scores, [math.log(1 / 256)] * 256)
    words = ["".join(rng.choice("abcé") for _ in range(n)) for n in (1, 5, 60, LONG - 2)]
    assert [lattice.forward_long(w) for w in words] == [pytest.approx(float(x), rel=1e-9) for x in lattice.log_probs(words)]
    began = time.time()
    long = lattice.log_probs(["abc" * 100_000, "a"])
    assert time.time() - began < 20 and long[0] < -1e5 and math.isfinite(long[0]) and long[1] > -20


def test_more_copies_of_a_heavy_text_move_few_bytes(spark, tmp_path):
    from evidentia.llm.sharding import shard

    others = [(i, f"text {i} " * (1 + i % 9)) for i in range(3000)]
    copies = lambda n: [(10_000 + i, "heavy text " * 40) for i in range(n)]
    path = str(tmp_path / "maps")
    frame = lambda n: spark.createDataFrame(others + copies(n), "doc_id long, text string")
    one = {r.doc_id: r for r in shard(frame(700), 8, map_path=path).collect()}
    two = {r.doc_id: r for r in shard(frame(760), 8, map_path=path).collect()}
    moved = sum(r.size for i, r in one.items() if r.shard != two[i].shard)
    assert moved < 0.1 * sum(r.size for r in one.values()) and all(one[i].part == two[i].part for i in one)
    sums = Counter()
    for r in two.values():
        sums[r.shard] += r.size
    assert len(sums) == 8 and max(sums.values()) < 1.05 * sum(sums.values()) / 8


def test_subword_lattice(spark, rows, docs, none):
    from evidentia.llm.lattice import Lattice, score_texts

    path = str(P.path("piece_bpe_32k.model"))
    rule = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    c = Counter()
    for i, text, *_ in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            c.update((text or "").encode().lower().split() + [None])
    n, kinds = sum(c.values()), len(c)
    for frequent in (200_000, 40):
        got = {r.doc_id: r for r in score_texts(docs, rule, path, frequent=frequent).collect()}
        for i, text, *_ in rows:
            own = (text or "").encode().lower().split() + [None]
            want = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in own)
            r = got[i]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(c[w] > 0 for w in own), n)
            assert r.base_score == pytest.approx(want) and r.score < 0 and r.held_out == (zlib.crc32(str(i).encode()) % 5 == 1)
    assert score_texts(none, rule, path).count() == 0
    assert score_texts(with_repeats(spark, rows), rule, path).count() == len(rows) + 5

    scores = {"▁": -2.0, "▁a": -1.0, "a": -1.5, "b": -1.7, "ab": -2.2, "▁ab": -3.0}

    def brute(text):
        if not text:
            return 1.0
        return sum(math.exp(s) * brute(text[len(p) :]) for p, s in scores.items() if text.startswith(p))

    model = Lattice.of(scores, [-9.0] * 256)
    words = ["a", "ab", "abab", "aab", "b", "a" * 300]
    assert model.log_probs(words)[:5] == pytest.approx([math.log(brute("▁" + w)) for w in words[:5]])
    assert model.log_probs(["aé", "a", "日a"]) == pytest.approx([model.log_probs(["a"])[0] - 18, model.log_probs(["a"])[0], -2 - 27 - 1.5])
    assert model.log_probs([]).tolist() == []

    # Expected uses are the derivative of the log probability by a piece's score.
    got = model.expected(["abab", "é"], {0xC3: 3, 0xA9: 3})
    for i, piece in enumerate(scores):
        step = 1e-6
        more = Lattice.of({**scores, piece: scores[piece] + step}, [-9.0] * 256)
        slope = sum(more.log_probs(["abab", "é"]) - model.log_probs(["abab", "é"])) / step
        assert got[i] == pytest.approx(slope + (2.0 if i == 3 else 0.0), abs=1e-4)


def test_scores_are_brute_force(spark):
    """The mixed score from its definition, with the operator's own lattice."""
    from evidentia.llm.lattice import OTHERS, learn_pieces, score_texts

    path = str(P.path("piece_bpe_32k.model"))
    rng = random.Random(23)
    rows = [(i, prose(rng, rng.randint(0, 30)).replace("th", "ß") if i % 2 else prose(rng, rng.randint(1, 30)), "de" if i % 2 else "en", i % 4 == 0) for i in range(60)]
    rows += [(100, "x" * 400 + " a", None, True), (101, None, "en", False)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, held boolean")
    got = {r.doc_id: r for r in score_texts(table, F.col("held"), path).collect()}
    learned = [(t or "", lang) for _, t, lang, held in rows if not held]
    classes = ["en", "de", None]
    counts = {k: Counter(w for t, lang in learned if lang == k for w in t.lower().split()) for k in ("en", "de")}
    counts[None] = Counter()
    total = counts["en"] + counts["de"]
    ends = {k: sum(lang == k for _, lang in learned) for k in classes}
    model = learn_pieces(spark.createDataFrame([(w.encode(),) for w in total], "word binary"), path)

    def discount(c):
        once, twice = (sum(n == k for n in c.values()) for k in (1, 2))
        return min(0.9, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5

    def share(c, w):
        return max(c[w] - discount(c), 0) / max(1, sum(c.values()))

    def saved(c):
        return discount(c) * len(c) / sum(c.values()) if c else 1.0

    for i, text, _, _ in rows:
        words = (text or "").lower().split()
        spelled = dict(zip(words, model.log_probs(words) / math.log(10)))
        each = []
        for k in classes:
            n = sum(counts[k].values())
            end = (ends[k] + 0.5) / (n + ends[k] + 1)
            s = math.log10((ends[k] + 0.5) / sum(e + 0.5 for e in ends.values())) + math.log10(end)
            for w in words:
                if spelled[w] < -290 and not total[w]:  # the power below would be zero
                    s += math.log10(1 - end) + math.log10(saved(counts[k]) * (1 - OTHERS + OTHERS * saved(total))) + spelled[w]
                    continue
                letters = 10 ** spelled[w]
                below = (1 - OTHERS) * letters + OTHERS * (share(total, w) + saved(total) * letters)
                s += math.log10(1 - end) + math.log10(share(counts[k], w) + saved(counts[k]) * below)
            each.append(s)
        most = max(each)
        assert got[i].score == pytest.approx(most + math.log10(sum(10 ** (s - most) for s in each)), rel=1e-6)
        n, e = sum(total.values()), len(learned)
        end = (e + 0.5) / (n + e + 1)
        assert got[i].lattice_score == pytest.approx(sum(math.log10(1 - end) + spelled[w] for w in words) + math.log10(end), rel=1e-6)


def slow_line_dedup(rows):
    windows, cut, worded = {}, {}, {}
    for i, text, *_ in rows:
        cut[i] = u = re.split(r"(?<=\n)|(?<=[.!?] )", text or "")
        worded[i] = w = [k for k, x in enumerate(u) if WORD.search(x)]
        for k in range(max(1, len(w) - 2)) if w else ():
            windows.setdefault(tuple(u[j].strip(" \t\n\r\x0b\f") for j in w[k : k + 3]), []).append((i, k))
    gone = {}
    for places in windows.values():
        for i, k in places:
            if (i, k) != min(places):
                gone.setdefault(i, set()).update(range(k, min(k + 3, len(worded[i]))))
    out = {}
    for i, text, *_ in rows:
        drop = set()
        for k in gone.get(i, ()):
            last = worded[i][k + 1] if k + 1 in gone[i] else worded[i][k] + 1
            drop.update(range(worded[i][k], last))
        out[i] = ("".join(x for k, x in enumerate(cut[i]) if k not in drop) if drop else text, len(drop))
    return out


def test_line_dedup(spark, rows, docs, none):
    from evidentia.llm.linededup import dedup_lines

    got = {r.doc_id: (r.text, r.n_removed) for r in dedup_lines(docs).collect()}
    assert got == slow_line_dedup(rows)
    assert sum(n > 0 for _, n in got.values()) >= 3
    assert dedup_lines(none).count() == 0
    again = dedup_lines(with_repeats(spark, rows))
    assert again.count() == len(rows) + 5
    assert {(r.doc_id, r.text) for r in again.filter("doc_id < 3").collect()} == {(i, got[i][0]) for i in range(3)}


def test_line_dedup_runs_span_lines_without_words(spark):
    from evidentia.llm.linededup import dedup_lines

    rng = random.Random(31)
    passage = [prose(rng, 9).replace(".", "").replace("\n", " ") for _ in range(6)]
    for between in ("\n", "\n\n", "\n \t\n\n", ". \n"):
        own = [prose(rng, 12).replace(".", "").replace("\n", " ") for _ in range(4)]
        middle = between.join(passage) + between
        rows = [(1, own[0] + between + middle + own[1]), (2, own[2] + between + middle + own[3])]
        got = {r.doc_id: (r.text, r.n_removed) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got[1] == (rows[0][1], 0)
        # Six lines and what stands without words between them; blank lines at the ends of the run stay.
        blank = {"\n": 0, "\n\n": 1, "\n \t\n\n": 2, ". \n": 1}[between]
        ends = {"\n": "", "\n\n": "\n", "\n \t\n\n": " \t\n\n", ". \n": "\n"}[between]
        assert got[2] == (own[2] + between + ends + own[3], 6 + 5 * blank)
    # A line of its own ends a run, and windows over it are no repeats; short repeated windows go too.
    rows = [(1, "\n\n".join(passage)), (2, "\n\n".join([*passage[:3], "only here", *passage[3:]])), (3, "a. b. c. d.\na. b. c. e.")]
    got = {r.doc_id: (r.text, r.n_removed) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("\nonly here\n\n", 10), 3: ("a. b. c. d.\ne.", 3)}


def test_line_dedup_first_place_among_repeated_and_null_ids(spark):
    from evidentia.llm.linededup import dedup_lines

    rng = random.Random(41)
    shared = [prose(rng, 9).replace(".", "").replace("\n", " ") for _ in range(3)]
    own = [prose(rng, 9).replace(".", "").replace("\n", " ") for _ in range(8)]
    texts_ = ["\n".join([a, *shared, b]) for a, b in zip(own[::2], own[1::2])]
    rows = [(None, texts_[0]), (5, texts_[1]), (5, texts_[2]), (5, texts_[2]), (7, texts_[3])]
    got = [tuple(r) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    assert len(got) == 5
    whole = [r for r in got if r[2] == 0]
    # One text of the least id keeps the passage, in each of its copies; all other rows lose it.
    assert {r[0] for r in whole} == {5} and len({r[1] for r in whole}) == 1
    assert all(r[2] == 3 and shared[0] not in r[1] for r in got if r not in whole)
    assert dedup_lines(spark.createDataFrame([(None, texts_[0]), (None, texts_[1])], "doc_id long, text string")).filter("n_removed = 3").count() == 1


def test_names_of_other_columns_cannot_clash(spark):
    from evidentia.llm.decontam import remove_leaked
    from evidentia.llm.linededup import dedup_lines
    from evidentia.llm.quality import judge, keep_good
    from evidentia.llm.simhash import keep_first

    names = "_id _lang _w _mark _own _cut _places _h _g _n mark hash id h g n ks own cut fp root leaked own_h c0 c1 c2 s l key body".split()
    rng = random.Random(43)
    text = prose(rng, 120)
    rows = [(1, text, "en", "s", *names), (2, text, "en", "s", *names), (3, prose(rng, 90), None, None, *names)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in names))
    bench = spark.createDataFrame([(1, prose(rng, 30))], "item_id long, text string")
    for out in (keep_good(table), keep_first(table), remove_leaked(table, bench), dedup_lines(table), judge(table)):
        got = out.collect()
        assert [c for c in out.columns if c in names] == names and got
        assert all(r[n] == n for r in got for n in names)


def test_quality_classifier(spark, none):
    from evidentia.llm.classifier import isotonic, score_quality

    rng = random.Random(9)
    good = [(i, prose(rng, rng.randint(20, 200))) for i in range(200)]
    bad = [(1000 + i, (prose(rng, 3) + " ### ") * rng.randint(5, 60)) for i in range(200)]
    rows = good + bad + [(5000, None), (5001, "")]
    table = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, x string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad] + [(0, None), (None, 1)], "doc_id long, quality int")
    rule = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    got = {r.doc_id: r for r in score_quality(table, labels, rule).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    held = [(r.score, i < 1000) for i, r in got.items() if r.held_out and i < 5000]
    assert sum((s >= 0.5) == y for s, y in held) >= 0.97 * len(held)
    assert score_quality(none, labels, rule).count() == 0
    assert {r.score for r in score_quality(table, labels.limit(0), rule).collect()} == {0.5}
    import numpy as np

    knots, values = isotonic(np.arange(5.0), np.array([0, 3, 1, 4, 4.0]), np.full(5, 4.0))
    assert values.tolist() == [0, 0.5, 1] and knots.tolist() == [0, 1.5, 3.5]


def test_shared_lines_is_a_longest_common_subsequence():
    from evidentia.llm.htmltext import shared_lines

    rng = random.Random(6)
    for _ in range(300):
        a = [rng.randint(0, 4) for _ in range(rng.randint(0, 12))]
        b = [rng.randint(0, 4) for _ in range(rng.randint(0, 12))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        places = shared_lines(a, b)
        assert len(places) == table[-1][-1]
        at = 0
        for p in places:
            at = b.index(a[p], at) + 1


def test_page_differencing(spark):
    from evidentia.llm.htmltext import extract

    page = lambda body: f"<html><head><title>t</title><script>var a='<p>x</p>';</script></head><body>{body}</body></html>"
    rows = [
        (1, "http://first.org/a/1", page("<nav><a>menu</a></nav><article><h1>Title &amp; more</h1><p><b>First  line.<br><p>Second\nline</p></article><footer>f</footer>")),
        (2, "http://h.org/a/2", page("<div>Site name</div><p>Own text of two.</p><p>More of two.</p><div>Contact us</div>")),
        (3, "http://h.org/a/3.html", page("<div>Site name</div><p>Own text of three.</p><div class='cookie-notice'>Accept</div><div>Contact us</div>")),
        (4, "http://h.org/b/9", page("<div>Alone in b</div>")),
        (5, "http://other.org/", page("<p>Only page</p><form>Name</form><div id='comments'>Hi</div>")),
        (6, None, None),
        (7, "", ""),
        (8, "http://[broken", "plain &lt;text&gt; with <b>markup"),
        (9, "http://h.org/a/2?copy", page("<div>Site name</div><p>Own text of two.</p><p>More of two.</p><div>Contact us</div>")),
    ]
    table = spark.createDataFrame([(*r, "c", "d") for r in rows], "page_id long, url string, html string, text string, n_chars string")
    got = {r.page_id: r for r in extract(table).collect()}
    assert got[1].text == "Title & more\nFirst line.\nSecond line"
    assert got[3].text == "Own text of three."
    assert got[4].text == "Alone in b" and got[5].text == "Only page"
    assert got[6].text == got[7].text == "" and got[8].text == "plain <text> with markup"
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert got[2].text == got[9].text
    assert extract(table.limit(0)).count() == 0
    assert extract(table.union(table)).count() == 2 * len(rows)


def test_shared_lines_decide_outside_a_marked_article(spark):
    from evidentia.llm.htmltext import extract

    page = lambda k: f"<body><div>Site name</div><article>Teaser {k}</article><div><p>Main text {k}.</p><p>More {k}.</p></div><div>Contact us</div></body>"
    table = spark.createDataFrame([(k, f"http://h.org/a/{k}", page(k)) for k in range(3)], "page_id long, url string, html string")
    assert {r.page_id: (r.text, r.n_shared) for r in extract(table).collect()} == {k: (f"Teaser {k}\nMain text {k}.\nMore {k}.", 2) for k in range(3)}


def test_templates_go_and_copies_are_not_neighbours(spark):
    from evidentia.llm.htmltext import extract

    page = lambda own: "<body>" + "".join(f"<div>Template {i}</div>" for i in range(20)) + "".join(f"<p>{x}</p>" for x in own) + "</body>"
    own = {k: [f"Own {k} {j}" for j in range(3)] for k in range(4)}
    # Pages 0 to 3 are short articles in one template, 10 an exact copy of 0, both nearest to each other.
    rows = [(k, f"http://h.org/a/{k}/x", page(own[k])) for k in own] + [(10, "http://h.org/a/0/y", page(own[0]))]
    # A long article, its near copy, and another article of that host.
    long = [f"Long {j}" for j in range(60)]
    rows += [(20, "http://n.org/1", page(long)), (21, "http://n.org/2", page([*long[:59], "Changed"])), (22, "http://n.org/3", page(own[3]))]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {k: got[k] for k in own} == {k: "\n".join(x) for k, x in own.items()}
    assert got[10] == got[0] and got[22] == "\n".join(own[3])


def test_structure_of_pages():
    from evidentia.llm.htmltext import blocks, names_noise

    assert all(map(names_noise, "ad ad-slot-1 site-footer main-nav userComments cookieNotice related-posts share-buttons header site-header sidebar_left nav__list".split()))
    assert not any(map(names_noise, "share-price entry-header post-header adlib article content has-sidebar search-engines story headerless".split()))
    text = lambda html: [t for t, _ in blocks(html)]
    assert text("<html><head><title>t</title><meta charset=x><body><p>No end of the head.</p>") == ["No end of the head."]
    assert text("<title>t</title><p>No head at all.") == ["No head at all."]
    assert text("<article><p>Post.</p><article class='comment'>Reader</article></article><p>After.</p>") == ["Post.", "After."]
    assert text("<article class='post sponsored widget'><header><h1>Title</h1></header>Body</article>") == ["Title", "Body"]


def test_names_alone_delete_no_article():
    """Expected texts are written by hand."""
    from evidentia.llm.htmltext import blocks

    text = lambda html: [t for t, _ in blocks(html)]
    story = "<h1>Story</h1><p>First paragraph.</p><p>Second paragraph.</p>"
    told = ["Story", "First paragraph.", "Second paragraph."]
    for open_, close in (
        ('<div class="content-with-sidebar">', "</div>"), ('<div class="page left-sidebar">', "</div>"), ('<div class="post comments-open">', "</div>"), ('<div class="ad-free">', "</div>"),
        ('<article><section id="cookie-recipe">', "</section></article>"), ('<article><div class="menu-of-the-day">', "</div></article>"), ('<main><div class="newsletter-issue">', "</div></main>"), ("<form>", "</form>"), ('<div class="sidebar">', "</div>"),
    ):
        assert text(f"<body><nav>Home</nav>{open_}{story}{close}<footer>Legal</footer></body>") == told, open_
    assert text(f"<body><nav><ul><li>Home<li>News</ul><main>{story}</main></body>") == told
    assert text(f"<body><article>{story}<div class='responses'>Me too</div><div class='sharedaddy'>Share</div><section class='comments-area'><ol class='comment-list'><li><article class='comment-body'>Nice</article></ol></section></article>") == told
    assert text(f"<body><article>{story}</article><aside><article>Teaser</article></aside><div class='sidebar'><article>Teaser</article></div>") == told
    assert text("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.</p></article>") == ["Let x=2 be."]


def test_titles_stay_on_every_page(spark):
    from evidentia.llm.htmltext import extract

    page = lambda k: f"<body><nav>Home</nav><article><h1>Weekly report</h1><p>Subscribe now</p>{''.join(f'<p>Week {k} line {j}.</p>' for j in range(6))}<p>Read more</p></article></body>"
    table = spark.createDataFrame([(k, f"http://h.org/r/{k}", page(k)) for k in range(4)], "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n") for r in extract(table).collect()}
    assert got == {k: ["Weekly report", "Subscribe now", *(f"Week {k} line {j}." for j in range(6))] for k in range(4)} or got == {k: ["Weekly report", *(f"Week {k} line {j}." for j in range(6))] for k in range(4)}


def test_long_pages_align_in_little_memory():
    import tracemalloc

    from evidentia.llm import htmltext

    rng = random.Random(2)
    a, b = [[rng.randrange(50) for _ in range(n)] for n in (90, 70)]
    whole, cells = htmltext.shared_lines(a, b), htmltext.CELLS
    htmltext.CELLS = 64
    try:
        halved = htmltext.shared_lines(a, b)
    finally:
        htmltext.CELLS = cells
    assert len(halved) == len(whole) and all(x < y for x, y in zip(halved, halved[1:]))
    at = 0
    for p in halved:
        at = b.index(a[p], at) + 1
    tracemalloc.start()
    n = len(htmltext.shared_lines([rng.randrange(10**6) for _ in range(30_000)], [rng.randrange(10**6) for _ in range(30_000)]))
    assert n > 0 and tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()


def test_lines_that_frame_articles_go():
    from evidentia.llm.htmltext import keep_lines

    # Lines 1 and 2 begin and 9 ends every article; line 5 is a sentence that another article has too.
    mine, one, two = [1, 2, 3, 5, 4, 9], [1, 2, 10, 5, 11, 12, 13, 9], [1, 2, 20, 5, 21, 22, 23, 9]
    mine = [1, 2, 3, 5, 4, 6, 7, 8, 30, 9]
    assert keep_lines(mine, [1] * 10, [one, two]) == ([2, 3, 4, 5, 6, 7, 8], 4)
    assert keep_lines(mine, [1] * 10, [one]) == (list(range(10)), 4)
    # A near copy decides nothing within an article.
    assert keep_lines(mine, [1] * 10, [[*mine[:-2], 31, 9], two])[0] == list(range(10))


def test_second_page_tells_a_template_from_a_near_copy():
    from evidentia.llm.htmltext import keep_lines

    template, text = list(range(20)), list(range(100, 160))
    mine, near, far = template + text, template + text[:59] + [7000], template + [8000]
    assert keep_lines(mine, [0] * 80, [near, far]) == (list(range(20, 80)), 79)
    assert keep_lines(mine, [0] * 80, [far, near]) == (list(range(20, 80)), 20)
    assert keep_lines(template + [1000], [0] * 21, [far]) == ([20], 20)


def test_pipeline(spark, rows, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(12)
    item = prose(rng, 40)
    more = [(100 + i, prose(rng, 120), "en", "s0", None) for i in range(20)]
    more += [(200, prose(rng, 80) + " " + item + " " + prose(rng, 80), "en", "s0", None), (201, more[3][1] + " the", "en", "s0", None)]
    docs = spark.createDataFrame([r[:5] for r in rows] + more, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left, seen = docs, {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, left, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
            seen[name] = {r.doc_id: r.text for r in out.collect()}
            left = spark.createDataFrame(out.collect(), docs.schema)
    assert 200 in seen["near_dedup"] and 200 not in seen["decontamination"]
    assert {i: t for i, (t, _) in slow_line_dedup([(i, t) for i, t in seen["quality_rules"].items()]).items()} == seen["line_dedup"]
    whole = pipeline.run(spark, str(tmp_path)).collect()
    check_packing(whole, list(seen["decontamination"].items()))
