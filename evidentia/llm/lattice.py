"""Document probabilities from a subword lattice: all segmentations of a word into vocabulary pieces are summed."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import materialise, small_batches

#: Words in the broadcast tier; all others are joined by shuffle.
FREQUENT = 200_000
#: Entries that a task's counter holds before it is passed on.
COUNTER_ENTRIES = 200_000
#: Added to each piece's count.
PIECE_PRIOR = 0.1
SPACE = "▁"
#: Rounds of expectation maximisation.
ROUNDS = 3
#: Words, and bytes of words, that the recursion takes at once; longer words (in characters) go through one by one.
BLOCK, BLOCK_BYTES, LONG = 50_000, 1 << 20, 128
#: Bytes of the longest word of the broadcast tier, whose size is thereby bounded.
TIER_BYTES = 64
#: Share of a class's saved mass that goes to words of other classes.
OTHERS = 0.1
#: Hidden classes at most, the one for all others included.
CLASSES = 9


class Trie:
    """The pieces of a vocabulary as tables that walk many words at once: ``child[node, code of a character]`` (0: none), node 0 the root."""

    def __init__(self, pieces: dict[str, int]) -> None:
        self.pieces = pieces
        long = {p: i for p, i in pieces.items() if len(p) > 1}
        self.letters = np.array(sorted({ord(c) for p in long for c in p}), np.int64)
        code = {chr(c): k + 1 for k, c in enumerate(self.letters.tolist())}
        inner = sorted({p[:k] for p in long for k in range(1, len(p))})
        number = {p: k for k, p in enumerate(["", *inner, *sorted(long.keys() - set(inner))])}
        self.inner = len(inner) + 1
        self.child = np.zeros((self.inner, len(code) + 1), np.int32)
        self.piece = np.full(len(number), -1, np.int32)
        for p, k in number.items():
            if p:
                self.child[number[p[:-1]], code[p[-1]]] = k
            if p in long:
                self.piece[k] = long[p]
        single = sorted((ord(p), i) for p, i in pieces.items() if len(p) == 1)
        self.single = np.array([c for c, _ in single], np.int64), np.array([i for _, i in single], np.int32)


    def __reduce__(self):
        # The tables are some 40 MB and mostly empty; a worker builds them from the pieces, once for each broadcast.
        return Trie, (self.pieces,)


class Lattice:
    """Log probability of a word as the sum over its segmentations into pieces with unigram scores.

    Words of one length go through the recursion together, all in logs. A character that is no piece is spelled by its bytes.
    """

    def __init__(self, trie: Trie, logs: np.ndarray, bytes_: np.ndarray) -> None:
        """``logs``: natural log of each piece's probability, by its number; ``bytes_``: of each byte's."""
        self.trie, self.logs, self.bytes = trie, logs, bytes_
        self.code = np.zeros(0x110000, np.int16)
        self.code[trie.letters] = np.arange(1, len(trie.letters) + 1)
        self.single = np.full(0x110000, -1, np.int32)
        self.single[trie.single[0]] = trie.single[1]

    def __reduce__(self):
        return Lattice, (self.trie, self.logs, self.bytes)

    @classmethod
    def of(cls, scores: dict[str, float], bytes_: list[float]) -> Lattice:
        return cls(Trie({p: i for i, p in enumerate(scores)}), np.array(list(scores.values())), np.array(bytes_))

    @staticmethod
    def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(places of the words, their code points with the space symbol before them)``, an array for each length."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(words) else ():
            text = "".join(SPACE + words[i] for i in own.tolist())
            yield own, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(own), -1).T.astype(np.int64)

    def spelled(self, points: np.ndarray) -> np.ndarray:
        """Log probability of each character by itself: as a piece, or by its bytes."""
        one = self.single[points]
        out = self.logs[one]
        odd = one < 0
        if odd.any():
            kinds, at = np.unique(points[odd], return_inverse=True)
            out[odd] = np.array([self.bytes[list(chr(c).encode("utf-8", "surrogatepass"))].sum() for c in kinds.tolist()])[at]
        return out

    def forward(self, points: np.ndarray, alone: np.ndarray, arcs: list | None = None) -> np.ndarray:
        """Row i: log of the sum over all segmentations of each word's first i characters; ``arcs`` gets the pieces of several characters."""
        n, words = points.shape
        codes = self.code[points]
        child, piece = self.trie.child, self.trie.piece
        out = np.full((n + 1, words), -np.inf)
        out[0] = 0.0
        for start in range(n):
            here = out[start]
            out[start + 1] = np.logaddexp(out[start + 1], here + alone[start])
            node = child[0, codes[start]]
            at = np.flatnonzero(node)
            node = node[at]
            for end in range(start + 2, n + 1):
                if not len(at):
                    break
                node = child[node, codes[end - 1, at]]
                there = node > 0
                at, node = at[there], node[there]
                found = piece[node]
                hit = found >= 0
                own, found = at[hit], found[hit]
                if len(own):
                    score = self.logs[found]
                    out[end, own] = np.logaddexp(out[end, own], here[own] + score)
                    if arcs is not None:
                        arcs.append((start, end, own, found, score))
                more = node < self.trie.inner
                at, node = at[more], node[more]
        return out

    def log_probs(self, words: list[str]) -> np.ndarray:
        """Natural log of each word's marginal probability."""
        out = np.empty(len(words))
        short = np.flatnonzero(np.fromiter((len(w) <= LONG for w in words), bool, len(words)))
        for own, points in self.by_length([words[i] for i in short.tolist()]):
            out[short[own]] = self.forward(points, self.spelled(points))[-1]
        for i in np.setdiff1d(np.arange(len(words)), short).tolist():
            out[i] = self.forward_long(words[i])
        return out

    def forward_long(self, word: str) -> float:
        """The same for one word of any length: its pieces are found from all places together, then summed place by place."""
        (_, points), = self.by_length([word])
        points = points[:, 0]
        n, codes = len(points), self.code[points]
        arcs = [(np.arange(n), np.arange(1, n + 1), self.spelled(points))]
        at = np.flatnonzero(node := self.trie.child[0, codes])
        node, size = node[at], 1
        while len(at):
            size += 1
            more = (node < self.trie.inner) & (at + size <= n)
            at, node = at[more], node[more]
            node = self.trie.child[node, codes[at + size - 1]]
            at, node = at[node > 0], node[node > 0]
            found = self.trie.piece[node]
            hit = found >= 0
            arcs.append((at[hit], at[hit] + size, self.logs[found[hit]]))
        start, end, score = (np.concatenate(x) for x in zip(*arcs, strict=True))
        order = np.argsort(end, kind="stable")
        edges = np.searchsorted(end[order], np.arange(1, n + 2)).tolist()
        start, score = start[order].tolist(), score[order].tolist()
        out = [0.0] * (n + 1)
        for place in range(1, n + 1):
            terms = [out[start[k]] + score[k] for k in range(edges[place - 1], edges[place])]
            most = max(terms)
            out[place] = most + math.log(sum(math.exp(x - most) for x in terms))
        return out[n]

    def expected(self, words: list[str], of_byte: dict[int, int]) -> np.ndarray:
        """How often each piece is expected over all segmentations of the words; ``of_byte``: the piece of a byte."""
        total = np.zeros(len(self.logs))
        for _, points in self.by_length(words):
            n = len(points)
            alone = self.spelled(points)
            arcs: list[tuple] = []
            forward = self.forward(points, alone, arcs)
            backward = np.full(forward.shape, -np.inf)
            backward[n] = -forward[n]
            uses = [(np.zeros(0, np.int32), np.zeros(0))]
            for start in range(n - 1, -1, -1):
                backward[start] = backward[start + 1] + alone[start]
                while arcs and arcs[-1][0] == start:
                    _, end, own, found, score = arcs.pop()
                    after = score + backward[end, own]
                    backward[start, own] = np.logaddexp(backward[start, own], after)
                    uses.append((found, np.exp(forward[start, own] + after)))
            one = np.exp(forward[:-1] + alone + backward[1:])
            single = self.single[points]
            uses.append((single[single >= 0], one[single >= 0]))
            total += np.bincount(np.concatenate([p for p, _ in uses]), np.concatenate([x for _, x in uses]), len(total))
            kinds, at = np.unique(points[single < 0], return_inverse=True)
            for c, x in zip(kinds.tolist(), np.bincount(at, one[single < 0], len(kinds)).tolist(), strict=True):
                for b in chr(c).encode("utf-8", "surrogatepass"):
                    total[of_byte.get(b, 0)] += x
        return total


def blocks(batches: Iterator[pa.RecordBatch], rows: int = BLOCK, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in larger batches, and in smaller ones where words are long."""
    held: list[pa.RecordBatch] = []
    for batch in (part for whole in batches for part in _halved(whole, size)):
        if held and sum(b.column(0).nbytes for b in held) + batch.column(0).nbytes > 2 * size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
        held.append(batch)
        if sum(map(len, held)) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _halved(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """The batch, in parts of not much more than ``size`` bytes of words unless one word is longer."""
    n = max(1, min(len(batch), -(-batch.column(0).nbytes // size)))
    for k in range(n):
        begin, end = len(batch) * k // n, len(batch) * (k + 1) // n
        yield batch.slice(begin, end - begin)


def _piece_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def learn_pieces(words: DataFrame, model_path: str, rounds: int = ROUNDS) -> Lattice:
    """Unigram scores for the pieces of an existing vocabulary, learned from the distinct ``word`` values.

    First each word is spelled by the vocabulary's own model; then expectation maximisation counts each piece's
    expected uses over all segmentations; longer words than LONG teach in parts of that length. Counts are summed by task and then by piece, at most as many rows as
    there are pieces. Scores are log relative frequencies after adding PIECE_PRIOR, so that they sum to 1: pieces
    with the space symbol begin a word, which therefore needs no end mark.
    """
    model = _piece_model(model_path)
    usable = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    of_byte = {int(model.id_to_piece(i)[1:-1], 16): i for i in usable if model.is_byte(i)}
    trie = Trie({model.id_to_piece(i): i for i in usable if not model.is_byte(i)})
    spark = words.sparkSession
    shared = spark.sparkContext.broadcast(trie)

    def lattice_of(counts: np.ndarray) -> Lattice:
        total = counts[usable].sum() + PIECE_PRIOR * len(usable)
        logs = np.log((counts + PIECE_PRIOR) / total)
        return Lattice(trie, logs, np.array([logs[of_byte[b]] if b in of_byte else math.log(PIECE_PRIOR / total) for b in range(256)]))

    def counted(current: tuple | None) -> np.ndarray:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(shared.value, *current) if current else None
            own = None if current else _piece_model(model_path)
            total = np.zeros(model_size)
            for batch in blocks(batches):
                texts = [w[k : k + LONG] for w in map(bytes.decode, batch.column(0).to_pylist()) for k in range(0, max(1, len(w)), LONG)]
                if lattice:
                    total += lattice.expected(texts, of_byte)
                else:
                    total += np.bincount([i for ids in own.encode(texts, num_threads=1) for i in ids], minlength=model_size)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["piece", "n"])

        rows = words.select("word").mapInArrow(count, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        out = np.zeros(model_size)
        for piece, n in rows:
            out[piece] += n
        return out

    model_size = model.get_piece_size()
    lattice = lattice_of(counted(None))
    for _ in range(rounds):
        lattice = lattice_of(counted((lattice.logs, lattice.bytes)))
    return lattice


def word_counts(docs: DataFrame, classes: int) -> DataFrame:
    """``(word, c, n, by)``: how often each word stands in the learning rows, in all, and in the learning rows of each class; words are lower-cased (A-Z) bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned: list[Counter] = [Counter() for _ in range(classes)]
        other: Counter = Counter()

        def flush() -> pa.RecordBatch:
            rows = [(w, k, c, c) for k, own in enumerate(learned) for w, c in own.items()] + [(w, 0, 0, n) for w, n in other.items()]
            for own in (*learned, other):
                own.clear()
            kinds = (pa.binary(), pa.int32(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], names=["word", "class", "c", "n"])

        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            for text, held, k in zip(texts, batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                (other if held else learned[k]).update(text.lower().split())
            if len(other) + sum(map(len, learned)) > COUNTER_ENTRIES:
                yield flush()
        yield flush()

    parts = docs.select("text", "held", "class").mapInArrow(run, "word binary, class int, c long, n long")
    by = [F.sum(F.when(F.col("class") == k, F.col("c")).otherwise(0)) for k in range(classes)]
    return parts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"), F.array(*by).alias("by"))


class WordModel:
    """Log10 probabilities of words in each class: absolutely discounted counts of the class, below them the lattice mixed with the counts of all."""

    def __init__(self, lattice: Lattice, own: list[tuple[int, int, int, int]], ends: list[int]) -> None:
        """``own``: for all learning rows and then for each class (words, distinct, seen once, seen twice); ``ends``: documents of each, in the same order."""
        self.lattice = lattice
        self.words = np.array([x[0] for x in own], np.float64)
        self.discount = np.array([min(0.9, max(0.1, o / (o + 2 * t))) if o + t else 0.5 for _, _, o, t in own])
        self.saved = np.array([d * k / n if n else 1.0 for d, (n, k, _, _) in zip(self.discount, own, strict=True)])
        self.end = np.array([(e + 0.5) / (n + e + 1) for e, (n, _, _, _) in zip(ends[1:], own[1:], strict=True)])
        self.end_of_all = (ends[0] + 0.5) / (own[0][0] + ends[0] + 1)
        self.prior = np.log10(np.array([e + 0.5 for e in ends[1:]]) / sum(e + 0.5 for e in ends[1:]))

    def scores(self, words: list[bytes], total: np.ndarray, by: np.ndarray) -> np.ndarray:
        """A column for each class, and last the lattice alone."""
        spelled = self.lattice.log_probs([w.decode() for w in words])
        with np.errstate(divide="ignore"):
            share = lambda c, k: np.log(np.maximum(c - self.discount[k], 0) / np.maximum(self.words[k], 1))
            every = np.logaddexp(share(total, 0), np.log(self.saved[0]) + spelled)
            below = np.logaddexp(math.log(1 - OTHERS) + spelled, math.log(OTHERS) + every)
            out = np.empty((len(words), len(self.end) + 1))
            out[:, -1] = np.log(1 - self.end_of_all) + spelled
            for k in range(len(self.end)):
                out[:, k] = np.log(1 - self.end[k]) + np.logaddexp(share(by[:, k], k + 1), np.log(self.saved[k + 1]) + below)
        return out / math.log(10)


def score_texts(docs: DataFrame, held_out, model_path: str, id_col: str = "doc_id", text_col: str = "text", class_col: str | None = "lang", frequent: int = FREQUENT) -> DataFrame:
    """One row for each row of ``docs``: ``(id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score)``.

    Learns from the rows where the column ``held_out`` isn't true (null counts as false). Tokens are words and one end.
    ``base_score`` is the add-half unigram model over words. ``score`` is the log10 probability of the text: a sum
    over hidden classes (the CLASSES - 1 most frequent values of ``class_col`` in the learning rows, and one for all others) of
    the class's share times the product of its word probabilities. A row's own class isn't looked at when it is scored. A word
    has its discounted relative frequency in the class plus the saved mass times a mixture: the lattice, which is the
    word's marginal over all segmentations, and for OTHERS of it the word's frequency over all classes. All words of the corpus are counted.
    ``lattice_score`` is the log10 probability by the lattice alone, each word's marginal and the end.
    Frequent words of at most TIER_BYTES bytes are scored on the map side from a broadcast table of bounded size; all others are joined with
    the word table by shuffle, row and word at a time. Null and empty texts have the end alone. Repeated rows are
    each scored and counted.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"),
        F.coalesce(F.col(class_col).cast("string"), F.lit("")).alias("label") if class_col else F.lit("").alias("label"),
    )
    labels = rows.filter(~F.col("held")).groupBy("label").count().orderBy(F.desc("count"), "label").limit(CLASSES - 1).collect()
    number = F.lit(len(labels))
    for k, r in enumerate(labels):
        number = F.when(F.col("label") == r["label"], k).otherwise(number)
    rows = rows.withColumn("class", number.cast("int")).drop("label")
    classes = len(labels) + 1
    table = materialise(word_counts(rows, classes), "lm-words")

    columns = [F.col("c"), *(F.col("by")[k] for k in range(classes))]
    sums = [x for c in columns for x in (F.sum(c), F.count_if(c > 0), F.count_if(c == 1), F.count_if(c == 2))]
    flat = [int(x or 0) for x in table.agg(*sums).first()]
    own = [tuple(flat[i : i + 4]) for i in range(0, len(flat), 4)]
    by_class = {r[0]: r[1] for r in rows.filter(~F.col("held")).groupBy("class").count().collect()}
    ends = [sum(by_class.values()), *(by_class.get(k, 0) for k in range(classes))]
    n_tokens, n_kinds = own[0][0] + ends[0], own[0][1] + (ends[0] > 0)
    model = WordModel(learn_pieces(table.filter("c > 0"), model_path), own, ends)
    shared = spark.sparkContext.broadcast(model)
    base_of = lambda c: np.log10((c + 0.5) / (n_tokens + 0.5 * (n_kinds + 1)))

    def score_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            c = batch.column(1).to_numpy(zero_copy_only=False)
            by = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, classes)
            scores = pa.array(list(shared.value.scores(batch.column(0).to_pylist(), c, by)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(base_of(c)), scores], names=["word", "c", "n", "base", "scores"])

    scored = materialise(table.mapInArrow(score_words, "word binary, c long, n long, base double, scores array<double>"), "lm-scored")
    # The least count of a frequent word: counts go to bins, from the top while the bins' words fit.
    short = scored.filter(F.octet_length("word") <= TIER_BYTES)
    bins = short.groupBy(F.floor(F.log2("n") * 16).cast("int").alias("bin")).agg(F.min("n").alias("least"), F.count("*").alias("kinds"))
    least, room = None, frequent
    for r in sorted(bins.collect(), key=lambda r: -r["bin"]):
        room -= r["kinds"]
        if room < 0:
            break
        least = r["least"]
    top = short.filter(F.col("n") >= least).select("word", "c", "base", "scores").toArrow().combine_chunks() if least is not None else None
    if top is not None and top.num_rows:
        values = top.column("scores").combine_chunks().flatten().to_numpy().reshape(-1, classes + 1)
        tier = spark.sparkContext.broadcast((top.column("word").to_pylist(), top.column("c").to_numpy() > 0, top.column("base").to_numpy(), values))
    else:
        tier = spark.sparkContext.broadcast(None)

    def score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tier.value
        place = {w: i for i, w in enumerate(own[0])} if own else {}
        end = np.log10(np.append(shared.value.end, shared.value.end_of_all))
        first = float(base_of(np.float64(ends[0])))
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column(3).cast(pa.binary()).to_pylist():
                tokens = text.lower().split()
                at = [place.get(w, -1) for w in tokens]
                ids = np.array([i for i in at if i >= 0], np.int64)
                rare = [w for w, i in zip(tokens, at, strict=True) if i < 0] if len(ids) < len(at) else []
                known, base, more = (int(own[1][ids].sum()), float(own[2][ids].sum()), own[3][ids].sum(axis=0)) if len(ids) else (0, 0.0, 0.0)
                out.append((len(tokens) + 1, known + (ends[0] > 0), base + first, end + more, rare))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array([r[j] for r in out], t) for j, t in enumerate(kinds))], names=["row", "id", "held", "n_tokens", "n_known", "base_score", "scores", "rare"])

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "id", "held", "text")
    first = numbered.mapInArrow(score_rows, f"row long, id {kind}, held boolean, n_tokens long, n_known long, base_score double, scores array<double>, rare array<binary>")
    first = materialise(first, "lm-rows")
    rest = first.select("row", F.explode("rare").alias("word")).join(scored.select("word", (F.col("c") > 0).cast("long").alias("known"), "base", F.col("scores").alias("more")), "word")
    rest = rest.groupBy("row").agg(F.sum("known").alias("known"), F.sum("base").alias("base"), F.array(*(F.sum(F.col("more")[k]) for k in range(classes + 1))).alias("more"))
    both = first.drop("rare").join(rest, "row", "left")
    # Log-sum-exp over the classes.
    whole = [F.col("scores")[k] + F.coalesce(F.col("more")[k], F.lit(0.0)) for k in range(classes + 1)]
    each = [whole[k] + float(model.prior[k]) for k in range(classes)]
    both = both.withColumn("each", F.array(*each)).withColumn("most", F.array_max("each"))
    total = F.aggregate("each", F.lit(0.0), lambda acc, x: acc + F.pow(F.lit(10.0), F.greatest(x - F.col("most"), F.lit(-300.0))))
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return both.select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", plus("n_known", "known").alias("n_known"), F.lit(n_tokens).cast("long").alias("train_tokens"),
        plus("base_score", "base").alias("base_score"), (F.col("most") + F.log10(total)).alias("score"),
        whole[classes].alias("lattice_score"),
    )
