"""Collocations: word sequences that stand together more often than their parts, counted with position bitmaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm.common import discard, materialise, small_batches

#: Bytes of text in one shard, and positions in one block of a bitmap.
SHARD_BYTES, WIDTH = 4 << 20, 16
#: Bitmap blocks that are extended at a time.
GROUP_BLOCKS = 25_000
#: Bits of the table of frequent phrases that workers hold: its size doesn't depend on the corpus.
FILTER_BITS = 1 << 26
#: Groups that a language's candidates are dealt to before the best are taken.
SALTS = 64
_MIX = np.uint64(0x9E3779B97F4A7C15)

#: Capitals become small, tabs spaces, and every character that ends a piece a line end.
CLEAN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Cleaned texts of one language, joined until they fill a shard; a longer text is cut at a piece's end."""
    waiting: dict[str, list[bytes]] = {}
    held: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = text.encode().translate(CLEAN)
            at = 0
            while len(data) - at > SHARD_BYTES:
                cut = data.rfind(b"\n", at + 1, at + SHARD_BYTES)
                cut = cut if cut > 0 else data.find(b"\n", at + SHARD_BYTES)
                if cut < 0:
                    break
                yield lang, data[at:cut]
                at = cut
            waiting.setdefault(lang, []).append(data[at:])
            held[lang] = held.get(lang, 0) + len(data) - at
            if held[lang] >= SHARD_BYTES:
                yield lang, b"\n".join(waiting.pop(lang))
                held.pop(lang)
        if sum(held.values()) >= 2 * SHARD_BYTES:
            for lang in list(waiting):
                yield lang, b"\n".join(waiting.pop(lang))
            held.clear()
    for lang, texts in waiting.items():
        yield lang, b"\n".join(texts)


def placed_words(data: bytes) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Word number and position of each word of a cleaned text, and the words. Between two pieces a position stays free."""
    chars = np.frombuffer(data, np.uint8)
    inside = (chars != 0x20) & (chars != 0x0A)
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.large_binary())
    offsets = np.concatenate(([0], np.cumsum(end - begin))).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(chars[inside].tobytes())]).dictionary_encode()
    piece = np.cumsum(chars == 0x0A)[begin]
    gaps = np.cumsum(np.diff(piece, prepend=piece[0]) > 0)
    return words.indices.to_numpy().astype(np.int64), np.arange(len(begin)) + gaps, words.dictionary


class Bitmaps:
    """A shard's compressed bitmap of positions for each word: only blocks with a position are kept, with their bits.

    Rows ``(block, word, bits)`` are held in order of blocks, so the words that stand in a block are a range of rows;
    ``by_word`` has the same rows in order of words, so a word's bitmap is a range too.
    """

    def __init__(self, word: np.ndarray, position: np.ndarray, n_words: int) -> None:
        order = np.argsort(key := (position // WIDTH) * n_words + word, kind="stable")
        key, bit = key[order], np.uint16(1) << (position[order] % WIDTH).astype(np.uint16)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.bits = np.bitwise_or.reduceat(bit, first) if len(first) else np.zeros(0, np.uint16)
        self.block, self.word = np.divmod(key[first], n_words) if len(first) else (np.zeros(0, np.int64),) * 2
        self.rows = np.searchsorted(self.block, np.arange((self.block[-1] if len(first) else 0) + 3))
        self.by_word = np.argsort(self.word, kind="stable")

    def words(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Groups of words with their bitmaps: words, then (number in the group, block, bits) of each row."""
        word = self.word[self.by_word]
        first = np.flatnonzero(np.diff(word, prepend=-1))
        last = np.append(first[1:], len(word))
        at = 0
        while at < len(first):
            to = max(at + 1, int(np.searchsorted(last, first[at] + GROUP_BLOCKS)))
            rows = self.by_word[first[at] : last[to - 1]]
            yield word[first[at:to]], (np.repeat(np.arange(to - at), (last - first)[at:to]), self.block[rows], self.bits[rows])
            at = to

    def extend(self, phrases: np.ndarray, bitmap: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
        """All one-word extensions of ``phrases``: their words, bitmaps of their last positions, and counts.

        A bitmap moves on by one position and meets the bitmaps of all words of the blocks that it reaches.
        """
        phrase, block, bits = bitmap
        carry = bits >> np.uint16(WIDTH - 1)
        over = np.flatnonzero(carry)
        phrase, block, bits = np.append(phrase, phrase[over]), np.append(block, block[over] + 1), np.append(bits << np.uint16(1), carry[over])
        n = self.rows[block + 1] - self.rows[block]
        entry = np.repeat(np.arange(len(n)), n)
        row = np.arange(len(entry)) + np.repeat(self.rows[block] - (np.cumsum(n) - n), n)
        met = bits[entry] & self.bits[row]
        hit = np.flatnonzero(met)
        entry, row, met = entry[hit], row[hit], met[hit]
        n_words = int(self.word.max()) + 1 if len(self.word) else 1
        key, number = np.unique(phrase[entry] * n_words + self.word[row], return_inverse=True)
        counts = np.bincount(number, np.bitwise_count(met), len(key)).astype(np.int64)
        longer = np.column_stack((phrases[key // n_words], key % n_words))
        return longer, (number, block[entry], met), counts

    def keep(self, chosen: np.ndarray, phrases: np.ndarray, bitmap: tuple, counts: np.ndarray) -> tuple:
        """Only the chosen phrases (a mask) and their bitmaps."""
        number, block, bits = bitmap
        rows = chosen[number]
        return phrases[chosen], ((np.cumsum(chosen) - 1)[number[rows]], block[rows], bits[rows]), counts[chosen]


def fold(hashes: np.ndarray) -> np.ndarray:
    """One hash for each row of word hashes."""
    h = hashes[:, 0]
    for k in range(1, hashes.shape[1]):
        h = (h ^ (h >> np.uint64(29))) * _MIX + hashes[:, k]
    return h ^ (h >> np.uint64(32))


class Frequent:
    """Bit tables of frequent phrases, one for each length. A phrase that isn't frequent may pass; a frequent one always does."""

    def __init__(self, tables: list[np.ndarray]) -> None:
        self.tables = tables

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each phrase, a row of word hashes, may be frequent."""
        at = (fold(hashes) & np.uint64(FILTER_BITS - 1)).astype(np.int64)
        return (self.tables[hashes.shape[1] - 1][at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def count_phrases(lang: str, data: bytes, length: int, frequent: Frequent) -> pa.RecordBatch:
    """A shard's counts of phrases of one length, all of whose shorter parts may be frequent; with their hashes."""
    word, position, words = placed_words(data)
    seed = xxhash.xxh64_intdigest(lang.encode())
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.to_pylist()), np.uint64, len(words))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if length == 1:
        found.append((np.arange(len(words))[:, None], np.bincount(word, minlength=len(words))))
    elif len(word):
        may = frequent.has(hashes[:, None])[word]
        maps = Bitmaps(word[may], position[may], len(words))
        for group, bitmap in maps.words():
            state = group[:, None], bitmap, None
            for n in range(2, length + 1):
                state = maps.extend(state[0], state[1])
                if n > 2:
                    state = maps.keep(frequent.has(hashes[state[0][:, 1:]]), *state)
                if n < length:
                    state = maps.keep(frequent.has(hashes[state[0]]), *state)
            found.append((state[0], state[2]))
    phrases = np.concatenate([p for p, _ in found]) if found else np.zeros((0, length), np.int64)
    counts = np.concatenate([c for _, c in found]) if found else np.zeros(0, np.int64)
    parts = [words.take(pa.array(phrases[:, k])) for k in range(length)]
    text = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if length > 1 else parts[0]
    codes = fold(hashes[phrases]).view(np.int64) if len(phrases) else np.zeros(0, np.int64)
    if length == 1:  # one row more has the number of all words
        text, counts, codes = pa.concat_arrays([text, pa.array([None], pa.large_binary())]), np.append(counts, len(word)), np.append(codes, 0)
    columns = [pa.repeat(pa.scalar(lang), len(counts)), text.cast(pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(codes, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "a", "code"])


def _table_of(frequent: DataFrame) -> np.ndarray:
    """The bit table of the phrases: each bucket's bits are set by an aggregate, FILTER_BITS in all reach the driver."""
    at = F.col("code").bitwiseAND(FILTER_BITS - 1) + 1
    buckets = frequent.filter("phrase is not null").select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    table = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, bits in buckets.collect():
        part = np.frombuffer(bytes(bits), np.uint8)
        begin = (bucket - 1) * len(part)
        table[begin : begin + len(part)] = part[: len(table) - begin]
    return table


def frequent_phrases(texts: DataFrame, max_words: int, least: int) -> list[DataFrame]:
    """``(lang, phrase, a)`` of the phrases of 1, 2, ... words that occur ``least`` times or more; that of one word has a
    row with a null phrase for the number of all words of each language. All are written."""
    spark = texts.sparkSession
    levels: list[DataFrame] = []
    tables: list[np.ndarray] = []
    for length in range(1, max_words + 1):
        frequent = spark.sparkContext.broadcast(tables)

        def count(batches: Iterator[pa.RecordBatch], length: int = length, frequent=frequent) -> Iterator[pa.RecordBatch]:
            for lang, data in shards(batches):
                yield count_phrases(lang, data, length, Frequent(frequent.value))

        counted = texts.mapInArrow(count, "lang string, phrase string, a long, code long").groupBy("lang", "phrase").agg(F.sum("a").alias("a"), F.max("code").alias("code"))
        levels.append(materialise(counted.filter((F.col("a") >= least) | F.col("phrase").isNull()), f"phrases{length}"))
        if length < max_words:
            tables = [*tables, _table_of(levels[-1])]
    return levels


def collocations(docs: DataFrame, max_words: int = 3, least: int = 10, cover: int = 50, top: int = 2000, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of 2 to ``max_words`` words of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces into words at spaces and tabs. ``a`` counts a
    phrase's contiguous occurrences within pieces, overlaps included, ``n`` all words. A phrase that occurs ``least`` times is a
    candidate. Of its cuts into a first part (``l`` occurrences) and a rest (``r``) the one with the least
    ``score = floor(1000000 a a / (l r))`` counts, the earliest of equals. A candidate goes if a longer one holds it and has ``cover`` percent of its
    occurrences. Rank is by score, then ``a``, then the phrase's bytes.

    A shard of texts holds a compressed bitmap of positions for each word. Phrases grow depth-first from groups of first words: a
    bitmap shifted by one position and ANDed with another word's is that of the longer phrase, its popcount the shard's count;
    a free position between pieces keeps phrases inside. Counts are summed over shards, so nothing but counts is shuffled. A
    pass for each length prunes with the frequent phrases of the pass before, as a bit table of fixed size: what isn't
    frequent may pass it by chance and is dropped by its true count, so results are exact.

    A null lang is ``und``; null and empty texts have no words; repeated rows count each; a table without words gives no rows. Other
    columns play no part.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    levels = frequent_phrases(texts, max_words, least)
    counts = levels[0].filter("phrase is not null").select("lang", "phrase", "a")
    cuts = inside = None
    for length, level in enumerate(levels[1:], 2):
        counts = counts.union(level.select("lang", "phrase", "a"))
        words = F.split("phrase", " ", -1)
        part = lambda start, n, words=words: F.array_join(F.slice(words, start + 1, n), " ")
        found = level.select("lang", "phrase", "a", F.inline(F.array(*(F.struct(F.lit(k).alias("k"), part(0, k).alias("first"), part(k, length - k).alias("rest")) for k in range(1, length)))))
        cuts = found if cuts is None else cuts.union(found)
        if length > 2:
            held = level.select("lang", F.explode(F.array(*(part(s, n) for n in range(2, length) for s in range(length - n + 1)))).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
            inside = held if inside is None else inside.union(held)
    both = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")).hint("merge"), ["lang", "first"])
    both = both.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")).hint("merge"), ["lang", "rest"])
    exact = {c: F.col(c).cast("decimal(18,0)") for c in "alr"}
    both = both.withColumns({"aa": exact["a"] * exact["a"] * F.lit(1_000_000).cast("decimal(7,0)"), "lr": exact["l"] * exact["r"]})
    scored = both.select("lang", "phrase", "a", F.struct(F.expr("aa div lr").alias("score"), "k", "l", "r").alias("cut"), F.lit(None).cast("long").alias("longer"))
    if inside is not None:
        scored = scored.union(inside.select("lang", "phrase", F.lit(None).cast("long").alias("a"), F.lit(None).cast(scored.schema["cut"].dataType).alias("cut"), "longer"))
    scored = scored.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min("cut").alias("cut"), F.max("longer").alias("longer"))
    scored = scored.filter(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a"))).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    dealt = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    best = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = levels[0].filter("phrase is null").select("lang", F.col("a").alias("n"))
    out = materialise(ranked.join(totals.hint("merge"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")
    discard(*levels)
    return out
