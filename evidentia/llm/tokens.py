"""Token counts and token ids of whole texts, through tables of pre-token results."""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import materialise, small_batches

#: Pre-tokens in the broadcast tier, and in each summary that is merged into it.
FREQUENT = 20_000
#: Entries of a worker's cache, and the longest pre-token that it keeps (code points).
CACHE_ENTRIES, CACHE_LENGTH = 300_000, 48
#: Summaries merged by one task.
FAN_IN = 32


#: Where any text may be cut: at a single space between two words, and before a single line end between two words.
BORDER = re.compile(r"(?<=\S) (?=\S)|(?<=\S)(?=\n\S)")


def split_borders(text: str) -> list[str]:
    """The pre-tokens of a text that isn't empty.

    Words are cut at single spaces and line ends between them; a word after a line end carries it, words after a
    space stand bare. White space of any other kind (runs, tabs, blank lines, ends of the text) stays inside its
    pre-token, between the words beside it. The first pre-token has nothing before it.
    """
    if not (text[0].isspace() or text[-1].isspace() or "  " in text or "\n\n" in text or " \n" in text or "\n " in text) and len(text.split()) == text.count(" ") + text.count("\n") + 1:
        return text.replace("\n", " \n").split(" ")
    return BORDER.split(text)


class Cache(dict):
    """Results by pre-token; a miss is computed, and kept while there is room."""

    def __init__(self, compute: Callable, first: dict | None = None) -> None:
        super().__init__(first or {})
        self.compute = compute
        self.room = CACHE_ENTRIES

    def __missing__(self, key):
        value = self.compute(key)
        if self.room > 0 and len(key) <= CACHE_LENGTH:
            self.room -= 1
            self[key] = value
        return value


class PieceCounter:
    """Counts of a SentencePiece BPE model, as the library counts whole texts.

    A word after a space begins with the model's space symbol, and no piece has that symbol after
    another character or has a line end beside another character; so merges never cross the borders of
    ``split_borders``. Texts with the space symbol itself go to the library whole.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.exact = not any("▁" in p.lstrip("▁") or ("\n" in p and len(p) > 1) for p in pieces)
        self.cache = Cache(self.count_part)

    def count_part(self, part: str) -> int:
        ids = self.model.encode(part, num_threads=1)
        return len(ids) - (part[0] == "\n")  # after a line end the model's leading space isn't there

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.exact or "▁" in text:
            return len(self.model.encode(text, num_threads=1))
        first, *rest = split_borders(text)
        # Nothing stands before the first pre-token, so a line end that begins it is its own.
        own = len(self.model.encode(first, num_threads=1)) if first[0].isspace() else self.cache[first]
        return own + sum(map(self.cache.__getitem__, rest))


def _top(counts: Counter, n: int) -> list[tuple[str, int]]:
    return heapq.nlargest(n, counts.items(), key=lambda x: (x[1], x[0]))


def frequent_pretokens(docs: DataFrame, text_col: str = "text", size: int = FREQUENT) -> list[str]:
    """About the ``size`` most frequent pre-tokens of the whole column.

    Each task counts its own texts into one row, a summary of bounded size; summaries are merged
    ``FAN_IN`` at a time until few are left. So no pre-token is shuffled by itself, and the driver reads at most
    ``FAN_IN`` bounded rows. The list only decides speed, never a result.
    """
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total.update(x for x in split_borders(text) if len(x) <= CACHE_LENGTH) if text else None
            if len(total) > 20 * size:
                total = Counter(dict(_top(total, 10 * size)))
        yield summary(total)

    def summary(total: Counter) -> pa.RecordBatch:
        best = _top(total, size)
        return pa.RecordBatch.from_arrays([pa.array([[w for w, _ in best]], pa.list_(pa.string())), pa.array([[n for _, n in best]], pa.list_(pa.int64()))], names=["words", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for words, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w, n in zip(words, counts, strict=True):
                    total[w] += n
        yield summary(total)

    shape = "words array<string>, counts array<long>"
    level = materialise(docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, shape), "frequent")
    while (rows := level.count()) > FAN_IN:
        level = materialise(level.repartition(-(-rows // FAN_IN)).mapInArrow(merge, shape), "frequent")
    total: Counter = Counter()
    for words, counts in level.collect():
        total.update(dict(zip(words, counts, strict=True)))
    return [w for w, _ in _top(total, size)]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """``(id, n_bytes, n_tokens)`` for each row, tokens as SentencePiece counts the whole text, without begin or end.

    Two tiers, both on the map side: the lengths of the most frequent pre-tokens, encoded once on the
    driver and broadcast (``frequent`` entries at most), then a bounded cache in each worker, which
    encodes misses. Null and empty texts have 0 bytes and 0 tokens. Rows are neither joined nor
    shuffled, so repeated rows and null ids pass through. Texts of any length are counted whole.
    """
    spark = docs.sparkSession
    counter = PieceCounter(model_path)
    tier = {w: counter.count_part(w) for w in frequent_pretokens(docs, text_col, frequent)} if frequent else {}
    table = spark.sparkContext.broadcast(tier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = PieceCounter(model_path)
        worker.cache.update(table.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n_bytes = [len(t.encode()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array([worker.count(t) for t in texts], pa.int64())], names=["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("id", id_col)


class ByteEncoder:
    """Ids of a byte-level BPE vocabulary, as ``tokenizers`` gives them for whole texts, as little-endian 32-bit bytes.

    The vocabulary is read from its JSON file and run by tiktoken, which is faster and gives the same
    ids; texts with the string of a special token go to ``tokenizers`` itself. Its split pattern never
    joins the two sides of a single space or line end between words, hence ``split_borders``.
    """

    def __init__(self, path: str) -> None:
        import json

        import tiktoken
        from tokenizers import Tokenizer

        spec = json.loads(open(path, encoding="utf-8").read())
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        back = self._letters()
        ranks = {bytes(back[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in self.special}
        # Pieces by letters, digits and other signs, each with a space before it, as this kind of vocabulary has it; White_Space as in Unicode.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cache = Cache(self.encode_part)

    @staticmethod
    def _letters() -> dict[str, int]:
        """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, others from 256 on."""
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}

    def pack(self, ids: list[int]) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def encode_part(self, part: str) -> bytes:
        return self.pack(self.fast.encode_ordinary(part if part[0] == "\n" else " " + part))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = split_borders(text)
        return self.pack(self.fast.encode_ordinary(parts[0])) + b"".join(map(self.cache.__getitem__, parts[1:]))
