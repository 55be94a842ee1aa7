"""Exact dense top-k for any number of queries: vectors in blocks, blocks skipped by their bounds, products of matrices."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidentia.plans.shared import delete, small_batches, written

#: Digits to which scores are rounded before they are ranked, so that ties are ties on every engine.
DIGITS = 6
#: Rows of a block: the square root of the number of vectors, within these limits; so bounds are as few as rows of a block.
LEAST_ROWS, MOST_ROWS = 256, 16_384
#: Bytes of vectors that a task holds of either side at a time, and scores that it holds at a time.
SIDE_BYTES, TILE = 2 << 20, 1 << 21
#: What a score may be off by rounding when it is compared with a bound.
SLACK = 2.5e-6


def _matrix(column: pa.Array) -> list[np.ndarray]:
    """A matrix for each row of a column of flat arrays; ``size`` rows each."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    return [flat[a:z] for a, z in zip(offsets, offsets[1:], strict=False)]


def _rows(data: pa.Scalar, n: int, kind: str) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), kind).reshape(n, -1)


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))


def _rounded(s: np.ndarray) -> np.ndarray:
    """Halves away from zero."""
    scaled = np.abs(s) * 10.0**DIGITS
    return np.where(scaled < 2.0**52, np.copysign(np.floor(scaled + 0.5), s) / 10.0**DIGITS, s) + 0.0


def _first(k: int, row: np.ndarray) -> np.ndarray:
    """Which of the sorted ``row`` are among the first k of their kind."""
    begins = np.flatnonzero(np.diff(row, prepend=-1))
    return np.arange(len(row)) - np.repeat(begins, np.diff(begins, append=len(row))) < k


class Blocks:
    """Rows ``(block, ids, data, centre, radius)`` of vectors near one pivot, as written; ids in order, data as bytes of ``kind``."""

    def __init__(self, rows: DataFrame, pivots: np.ndarray, rows_a_block: int, kind: str) -> None:
        """``rows``: (id, v). Each goes to its nearest pivot; pivots with more than ``rows_a_block`` rows take several blocks."""
        spark, types = rows.sparkSession, {f.name: f.dataType.simpleString() for f in rows.schema}
        held = spark.sparkContext.broadcast(pivots)

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    x = np.concatenate(_matrix(batch.column(1))).reshape(len(batch), -1).astype(float)
                    far = (held.value**2).sum(1) - 2 * x @ held.value.T
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(far.argmin(1).astype(np.int32))], names=["id", "v", "cell"])

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, found = batch.column(1).value_lengths().to_pylist(), []
                for n, flat in zip(sizes, _matrix(batch.column(2)), strict=True):
                    x = flat.reshape(n, -1).astype(float)
                    centre = x.mean(0)
                    found.append((flat.astype(kind).tobytes(), centre.tolist(), float(np.sqrt(((x - centre) ** 2).sum(1).max()))))
                columns = zip(*found, strict=True) if found else ((), (), ())
                more = [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.list_(pa.float64()), pa.float64()), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *more], names=["block", "ids", "data", "centre", "radius"])

        placed = written(rows.mapInArrow(near, f"id {types['id']}, v {types['v']}, cell int").withColumn("deal", F.xxhash64(F.monotonically_increasing_id())), "placed")
        cells = placed.groupBy("cell").agg(F.ceil(F.count("*") / rows_a_block).cast("int").alias("parts")).filter("parts > 1")
        # At most as many split cells as there are pivots.
        split = {r.cell: r.parts for r in cells.collect()}
        parts = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in split.items() for x in pair)), F.col("cell")), F.lit(1)) if split else F.lit(1)
        block = F.struct("cell", F.pmod("deal", parts).cast("int").alias("part"))
        grouped = placed.select(block.alias("block"), F.struct("id", "v").alias("x")).groupBy("block").agg(F.array_sort(F.collect_list("x")).alias("x"))
        grouped = grouped.select("block", F.col("x.id").alias("ids"), F.flatten("x.v").alias("v"))
        self.table = written(grouped.mapInArrow(packed, f"block struct<cell int, part int>, ids array<{types['id']}>, data binary, centre array<double>, radius double"), "blocks")
        delete(placed)

    def bounds(self) -> tuple[list, np.ndarray, np.ndarray]:
        """Block keys, centres and numbers of rows, which the driver reads: one row a block."""
        rows = sorted(self.table.select("block", "centre", F.size("ids").alias("n")).collect(), key=lambda r: r.block)
        return [tuple(r.block) for r in rows], np.array([r.centre for r in rows]), np.array([r.n for r in rows])


class _Asked:
    """A task's queries of one group, and the best rows that they have met so far."""

    def __init__(self, ids: pa.Array, q: np.ndarray, floors: np.ndarray, k: int | None) -> None:
        self.ids, self.q, self.floors, self.k = ids, q.astype(float), floors.copy(), k
        self.lengths, self.short = np.sqrt((self.q**2).sum(1)), q.astype(np.float32)
        self.found: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

    def meet(self, ids: pa.Array, x: np.ndarray, centre: np.ndarray, radius: float) -> Iterator[pa.RecordBatch]:
        """Scores a block: in single precision those that may count, these again in double precision. Without k all rows come out at once."""
        at = np.flatnonzero(self.q @ centre + self.lengths * radius >= self.floors - SLACK)
        x, longest = x.astype(float), float(np.sqrt((x.astype(float) ** 2).sum(1).max()))
        fits = longest * self.lengths.max(initial=0) < 1e30 and max(longest, self.lengths.max(initial=0)) < 1e30
        q, other = (self.short, x.astype(np.float32)) if fits else (self.q, x)
        off = SLACK + (x.shape[1] + 4) * 2.0**-23 * longest * self.lengths
        step = max(1, TILE // len(x))
        for i in range(0, len(at), step):
            tile = at[i : i + step]
            s = q[tile] @ other.T
            least = self.floors[tile]
            if self.k is not None and len(ids) > self.k and np.isneginf(least).any():
                least = np.maximum(least, np.partition(s, len(ids) - self.k, axis=1)[:, len(ids) - self.k] - off[tile])
            row, col = np.nonzero(s >= (least - off[tile])[:, None])
            exact = np.concatenate([np.einsum("ij,ij->i", self.q[tile[row[j : j + (1 << 16)]]], x[col[j : j + (1 << 16)]]) for j in range(0, len(row), 1 << 16)] or [np.zeros(0)])
            score, row = _rounded(exact), tile[row]
            if self.k is None:
                yield self._out(row, score, ids.take(pa.array(col)))
                continue
            keep = np.flatnonzero(score >= self.floors[row] - SLACK)
            keep = keep[np.lexsort((col[keep], -score[keep], row[keep]))]
            keep = keep[_first(self.k, row[keep])]  # a block's ids are in order
            if len(keep):
                self.found.append((row[keep], score[keep], ids.take(pa.array(col[keep]))))
        if sum(len(f[0]) for f in self.found) > max(TILE // 8, 2 * (self.k or 0) * len(self.q)):
            self.settle()

    def settle(self) -> None:
        """Keeps the k best of each query, whose last is its floor from now on."""
        if self.found:
            row, score, ids = (np.concatenate([f[0] for f in self.found]), np.concatenate([f[1] for f in self.found]), pa.concat_arrays([f[2] for f in self.found]))
            order = pc.sort_indices(pa.table({"row": row, "score": score, "id": ids}), [("row", "ascending"), ("score", "descending"), ("id", "ascending")]).to_numpy()
            order = order[_first(self.k, row[order])]
            row, score, ids = row[order], score[order], ids.take(pa.array(order))
            full = np.flatnonzero(~_first(self.k - 1, row))
            self.floors[row[full]] = np.maximum(self.floors[row[full]], score[full])
            self.found = [(row, score, ids)]

    def best(self) -> Iterator[pa.RecordBatch]:
        self.settle()
        for row, score, ids in self.found:
            yield self._out(row, score, ids)

    def _out(self, row: np.ndarray, score: np.ndarray, ids: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([self.ids.take(pa.array(row)), ids, pa.array(score)], names=["qid", "id", "score"])


def _ranked(found: DataFrame, k: int | None) -> DataFrame:
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), F.asc("id"))))
    return best if k is None else best.filter(F.col("rank") <= k)


def _scanned(rows: DataFrame, asked: DataFrame, k: int, asked_kind: str, kind: str) -> DataFrame:
    """``(qid, id, score)`` with the k best rows of each query in each task: every task meets all queries, which are sent to workers."""
    spark, qid, vid = rows.sparkSession, asked.schema["id"].dataType.simpleString(), rows.schema["id"].dataType.simpleString()
    told = asked.collect()
    held = spark.sparkContext.broadcast(([r.id for r in told], np.array([r.v for r in told], asked_kind)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = held.value
        met = _Asked(pa.array(ids, _ARROW[qid]), q, np.full(len(ids), -np.inf), k)
        for batch in batches:
            if len(batch):
                order = pc.sort_indices(batch.column(0))
                x = np.concatenate(_matrix(batch.column(1))).reshape(len(batch), -1).astype(kind)[order.to_numpy()]
                centre = x.astype(float).mean(0)
                radius = float(np.sqrt(((x.astype(float) - centre) ** 2).sum(1).max()))
                yield from met.meet(batch.column(0).take(order), x, centre, radius)
                met.settle()
        yield from met.best()

    return rows.mapInArrow(scan, f"qid {qid}, id {vid}, score double")


def top_k(vectors: DataFrame, queries: DataFrame, k: int | None, id_col: str, vector_col: str, qid_col: str, query_col: str) -> DataFrame:
    """``(qid, id, score, rank)``: the k largest inner products (all if None) for each query, ties by id.

    Vectors are dealt to the nearest of about ``sqrt(n)`` pivots, those of least hash, and each pivot's to blocks. No row of a block scores
    above ``q . centre + |q| radius``. Each query first meets the block of the best centre, whose k-th score is a floor. Then groups of
    queries, one a task, meet all blocks, which are read again for each group and not shuffled by pair: a task keeps the k
    best rows of each of its queries, whose last raises the floor, and blocks whose bounds are below the floors of all are skipped. So what is
    shuffled and written grows with the rows; the products grow with the pairs that no bound excludes. What workers and driver hold of all vectors are
    pivots and centres. LEAST_ROWS queries, or no more than there would be pivots, meet all vectors where these lie: to find a row's pivot
    would cost as many products as its scores. Null vectors have no rows; all others have one length. Ids are taken as unique.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    wide = lambda df, column: "float" if df.schema[column].dataType.simpleString() == "array<float>" else "double"
    kinds, asked_kind = {"float": "f4", "double": "f8"}[wide(vectors, vector_col)], {"float": "f4", "double": "f8"}[wide(queries, query_col)]
    # Written before nulls go: a filter moves below what makes the vectors, and an encoder would run twice for each row.
    made = written(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(f"array<{wide(vectors, vector_col)}>").alias("v")), "vectors")
    put = written(queries.select(F.col(qid_col).alias("id"), F.col(query_col).cast(f"array<{wide(queries, query_col)}>").alias("v")), "asked")
    rows, asked = made.filter("v is not null"), put.filter("v is not null")
    qid, vid = asked.schema["id"].dataType.simpleString(), rows.schema["id"].dataType.simpleString()
    n, n_asked = rows.count(), asked.count()
    if not n or not n_asked:
        return spark.createDataFrame([], f"qid {qid}, id {vid}, score double, rank int")
    size = min(MOST_ROWS, max(LEAST_ROWS, math.isqrt(n)))
    if k is not None and n_asked <= max(LEAST_ROWS, -(-n // size)):
        return _ranked(_scanned(rows, asked, k, asked_kind, kinds), k)
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(-(-n // size)).select("v").collect()
    pivots = np.array([r.v for r in picked], float)
    data = Blocks(rows, pivots, size, kinds)
    delete(made)
    held = spark.sparkContext.broadcast(data.bounds())
    group = {"ids": pa.list_(_ARROW[qid]), "data": pa.binary()}
    key = pa.struct([("cell", pa.int32()), ("part", pa.int32())])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A batch's queries with the block of the best centre, of those that hold k rows if any does."""
        keys, centres, counts = held.value
        for batch in batches:
            if len(batch):
                v = np.concatenate(_matrix(batch.column(1))).reshape(len(batch), -1)
                best = np.where(counts >= min(k, counts.max()), v.astype(float) @ centres.T, -np.inf).argmax(1)
                for b in np.unique(best):
                    at = np.flatnonzero(best == b)
                    yield _batch([({"cell": keys[b][0], "part": keys[b][1]}, batch.column(0).take(pa.array(at)).to_pylist(), v[at].tobytes())], {"block": key} | group)

    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ids, m = batch.column(0)[i].values, len(batch.column(2)[i].values)
                q, x = _rows(batch.column(1)[i], len(ids), asked_kind), _rows(batch.column(3)[i], m, kinds).astype(float)
                step = max(1, TILE // m)
                kth = [np.partition(q[j : j + step].astype(float) @ x.T, m - k, axis=1)[:, m - k] if m >= k else np.full(len(q[j : j + step]), -np.inf) for j in range(0, len(q), step)]
                yield pa.RecordBatch.from_arrays([ids, pa.array([v.tobytes() for v in q], pa.binary()), pa.array(np.concatenate(kth))], names=["id", "data", "floor"])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in _matrix(batch.column(1))], pa.binary()), pa.array(np.full(len(batch), -np.inf))], names=["id", "data", "floor"])

    one = f"id {qid}, data binary, floor double"
    if k is None:
        floors = asked.mapInArrow(alone, one)
    else:
        met = asked.mapInArrow(first, f"block struct<cell int, part int>, ids array<{qid}>, data binary")
        met = met.join(data.table.select("block", F.col("ids").alias("others"), F.col("data").alias("x")).hint("merge"), "block")
        floors = met.select("ids", "data", "others", "x").mapInArrow(floor, one)

    # Groups of queries and, if these are few, parts of the vectors: some tasks for each core, and no more rows than bytes of a side.
    tasks, most = 3 * spark.sparkContext.defaultParallelism, max(1, SIDE_BYTES // (pivots.shape[1] * 8))
    groups = -(-n_asked // min(most, max(LEAST_ROWS, -(-n_asked // tasks))))
    parts = -(-tasks // groups) if groups < tasks else 1
    run = min(most, -(-n // (4 * parts)))

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The queries of a partition as one row."""
        ids, vectors, floors = [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            vectors += batch.column(1).to_pylist()
            floors.append(batch.column(2).to_numpy())
        if ids:
            yield _batch([(ids, b"".join(vectors), np.concatenate(floors).tobytes())], group | {"floors": pa.binary()})

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks in runs of about ``run`` rows."""
        types = {"sizes": pa.list_(pa.int32()), "others": pa.list_(_ARROW[vid]), "x": pa.binary(), "centres": pa.list_(pa.float64()), "radii": pa.list_(pa.float64())}
        some: list[tuple] = []
        flat = lambda at: [y for r in some for y in r[at]]
        row = lambda: _batch([([len(r[0]) for r in some], flat(0), b"".join(r[1] for r in some), flat(2), [r[3] for r in some])], types)
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                some.append(r)
                if sum(len(r[0]) for r in some) >= run:
                    yield row()
                    some.clear()
        if some:
            yield row()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, _Asked] = {}
        for batch in batches:
            for i in range(len(batch)):
                sizes, others, x, centres, radii, number, ids, data, floors = (c[i] for c in batch.columns)
                number = number.as_py()
                if number not in known:
                    known[number] = _Asked(ids.values, _rows(data, len(ids.values), asked_kind), np.frombuffer(floors.as_buffer()), k)
                sizes = sizes.values.to_numpy()
                x, centres, at = _rows(x, sizes.sum(), kinds), centres.values.to_numpy().reshape(len(sizes), -1), 0
                for m, centre, radius in zip(sizes, centres, radii.values.to_numpy(), strict=True):
                    yield from known[number].meet(others.values[at : at + m], x[at : at + m], centre, radius)
                    at += m
        for asked_ in known.values():
            yield from asked_.best() if k is not None else ()

    ask = floors.repartitionById(groups, F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")).mapInArrow(together, f"ids array<{qid}>, data binary, floors binary")
    ask = ask.select(F.monotonically_increasing_id().alias("number"), "*")
    blocks = data.table.select("ids", "data", "centre", "radius").mapInArrow(runs, f"sizes array<int>, others array<{vid}>, x binary, centres array<double>, radii array<double>").repartition(parts)
    found = blocks.hint("shuffle_replicate_nl").crossJoin(ask).mapInArrow(score, f"qid {qid}, id {vid}, score double")
    return _ranked(found, k)


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "string": pa.string()}
