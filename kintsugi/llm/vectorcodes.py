"""Vector code compression: product codes from exact integer rounds over Hilbert-sorted blocks.

Components become integers floor(scale * x) and vectors are cut into equal
parts.  Each task sorts the parts of its vectors, position by position, along a
Hilbert curve and cuts them into flat blocks; a block stores its points, its
min/max box and their sum.  Blocks are written once.  A round compares boxes
with codebook entries: an entry leaves a block's shortlist if its least distance
to the box exceeds another entry's greatest, or if the entry that reaches the
whole box best is nearer in every corner.  A block with one entry
left hands on its stored sum; the others compute exact integer distances of
their points to their shortlist alone.  Tasks add up counts and sums per entry,
Spark adds up tasks, and the codebooks (parts * entries * width numbers) are the
only thing the driver sees.

All arithmetic is in integers, so neither blocks nor partitions change a result.

Defined results: rows whose vector is null or holds null, NaN or infinite
components are dropped.  Vectors shorter than the longest kept one, or of a
length that the number of parts does not divide, are continued with zeros.  The
codebooks start from the smallest ids (null last; equal ids in the order of
their vectors); fewer kept rows than entries give smaller codebooks.  Repeated
rows are coded one by one and weigh as often as they occur.  An empty table
gives no rows and empty codebooks.  Components whose integers are too large for
64-bit squared distances (about 2^28 at 64 components) raise an error.  Input
columns that carry an output's name are replaced; the vector itself gives way to
its code, all other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kintsugi.llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Points of a block; components of the vectors sorted together.
BLOCK, CHUNK = 32, 1 << 20


@dataclass(frozen=True)
class Codebooks:
    """Entries (parts x entries x width)."""
    entries: np.ndarray

    def listed(self) -> str:
        """All components in decimal, by part, entry and position, joined by commas."""
        return ",".join(map(str, self.entries.ravel().tolist()))


def usable(vector: Column | str) -> Column:
    """Whether a vector is there and holds finite numbers only."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def integers(batch: pa.Array, dims: int, scale: float = SCALE) -> np.ndarray:
    """Rows of a list column as integers (rows x dims), continued with zeros."""
    size = np.diff(batch.offsets.to_numpy())
    flat = np.floor(batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    most = math.isqrt((1 << 62) // max(dims, 1)) // 2
    if len(flat) and np.abs(flat).max() > most:
        raise ValueError(f"a component times {scale} exceeds {most}: squared distances would not fit 64 bits")
    out = np.zeros((len(size), dims), np.int64)
    out[np.arange(dims) < size[:, None]] = flat.astype(np.int64)
    return out


def hilbert(points: np.ndarray) -> np.ndarray:
    """Place of each point (rows x width) on a Hilbert curve through the points' box.  The order only decides how
    tight blocks are; of wide points the 16 components that vary most are taken."""
    low = points.min(axis=0)
    span = points.max(axis=0) - low
    used = np.argsort(-span, kind="stable")[:16]
    bits = min(16, 63 // len(used))
    shift = max(0, int(span.max()).bit_length() - bits)
    x = [((points[:, k] - low[k]) >> shift).astype(np.int64) for k in used]
    # coordinates to the curve's transposed index: undo excess rotations from the top bit on, then Gray code
    bit = 1 << (bits - 1)
    while bit > 1:
        below = bit - 1
        for k in range(len(x)):
            turn = x[k] & bit > 0
            swap = np.where(turn, 0, (x[0] ^ x[k]) & below)
            x[0] = np.where(turn, x[0] ^ below, x[0] ^ swap)
            x[k] = x[k] ^ swap
        bit >>= 1
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    flip = np.zeros(len(points), np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where(x[-1] & bit > 0, bit - 1, 0)
        bit >>= 1
    place = np.zeros(len(points), np.int64)
    for b in range(bits - 1, -1, -1):
        for column in x:
            place = place << 1 | (column ^ flip) >> b & 1
    return place


def _small(numbers: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type that holds them."""
    top = int(np.abs(numbers).max(initial=0))
    return numbers.astype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64)


@dataclass
class Blocks:
    """The blocks of one part position of one chunk: points in curve order, the row of each, boxes and sums."""
    points: np.ndarray
    row: np.ndarray
    low: np.ndarray
    high: np.ndarray
    total: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray, block: int = BLOCK) -> Blocks:
        row = np.argsort(hilbert(points), kind="stable")
        points = points[row]
        begin = np.arange(0, len(points), block)
        return cls(points, row, np.minimum.reduceat(points, begin), np.maximum.reduceat(points, begin), np.add.reduceat(points, begin))

    def sizes(self, block: int = BLOCK) -> np.ndarray:
        return np.minimum(block, len(self.points) - np.arange(len(self.low)) * block)


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which entries can be nearest to a point of each box (boxes x entries), ties included."""
    under, over = low[:, None, :] - entries, entries - high[:, None, :]
    out = np.maximum(np.maximum(under, over), 0)
    far = np.maximum(np.abs(low[:, None, :] - entries), np.abs(high[:, None, :] - entries))
    least, greatest = np.einsum("bek,bek->be", out, out), np.einsum("bek,bek->be", far, far)
    listed = least <= greatest.min(axis=1, keepdims=True)
    # the entry that reaches the whole box best beats another one where it is nearer even in the corner that is
    # worst for it; the difference of the squared distances is linear in the point, so a corner decides
    star = entries[greatest.argmin(axis=1)][:, None, :]
    apart = entries - star
    corner = np.where(apart > 0, high[:, None, :], low[:, None, :])
    listed &= np.einsum("bek,bek->be", apart, 2 * corner - entries - star) >= 0
    return listed


def _kernels(blocks: Blocks, entries: np.ndarray, which: np.ndarray, lists: np.ndarray, block: int) -> Iterator[tuple]:
    """Blocks of about equal shortlists at a time: (rows in curve order, nearest entry, distance) of their points.
    Shortlists ascend and are filled up with their last entry, so the first least distance has the lowest index."""
    n = lists[which].sum(axis=1)
    width = 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(int)
    sizes = blocks.sizes(block)
    for w in np.unique(width):
        for some in np.array_split(which[width == w], -(-int((width == w).sum()) * block * int(w) // (1 << 20))):
            order = np.argsort(~lists[some], axis=1, kind="stable")[:, :w]
            full = lists[some].sum(axis=1)
            slot = np.minimum(np.arange(order.shape[1]), full[:, None] - 1)
            chosen = np.take_along_axis(order, slot, axis=1)
            at = some[:, None] * block + np.arange(block)
            real = np.arange(block) < sizes[some][:, None]
            points = blocks.points[np.minimum(at, len(blocks.points) - 1)].astype(np.int64)
            distance = np.zeros((len(some), block, chosen.shape[1]), np.int64)
            for k in range(entries.shape[1]):
                away = points[:, :, k, None] - entries[chosen, k][:, None, :]
                distance += away * away
            best = distance.argmin(axis=2)
            nearest = np.take_along_axis(chosen, best, axis=1)
            yield at[real], nearest[real], np.take_along_axis(distance, best[:, :, None], axis=2)[:, :, 0][real]


def tally(blocks: Blocks, entries: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Number and sum of the points nearest to each entry."""
    lists = shortlists(blocks.low.astype(np.int64), blocks.high.astype(np.int64), entries)
    single = lists.sum(axis=1) == 1
    n, total = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    only = lists[single].argmax(axis=1)
    np.add.at(n, only, blocks.sizes(block)[single])
    np.add.at(total, only, blocks.total[single])
    for rows, nearest, _ in _kernels(blocks, entries, np.flatnonzero(~single), lists, block):
        n += np.bincount(nearest, minlength=len(entries))
        np.add.at(total, nearest, blocks.points[rows].astype(np.int64))
    return n, total


def assign(blocks: Blocks, entries: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of each point, in the chunk's row order."""
    lists = shortlists(blocks.low.astype(np.int64), blocks.high.astype(np.int64), entries)
    code, error = np.zeros(len(blocks.points), np.int64), np.zeros(len(blocks.points), np.int64)
    for rows, nearest, distance in _kernels(blocks, entries, np.arange(len(lists)), lists, block):
        code[blocks.row[rows]], error[blocks.row[rows]] = nearest, distance
    return code, error


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have so many rows: blocks of many points have small boxes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


_SAVED = "n long, size int, points binary, row binary, low binary, high binary, total binary"


def _save(parts: list[Blocks]) -> list[pa.Array]:
    """One chunk's blocks of all part positions as one row."""
    points = _small(np.stack([b.points for b in parts]))
    boxes = [np.stack([getattr(b, x) for b in parts]).astype(points.dtype) for x in ("low", "high")]
    flat = [points, np.stack([b.row for b in parts]).astype(np.int32), *boxes, np.stack([b.total for b in parts])]
    return [pa.array([points.shape[1]], pa.int64()), pa.array([points.dtype.itemsize], pa.int32()),
            *(pa.array([x.tobytes()], pa.binary()) for x in flat)]


def _load(batch: pa.RecordBatch, i: int, parts: int, width: int, block: int) -> list[Blocks]:
    n, size = batch.column("n")[i].as_py(), batch.column("size")[i].as_py()
    n_blocks = -(-n // block)
    kind = np.dtype(f"int{8 * size}")

    def read(name: str, dtype: np.dtype, *shape: int) -> np.ndarray | list[None]:
        if name not in batch.schema.names:  # a pass reads the columns that it needs
            return [None] * parts
        return np.frombuffer(batch.column(name)[i].as_buffer(), dtype).reshape(parts, *shape)

    fields = (read("points", kind, n, width), read("row", np.dtype(np.int32), n), read("low", kind, n_blocks, width),
              read("high", kind, n_blocks, width), read("total", np.dtype(np.int64), n_blocks, width))
    return [Blocks(*(x[p] for x in fields)) for p in range(parts)]


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: float = SCALE, block: int = BLOCK) -> tuple[DataFrame, Codebooks]:
    """The kept rows of ``df`` without their vector, with ``code`` (one byte per part) and ``error`` (squared
    distance to the coded vector), and the final codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code of one byte per part needs 1 to 256 entries")
    spark = df.sparkSession
    rest = [c for c in df.columns if c not in (vector_col, "code", "error")]
    kept = df.where(usable(vector_col)).select(F.col(vector_col).cast("array<double>").alias("v"),
                                                F.struct(*rest).alias("rest") if rest else F.struct(F.lit(0).alias("_")).alias("rest"))
    first = df.where(usable(vector_col)).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).toArrow()["v"].combine_chunks()
    longest = df.where(usable(vector_col)).agg(F.max(F.size(vector_col))).first()[0] or 0
    width = -(-longest // parts)
    dims = width * parts
    rest_type = kept.schema["rest"].dataType
    if not len(first) or not width:
        empty = kept.select("rest.*", F.lit(bytes(parts)).alias("code"), F.lit(0).cast("long").alias("error"))
        return (empty if rest else empty.drop("_")), Codebooks(np.zeros((parts, len(first), 0), np.int64))
    start = first.chunk(0) if isinstance(first, pa.ChunkedArray) else first
    books = integers(start, dims, scale).reshape(-1, parts, width).transpose(1, 0, 2).copy()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CHUNK // dims)
        for batch in _gathered(batches, step):
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                vectors = integers(part.column(0), dims, scale).reshape(-1, parts, width)
                blocks = [Blocks.build(np.ascontiguousarray(vectors[:, p]), block) for p in range(parts)]
                rows = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(1))
                yield pa.RecordBatch.from_arrays([*_save(blocks), rows],
                                                 names=["n", "size", "points", "row", "low", "high", "total", "rest"])

    saved = T.StructType([*T._parse_datatype_string(_SAVED).fields, T.StructField("rest", T.ArrayType(rest_type))])
    table = stored(kept.mapInArrow(pack, saved))

    for _ in range(rounds):
        now = books

        def add(batches: Iterator[pa.RecordBatch], now: np.ndarray = now) -> Iterator[pa.RecordBatch]:
            held = np.zeros((parts, now.shape[1], width + 1), np.int64)
            for batch in batches:
                for i in range(batch.num_rows):
                    for p, blocks in enumerate(_load(batch, i, parts, width, block)):
                        n, total = tally(blocks, now[p], block)
                        held[p, :, 0] += n
                        held[p, :, 1:] += total
            flat = held.ravel()
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["slot", "total"])

        got = table.select(*[c for c in table.columns if c not in ("row", "rest")]) \
            .mapInArrow(add, "slot long, total long").groupBy("slot").agg(F.sum("total").alias("total")).toArrow()
        flat = np.zeros(parts * now.shape[1] * (width + 1), np.int64)
        flat[got["slot"].to_numpy()] = got["total"].to_numpy()
        sums = flat.reshape(parts, -1, width + 1)
        n = sums[:, :, :1]
        books = np.where(n > 0, sums[:, :, 1:] // np.maximum(n, 1), now)

    final = books

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = [assign(b, final[p], block) for p, b in enumerate(_load(batch, i, parts, width, block))]
                codes = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
                rows = batch.column("rest").slice(i, 1).flatten()
                for at in range(0, len(rows), 10_000):
                    some = codes[at:at + 10_000]
                    out = pa.FixedSizeBinaryArray.from_buffers(pa.binary(parts), len(some), [None, pa.py_buffer(some.tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [rows.slice(at, 10_000), out.cast(pa.binary()), pa.array(sum(e for _, e in found)[at:at + 10_000])],
                        names=["rest", "code", "error"])

    out = table.drop("total").mapInArrow(code, T.StructType([T.StructField("rest", rest_type), T.StructField("code", T.BinaryType()),
                                                             T.StructField("error", T.LongType())]))
    coded = out.select("rest.*", "code", "error")
    return (coded if rest else coded.drop("_")), Codebooks(books)


def compress_sql(table: str = "embeddings", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The columns of ``op11_vectorcodes`` as DuckDB SQL."""
    steps, book = [], "c0"
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS (SELECT vec_id, p, arg_min(e, struct_pack(d := d, e := e)) AS e, min(d) AS d FROM (
            SELECT x.vec_id, x.p, c.e, list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
            FROM x JOIN {book} c USING (p)) GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT p, e, i, CAST(floor(sum(z)::DECIMAL(38, 0) / count(*)) AS BIGINT) AS z FROM (
                SELECT d.p, d.e, unnest(x.v) AS z, unnest(range(len(x.v))) AS i FROM d{r} d JOIN x USING (vec_id, p)) GROUP BY p, e, i),
            c{r + 1} AS (SELECT c.p, c.e, coalesce(m.v, c.v) AS v FROM {book} c
                LEFT JOIN (SELECT p, e, list(z ORDER BY i) AS v FROM m{r} GROUP BY p, e) m USING (p, e))""")
            book = f"c{r + 1}"
    return f"""
    WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM {table}
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    x AS (SELECT vec_id, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS v FROM k, range({parts}) AS r(p)),
    c0 AS (SELECT p, CAST(row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS BIGINT) AS e, v FROM x
           WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {entries})),
    {", ".join(steps)},
    s AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM {book}),
    o AS (SELECT vec_id, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM d{rounds} GROUP BY vec_id)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM o JOIN k USING (vec_id), s"""
