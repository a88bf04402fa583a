"""Hard negatives by rotated one-bit codes whose errors are bounded.

Vectors become whole numbers. An orthogonal matrix turns them all; the signs of a turned vector are its first code, and the
cosine between code and vector is stored as its alignment. What the code leaves over is turned again and gets a code of its own,
``LAYERS`` times, so that a vector is known from its codes up to a remainder of known length. An anchor's turned vectors are
rounded to a few bits an entry; its product with a code is then a sum of popcounts. By Cauchy and Schwarz the true product lies
within the anchor's length times the remainder's, and each code's length times the anchor's rounding error, of that estimate: an
interval that holds for certain. Only rows whose interval reaches the places that still count are scored, in whole numbers.

Rows are dealt into shards that a task can hold, by a hash of the row, and every shard meets all anchors, which stream by in blocks:
first for the positives, then, with the positives' scores, for the negatives. A shard returns its best rows of each search only, so
a search over all shards is a short ranking. Nothing is collected or broadcast, and no pair of rows is ever written.

Defined results: rows with a null id or label, a null vector, or any null or non-finite entry take no part; shorter vectors count as
padded with zeros; rows alike in id, label and vector count once, others with one id count each; equal scores are ordered by id; an
anchor alone with its label has no positives and no rows; an empty table gives none; other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.vectors import matrix, usable, whole
from reviewmill.session import keep

#: One-bit codes a vector, each of what those before it left over.
LAYERS = 5
#: Bits an entry of a turned anchor.
BITS = 8
#: Bytes of the whole-number vectors in a shard.
SHARD_BYTES = 1 << 27
#: Rows below which a shard is not worth a visit of all anchors.
SHARD_ROWS = 1024
#: Estimates that a task holds at a time.
ESTIMATES = 1 << 20
#: Share of the product of two lengths that rounding in floating point may cost.
SLACK = 1e-9
#: Largest whole number of a vector entry.
LARGEST = 2**31 - 1


def rotations(width: int, layers: int = LAYERS) -> np.ndarray:
    """An orthogonal matrix a layer; their size is the next multiple of 64."""
    size = 64 * max(1, -(-width // 64))
    q, r = np.linalg.qr(np.random.default_rng(size).normal(size=(layers, size, size)))
    return q * np.sign(np.diagonal(r, axis1=1, axis2=2))[:, None, :]


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=-1).view(np.uint64)


def _padded(vectors: np.ndarray, size: int) -> np.ndarray:
    return np.pad(vectors.astype(float), ((0, 0), (0, size - vectors.shape[1])))


def encode(vectors: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, layers, words), alignments (rows, layers) and lengths of whole-number vectors."""
    size = turns.shape[1]
    rest = _padded(vectors, size)
    lengths = np.linalg.norm(rest, axis=1)
    codes, alignments = [], []
    for turn in turns:
        rest = rest @ turn
        signs = rest >= 0
        length = np.linalg.norm(rest, axis=1)
        along = np.abs(rest).sum(axis=1) / size
        alignments.append(np.divide(along * math.sqrt(size), length, out=np.zeros(len(rest)), where=length > 0))
        rest = rest - np.where(signs, 1.0, -1.0) * along[:, None]
        codes.append(_packed(signs))
    return np.stack(codes, axis=1), np.stack(alignments, axis=1), lengths


class Shard:
    """Rows of a shard: whole numbers, codes, and the bounds that follow from them."""

    def __init__(self, ids: pa.Array, vectors: np.ndarray, codes: np.ndarray, alignments: np.ndarray, lengths: np.ndarray):
        self.ids, self.vectors, self.codes, self.lengths = ids, vectors, codes, lengths
        self.order = pc.rank(ids, sort_keys="ascending", tiebreaker="dense").to_numpy() if len(ids) else np.zeros(0, np.int64)
        self.size = 64 * codes.shape[2]
        remainder = lengths.copy()
        self.steps = np.zeros(alignments.shape)  # what a code counts for
        for layer in range(alignments.shape[1]):
            self.steps[:, layer] = remainder * alignments[:, layer] / math.sqrt(self.size)
            remainder = remainder * np.sqrt(np.maximum(0.0, 1 - alignments[:, layer] ** 2))
        self.remainder = remainder

    def bounds(self, anchors: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the products (rows, anchors) with whole-number anchors."""
        q = _padded(anchors, self.size)
        length = np.linalg.norm(q, axis=1)
        estimate = np.zeros((len(self.codes), len(q)))
        half = self.remainder[:, None] * length + SLACK * (1 + self.lengths[:, None] * length)
        for layer, turn in enumerate(turns):
            q = q @ turn
            low = q.min(axis=1, keepdims=True)
            step = np.maximum((q.max(axis=1, keepdims=True) - low) / (2**BITS - 1), 1e-300)
            rounded = np.rint((q - low) / step).astype(np.int64)
            error = np.linalg.norm(q - (low + step * rounded), axis=1)
            codes = self.codes[:, layer]
            ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
            dot = np.zeros(estimate.shape, np.int32)
            for bit in range(BITS):
                plane = _packed((rounded >> bit) & 1 > 0)
                for word in range(codes.shape[1]):
                    dot += np.left_shift(np.bitwise_count(codes[:, word, None] & plane[None, :, word]), bit, dtype=np.int32)
            signed = low.T * (2 * ones[:, None] - self.size) + step.T * (2 * dot - rounded.sum(axis=1)[None, :])
            estimate += self.steps[:, layer, None] * signed
            half += (self.steps[:, layer] * math.sqrt(self.size))[:, None] * error
        return estimate - half, estimate + half

    def best(
        self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, eligible: np.ndarray, windows: list[tuple[int, int]], k: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window of scores the places and scores of the first ``k`` eligible rows in it."""
        wanted = np.zeros(len(eligible), bool)
        for least, most in windows:
            inside = eligible & (low >= least) & (high <= most)
            start = least
            if np.count_nonzero(inside) >= k:  # so many rows are in the window for certain, and no lower one counts
                start = max(start, np.partition(low[inside], -k)[-k])
            wanted |= eligible & (high >= start) & (low <= most)
        places = np.flatnonzero(wanted)
        scores = self.vectors[places] @ anchor
        found = []
        for least, most in windows:
            at = np.flatnonzero((scores >= least) & (scores <= most))
            if len(at) > 8 * k:  # all that tie with the last one stay until they are ordered
                at = at[scores[at] >= np.partition(scores[at], -k)[-k]]
            first = np.lexsort((self.order[places[at]], -scores[at]))[:k]
            found.append((places[at[first]], scores[at[first]]))
        return found


def _search(rows: DataFrame, anchors: DataFrame, shards: int, width: int, k: int, same: bool, id_type: str) -> DataFrame:
    """Rows (anchor, target, score, id): each shard's first ``k`` rows for each anchor and target.

    Without targets an anchor looks for rows of its label other than itself; with them for rows of other labels in
    the window of each target.
    """
    spark = rows.sparkSession
    turns = spark.sparkContext.broadcast(rotations(width))
    nothing = F.lit(None)
    data = rows.select(
        "shard", F.lit(0).alias("kind"), nothing.cast("long").alias("anchor"), "id", "label", "vector", "codes", "alignments", "length",
        nothing.cast("array<long>").alias("targets"),
    )
    targets = nothing.cast("array<long>") if same else F.col("targets")
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "anchor", "id", "label", "vector",
        nothing.cast("binary").alias("codes"), nothing.cast("binary").alias("alignments"), nothing.cast("double").alias("length"),
        targets.alias("targets"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = turns.value
        number, parts, block, shard, labels = None, [], [], None, {}

        def build():
            nonlocal shard, labels
            held = pa.Table.from_batches(parts) if parts else None
            count = held.num_rows if held else 0
            if not count:
                shard = None
                return
            vectors = _whole_rows(held.column("vector"), width)
            codes = np.frombuffer(b"".join(held.column("codes").to_pylist()), np.uint64).reshape(count, -1, r.shape[1] // 64)
            alignments = np.frombuffer(b"".join(held.column("alignments").to_pylist())).reshape(count, -1)
            shard = Shard(held.column("id").combine_chunks(), vectors, codes, alignments, held.column("length").to_numpy())
            labels = {}
            own = np.fromiter((labels.setdefault(x, len(labels)) for x in held.column("label").to_pylist()), np.int64, count)
            shard.labels = own

        def search(asked: list[pa.RecordBatch]):
            table = pa.Table.from_batches(asked)
            vectors = _whole_rows(table.column("vector"), width)
            longest = np.linalg.norm(vectors.astype(float), axis=1).max() * shard.lengths.max()
            if longest >= 2.0**62:
                raise OverflowError("scores do not fit a long")
            own_labels = [labels.get(x, -1) for x in table.column("label").to_pylist()]
            anchor_numbers, ids = table.column("anchor").to_pylist(), table.column("id").to_pylist()
            targets = table.column("targets").to_pylist()
            step = max(1, ESTIMATES // len(shard.codes))
            out = [[], [], [], []]
            for start in range(0, len(vectors), step):
                lows, highs = shard.bounds(vectors[start : start + step], r)
                for j in range(lows.shape[1]):
                    i = start + j
                    if same:
                        eligible = shard.labels == own_labels[i]
                        itself = np.flatnonzero(pc.equal(shard.ids, pa.scalar(ids[i], shard.ids.type)).to_numpy(zero_copy_only=False))
                        for place in itself:
                            eligible[place] &= bool((shard.vectors[place] != vectors[i]).any())
                        aims, windows = [None], [(-(2**63), 2**63 - 1)]
                    else:
                        eligible = shard.labels != own_labels[i]
                        aims = targets[i]
                        windows = [(-(-30 * t // 100), 90 * t // 100) for t in aims]
                    found = shard.best(vectors[i], lows[:, j], highs[:, j], eligible, windows, k)
                    for aim, (places, scores) in zip(aims, found):
                        out[0] += [anchor_numbers[i]] * len(places)
                        out[1] += [aim] * len(places)
                        out[2] += scores.tolist()
                        out[3].append(shard.ids.take(pa.array(places)))
            if out[0]:
                arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.concat_arrays(out[3])]
                yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "target", "score", "id"])

        for batch in batches:
            of, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(of) != 0) | (np.diff(kind) != 0)) + 1).tolist(), batch.num_rows]
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                if of[start] != number:
                    number, parts, shard, block = int(of[start]), [], None, []
                piece = batch.slice(start, end - start)
                if kind[start] == 0:
                    parts.append(piece)
                    continue
                if parts:
                    build()
                    parts = []
                if shard is not None:
                    yield from search([piece])

    dealt = data.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    return dealt.mapInArrow(run, f"anchor long, target long, score long, id {id_type}")


def _whole_rows(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(-1, width).astype(np.int64)


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: float = 256,
    positives: int = 5,
    negatives: int = 10,
    least_shards: int | None = None,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each row that meets ``anchors`` and each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of other labels whose score is 30 to 90 % of the positive's.
    """
    spark = df.sparkSession
    named = df.where(usable(vector)).select(
        F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"), F.coalesce(anchors, F.lit(False)).alias("is_anchor")
    )
    named = named.where(F.col("id").isNotNull() & F.col("label").isNotNull())
    width, many = named.agg(F.max(F.size("v")), F.count("*")).first()
    width = max(1, width or 0)
    id_type, label_type = (named.schema[c].dataType.simpleString() for c in ("id", "label"))

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(scale * matrix(batch.column(2), width), LARGEST).astype(np.int32)
            binary = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), binary, batch.column(3)], names=["id", "label", "vector", "is_anchor"])

    distinct = named.mapInArrow(scaled, f"id {id_type}, label {label_type}, vector binary, is_anchor boolean").distinct()
    turns = spark.sparkContext.broadcast(rotations(width))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, alignments, lengths = encode(_whole_rows(batch.column(2), width), turns.value)
            made = [
                pa.array([x.tobytes() for x in codes], pa.binary()),
                pa.array([x.tobytes() for x in alignments], pa.binary()),
                pa.array(lengths, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "codes", "alignments", "length"])

    fields = f"id {id_type}, label {label_type}, vector binary, is_anchor boolean, codes binary, alignments binary, length double"
    rows = keep(distinct.mapInArrow(coded, fields), "codes")
    # As many shards as tasks unless they would be tiny, more where a task could not hold one.
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-many // SHARD_ROWS))
    shards = max(1, least_shards or tasks, -(-many * width * 8 // SHARD_BYTES))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int"))
    asked = rows.where("is_anchor").select("id", "label", "vector").withColumn("anchor", F.monotonically_increasing_id())
    asked = keep(asked, "anchors")

    near = _first(_search(rows, asked, shards, width, positives, True, id_type), ["anchor"], positives)
    near = keep(near.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    targets = near.groupBy("anchor").agg(F.sort_array(F.collect_set("positive_score")).alias("targets"))
    aimed = keep(asked.join(targets, "anchor"), "targets")
    far = _first(_search(rows, aimed, shards, width, negatives, False, id_type), ["anchor", "target"], negatives)
    far = far.select("anchor", F.col("target").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named_far = asked.select("anchor", F.col("id").alias("anchor_id")).join(near, "anchor").join(far, ["anchor", "positive_score"])
    return named_far.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
