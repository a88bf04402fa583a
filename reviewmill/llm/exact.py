"""Exact duplicates: static binary-fuse filters per snapshot screen the digests of a new batch.

The snapshot's distinct digests are dealt to buckets and one filter of one byte a slot is built per
bucket and staged; a snapshot never changes, so neither do its filters. The batch is grouped by digest
first, so copies inside it meet there and a hot text sends one row per task. Its distinct digests meet
the filter of their bucket; only positives join the snapshot's groups. Texts of all groups with more than
one row are then compared byte for byte: smallest and largest text of a digest must be one.

Defined results: a null text is empty, and empty texts equal each other; null ids come after all others and
are never preferred; of repeated rows with one id exactly one stays; an empty table gives no rows. Two texts
with one SHA-256 and different bytes raise an error rather than losing one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import SPACE, text_of, unused
from reviewmill.session import keep

#: Digests per bucket, at most about: what one task holds while it builds or asks a filter.
BUCKET_ROWS = 50_000
#: Parts of a hot digest while texts are compared.
SALTS = 16


def normal(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, " ")


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _slots(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Three slots in neighbouring segments for each key, and its one-byte print."""
    h = _mix(keys, seed)
    first = (h >> np.uint64(32)) % np.uint64(segments)
    mask = np.uint64(segment - 1)
    within = (h & mask, (h >> np.uint64(11)) & mask, (h >> np.uint64(22)) & mask)
    slots = np.stack([(first + np.uint64(i)) * np.uint64(segment) + within[i] for i in range(3)])
    return slots.astype(np.int64), (_mix(h, 1) & np.uint64(255)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> dict:
    """A binary-fuse filter of distinct 64-bit keys, peeled round by round; a failed peeling tries the next seed."""
    n = len(keys)
    segment = 1 << max(2, int(np.log2(max(n, 1)) * 0.58 + 1.5))
    segment = min(segment, 1 << 11)
    segments = max(1, -(-int(n * 1.3 + 16) // segment))
    for seed in range(1, 200):
        slots, prints = _slots(keys, seed, segment, segments)
        size = (segments + 2) * segment
        count = np.bincount(slots.ravel(), minlength=size)
        holder = np.zeros(size, np.int64)  # xor of the keys' places: of the one key where the count is one
        for row in slots:
            np.bitwise_xor.at(holder, row, np.arange(n))
        rounds, left = [], n
        while left:
            single = np.flatnonzero(count == 1)
            if not len(single):
                break
            peeled, at = np.unique(holder[single], return_index=True)
            rounds.append((peeled, single[at]))
            left -= len(peeled)
            for row in slots[:, peeled]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(holder, row, peeled)
        if not left:
            table = np.zeros(size, np.uint8)
            for peeled, own in reversed(rounds):
                a, b, c = slots[:, peeled]
                table[own] = prints[peeled] ^ table[a] ^ table[b] ^ table[c]
            return {"seed": seed, "segment": segment, "segments": segments, "slots": table.tobytes()}
        segments += max(1, segments // 20)
    raise ValueError(f"no filter found for {n} keys; are they distinct?")


def maybe_in(keys: np.ndarray, fuse: dict) -> np.ndarray:
    """True for every key of the filter, and for about one other key in 256."""
    slots, prints = _slots(keys, fuse["seed"], fuse["segment"], fuse["segments"])
    table = np.frombuffer(fuse["slots"], np.uint8)
    a, b, c = slots
    return (table[a] ^ table[b] ^ table[c]) == prints


def _keys(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), ">u8")[::4].astype(np.uint64)


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    fuse = build_filter(np.unique(_keys(rows["digest"])))
    return pd.DataFrame([{"bucket": rows["bucket"].iloc[0], **fuse}])


def _screen(batch: pd.DataFrame, fuses: pd.DataFrame) -> pd.DataFrame:
    if len(batch) and len(fuses):
        batch["maybe"] = maybe_in(_keys(batch["digest"]), fuses.iloc[0].to_dict())
    else:
        batch["maybe"] = False
    return batch[["digest", "maybe"]]


def snapshot_filters(groups: DataFrame) -> DataFrame:
    """One staged filter per bucket of a snapshot's distinct ``digest`` rows."""
    built = groups.select("bucket", "digest").groupBy("bucket").applyInPandas(
        _build, "bucket long, seed long, segment long, segments long, slots binary"
    )
    return keep(built, "filters")


def _grouped(rows: DataFrame, buckets: int) -> DataFrame:
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    groups = rows.groupBy("digest").agg(first, F.count("*").alias("n"))
    return groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))


def digests(docs: DataFrame, new: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Staged narrow rows: id, a row mark, the digest of the normalised text, and whether the row is new."""
    hashed = F.unhex(F.sha2(normal(text_of(text)), 256))
    rows = docs.select(F.col(key).alias("id"), F.monotonically_increasing_id().alias("row"), hashed.alias("digest"),
                       F.coalesce(new, F.lit(True)).alias("new"))
    return keep(rows, "digests")


def groups_of(narrow: DataFrame) -> DataFrame:
    """One row per distinct digest of snapshot and batch: its first row, and its number of rows."""
    buckets = max(1, -(-narrow.count() // BUCKET_ROWS))
    old = keep(_grouped(narrow.filter("not new"), buckets), "snapshot")
    batch = keep(_grouped(narrow.filter("new"), buckets), "batch")
    fuses = snapshot_filters(old)
    asked = batch.select("bucket", "digest").groupBy("bucket").cogroup(fuses.groupBy("bucket"))
    screened = batch.join(asked.applyInPandas(_screen, "digest binary, maybe boolean"), "digest")
    positive = screened.filter("maybe").select("digest", F.col("first").alias("first2"), F.col("n").alias("n2"))
    met = old.join(positive, "digest", "full_outer").select(
        "digest",
        F.least("first", "first2").alias("first"),  # of the two that are there
        (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n"),
    )
    return met.unionByName(screened.filter("not maybe").select("digest", "first", "n"))


def bytes_agree(docs: DataFrame, groups: DataFrame, text: str = "text") -> DataFrame:
    """``digest`` and ``same`` for each group of several rows: whether all its texts are equal bytes."""
    body = normal(text_of(text))
    texts = docs.select(body.alias("body"), F.unhex(F.sha2(body, 256)).alias("digest"))
    texts = texts.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    several = groups.filter("n > 1").select("digest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = texts.join(several.withColumn("salt", F.col("salt").cast("long")), ["digest", "salt"], "left_semi")
    return met.groupBy("digest").agg((F.min("body") == F.max("body")).alias("same"))


def exact_groups(docs: DataFrame, new: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, the id that stays, the group's size, whether it stays, and its digest."""
    narrow = digests(docs, new, key, text)
    groups = keep(groups_of(narrow), "groups")
    checked = groups.join(bytes_agree(docs, groups, text), "digest", "left")
    sure = F.when(F.coalesce("same", F.lit(True)), F.lit(True)).otherwise(
        F.raise_error(F.lit("two texts share a SHA-256")).cast("boolean")
    )
    # Staged, so that the join below stands alone and a hot digest's rows can be split.
    checked = keep(checked.select("digest", "first", "n", sure.alias("sure")), "checked")
    return narrow.join(checked, "digest").select(
        F.col("id").alias(key),
        F.col("first.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("first.row") == F.col("row")) & F.col("sure")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def first_half(docs: DataFrame, key: str = "doc_id") -> Column:
    """Whether a row lies in the upper half of the ids: the batch that meets the snapshot of the lower half."""
    low, high = docs.agg(F.min(key), F.max(key)).first()
    return F.lit(True) if low is None else F.col(key) > F.lit((low + high) // 2)


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` of which no equal text has a smaller id, one of each text, with all their columns.

    Rows are told apart by id and digest; where several rows share both, one of them stays.
    """
    digest, gone, gone_digest, twin = (unused(docs.columns, name) for name in ("digest", "gone", "gone_digest", "twin"))
    narrow = digests(docs, first_half(docs, key), key, text)
    groups = keep(groups_of(narrow), "groups")
    keep(bytes_agree(docs, groups, text).select(
        F.when(F.col("same"), F.lit(True)).otherwise(F.raise_error(F.lit("two texts share a SHA-256")).cast("boolean"))
    ), "checked")
    marked = narrow.join(groups.select("digest", "first"), "digest")
    marked = marked.withColumn("twin", F.col("id").eqNullSafe(F.col("first.id")) & (F.col("row") != F.col("first.row")))
    dropped = keep(marked.filter(F.col("row") != F.col("first.row")).select("id", "digest", "twin").distinct(), "dropped")
    # The keys of the dropped rows are few and narrow; the text side is shuffled only if they measure large.
    hashed = docs.withColumn(digest, F.unhex(F.sha2(normal(text_of(text)), 256)))
    dropped = dropped.select(F.col("id").alias(gone), F.col("digest").alias(gone_digest), F.col("twin").alias(twin))
    same = F.col(key).eqNullSafe(F.col(gone)) & (F.col(digest) == F.col(gone_digest))
    single = hashed.join(dropped, same, "left_anti")
    if dropped.filter(twin).isEmpty():  # no rows share id and text, so the texts move once
        return single.drop(digest)
    twins = hashed.join(dropped.filter(twin), same, "left_semi").dropDuplicates([digest])
    return single.unionByName(twins).drop(digest)
