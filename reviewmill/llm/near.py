"""Chosen-path join of documents on the Jaccard similarity of their word n-grams.

A document is the set of hashes of its runs of five words. One random order of all hashes samples its
tokens: in run r a set chooses its r-th smallest token and enters the bucket of that path. Two sets with similarity
s share the smallest token of their union with probability s, so after ``runs`` runs a pair with s >= 0.8 is missed
with probability 0.2 ** runs; ``runs`` follows from the target recall. A bucket that stays too large and
whose sets are not alike on average is split again: each set goes on along its next tokens, ``runs`` of them, to
longer paths. Small, dense and deepest buckets are compared by brute force, in pairs of blocks where they are large; a
block travels as one row, so that no row is repeated for each member and block.
A pair is compared only in the one bucket whose path is its smallest shared tokens, so that links
are counted once and no list of pairs is ever made. Sketches decide which sets a bucket needs; only those are fetched, and
similarity is computed on the whole sets. A block returns each member's number of links and its
root in the block; stars of roots then become classes.

Defined results: a text of one to four words is one n-gram; a null or empty text, or a row without an id, has no
links and its id as class; equal sets are one member with a count, their rows link to each other, also those that
share an id; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import text_of, unused
from reviewmill.session import keep

WORDS = 5
#: Smallest tokens of a set that decide whether a pair is worth the whole sets.
SKETCH = 32
#: Members that one task compares with each other at a time.
BLOCK = 1024
#: Longest path; ``DEPTH * runs`` tokens must fit the sketch.
DEPTH = 3
#: Mean share of the sampled tokens that a bucket's members have in common, from which splitting stops.
DENSE = 0.3


def runs_for(recall: float, similarity: float) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity))


def ngram_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words."""
    found = text.encode().split()  # bytes split at exactly the six white-space characters
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    width = min(words, n)
    with np.errstate(over="ignore"):
        mixed = np.zeros(n - width + 1, np.uint64)
        for j in range(width):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[j : n - width + 1 + j]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def _grouped(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Rows of equal keys together, from batches that are sorted by the key."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in key]
        new = np.zeros(batch.num_rows, bool)
        new[0] = last is not None and last != tuple(c[0] for c in columns)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        start = 0
        for at in np.flatnonzero(new):
            if at > start:
                held.append(batch.slice(start, at - start))
            if held:
                yield pa.Table.from_batches(held)
            held, start = [], at
        held.append(batch.slice(start))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def _common(lists: list[np.ndarray], left: int) -> np.ndarray:
    """Numbers of shared tokens of the first ``left`` lists with all the others, or of all with all if ``left`` is 0."""
    tokens = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    _, column, count = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    order = np.cumsum(count > 1) - 1
    column, owner = order[column[shared]], owner[shared]
    by = np.argsort(column, kind="stable")
    column, owner = column[by], owner[by]
    top = slice(0, left) if left else slice(None)
    bottom = slice(left, None) if left else slice(None)
    total = np.zeros((len(range(*top.indices(len(lists)))), len(range(*bottom.indices(len(lists))))), np.float32)
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (start, start + width))
        grid = np.zeros((len(lists), min(width, int(column[-1]) + 1 - start)), np.float32)
        grid[owner[a:b], column[a:b] - start] = 1
        total += grid[top] @ grid[bottom].T
    return total


def _candidates(sketches: list[np.ndarray], sizes: np.ndarray, path: list[int], left: int, similarity: float):
    """Places of the pairs that belong to this path and may be similar enough."""
    last, depth = np.uint64(path[-1]), len(path)
    if len(sketches) <= 6 and not left:
        found = []
        sets = [set(s.tolist()) for s in sketches]
        for i in range(len(sets)):
            for j in range(i + 1, len(sets)):
                low, high = sorted((int(sizes[i]), int(sizes[j])))
                if low < similarity * high:
                    continue
                both = sets[i] & sets[j]
                if len(both) >= 0.4 * min(SKETCH, low) and sum(t < path[-1] for t in both) == depth - 1:
                    found.append((i, j))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]
    earlier = _common([s[s < last] for s in sketches], left)
    common = _common(sketches, left)
    a, b = (sizes[:left], sizes[left:]) if left else (sizes, sizes)
    low, high = np.minimum.outer(a, b), np.maximum.outer(a, b)
    mask = (earlier == depth - 1) & (low >= similarity * high) & (common >= 0.4 * np.minimum(low, SKETCH))
    if not left:
        mask = np.triu(mask, 1)
    i, j = np.nonzero(mask)
    return i, j + left


def _members(group: pa.Table, column: str) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in group.column(column).to_pylist()]


def _once(group: pa.Table) -> pa.Table:
    """Members, each once, in order of their ids."""
    _, first = np.unique(group.column("id").to_numpy(), return_index=True)
    return group.take(first)


def _to_bytes(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _from_bytes(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


#: What says where a member meets others.
PLACE = "path long, tokens binary, blocks int, block int"
PACKED = "path long, tokens binary, blocks int, block int, packed binary"


def _met(rows: DataFrame, work, merge, schema: str) -> DataFrame:
    """``work`` on every bucket of ``rows``, on every pair of blocks of a large one.

    ``work(tokens, members, left)`` compares the first ``left`` members with the others, or all with all if it is 0, and returns
    a table with ``id``; ``merge`` makes one table of those of a bucket's or block's members. The members of a block travel as
    one row, so that a large bucket costs a row per pair of blocks, and what its pairs say is merged by block first.
    """
    place = ["path", "tokens", "blocks", "block"]

    def placed(table: pa.Table, of: dict) -> pa.Table:
        table = merge(table)
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32())
        for name, kind in zip(place, kinds):
            table = table.append_column(name, pa.array([of[name]] * table.num_rows, kind))
        return table

    def first(group: pa.Table) -> dict:
        return group.select(place).slice(0, 1).to_pylist()[0]

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A bucket of one block is compared at once; of a larger one each block is packed."""
        for group in _grouped(batches, ["path", "block"]):
            of, members = first(group), _once(group)
            if of["blocks"] > 1:
                row = pa.Table.from_batches([packed_row(of, members.drop_columns(place))])
                for name in names[: -len(place)]:
                    row = row.append_column(name, pa.nulls(1, fields.field(name).type))
                yield from row.select(fields.names).cast(fields).to_batches()
            elif members.num_rows > 1 and (found := work(of["tokens"], members, 0)) is not None:
                table = placed(found, of)
                table = table.append_column("packed", pa.nulls(table.num_rows, pa.binary()))
                yield from table.select(fields.names).cast(fields).to_batches()

    def packed_row(of: dict, table: pa.Table) -> pa.RecordBatch:
        arrays = [pa.array([of["path"]], pa.int64()), pa.array([of["tokens"]], pa.binary()), pa.array([of["blocks"]], pa.int32())]
        arrays += [pa.array([of["block"]], pa.int32()), pa.array([_to_bytes(table)], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=[*place, "packed"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pair in _grouped(batches, ["path", "left_block", "right_block"]):
            of = pair.select([*place, "left_block", "right_block"]).to_pylist()
            if len({x["block"] for x in of}) == 1 and of[0]["left_block"] != of[0]["right_block"]:
                continue  # the other block has no member
            blocks = [_from_bytes(x) for x in pair.column("packed").to_pylist()]
            members, left = pa.concat_tables(blocks), blocks[0].num_rows if len(blocks) > 1 else 0
            if (found := work(of[0]["tokens"], members, left)) is None:
                continue
            own = np.isin(found.column("id").to_numpy(), blocks[0].column("id").to_numpy())
            for x, mine in zip(of, (own, ~own)):
                if mine.any():
                    yield packed_row(x, found.filter(pa.array(mine)))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, ["path", "block"]):
            parts = pa.concat_tables([_from_bytes(x) for x in group.column("packed").to_pylist()])
            yield from placed(parts, first(group)).select(names).to_batches()

    full = f"{schema}, {PLACE}"
    names = [field.split()[0] for field in full.split(", ")]
    kinds = {"binary": pa.binary(), "int": pa.int32()}
    fields = pa.schema([(f.split()[0], kinds.get(f.split()[1], pa.int64())) for f in f"{full}, packed binary".split(", ")])
    dealt = rows.repartition("path", "block").sortWithinPartitions("path", "block")
    # Staged, so that what leads here is worked out once for both kinds of buckets.
    first_met = keep(dealt.mapInArrow(alone, f"{full}, packed binary"), "met")
    done = first_met.where("packed is null").drop("packed")
    blocks = first_met.where("packed is not null").select(*place, "packed")
    if blocks.isEmpty():
        return done
    pairs = blocks.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    pairs = pairs.withColumns({"left_block": F.least("block", "other"), "right_block": F.greatest("block", "other")}).drop("other")
    sides = ["path", "left_block", "right_block"]
    pairs = pairs.repartition(*sides).sortWithinPartitions(*sides, "block").mapInArrow(meet, PACKED)
    large = pairs.repartition("path", "block").sortWithinPartitions("path", "block")
    return done.unionByName(large.mapInArrow(gather, full))


def chosen_path_join(
    docs: DataFrame, similarity: float = 0.8, recall: float = 0.999999, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: its id, ``class_id`` (the smallest id it is linked to, over any number of
    links) and ``n_links``, the number of other rows that are similar to it."""
    runs = runs_for(recall, similarity)
    if runs * DEPTH > SKETCH - 1:
        raise ValueError("the target recall needs a longer sketch")
    named = docs.select(F.col(key).alias("id"), text_of(text).alias("text"))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, sizes, sketches = [], [], []
            for value in batch.column(1):
                found = ngram_set(value.as_py())
                prints.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                sizes.append(len(found))
                sketches.append(found[:SKETCH].tobytes())
            arrays = [batch.column(0), pa.array(prints, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "print", "size", "sketch"])

    id_type = named.schema["id"].dataType.simpleString()
    summary = keep(named.mapInArrow(summarise, f"id {id_type}, print binary, size long, sketch binary"), "sketches")
    # Copies meet first: a member is a distinct set with its number of rows.
    members = summary.filter("id is not null and print is not null").groupBy("print").agg(
        F.min("id").alias("first_id"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("sketch").alias("sketch")
    )
    # From here on an id is that of a member.
    members = keep(members.withColumn("id", F.monotonically_increasing_id()), "members")
    asked = keep(_requests(members, runs, similarity), "requests")
    found = keep(_compare(named, members, asked, similarity), "links")
    classes = _classes(found.select(F.col("id").alias("u"), F.col("root").alias("v")).filter("u > v"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    about = members.join(links, "id", "left").join(classes, F.col("id") == F.col("u"), "left").select(
        "print",
        "first_id",
        F.coalesce("v", "id").alias("root"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    about = keep(about, "about")
    named_classes = about.groupBy("root").agg(F.min("first_id").alias("class_id"))
    about = about.join(named_classes, "root").select("print", "class_id", "n_links")
    return summary.filter("id is not null and print is not null").select("id", "print").join(about, "print").select(
        F.col("id").alias(key), "class_id", "n_links"
    ).unionByName(
        summary.filter("id is null or print is null").select(
            F.col("id").alias(key), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links")
        )
    )


def _paths(rows: DataFrame, runs: int) -> DataFrame:
    """Each member with its next ``runs`` tokens, from place ``at`` of the sketch on, as longer paths.

    ``skipped`` is the token that the longer path leaves out right before its last one, null if it leaves none out there.
    """

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"id": [], "path": [], "tokens": [], "at": [], "skipped": []}
            ids, at = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            tokens, sketches = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i in range(batch.num_rows):
                width = len(sketches[i]) // 8
                for k in range(at[i], min(at[i] + runs, width)):
                    longer = tokens[i] + sketches[i][8 * k : 8 * k + 8]
                    out["id"].append(ids[i])
                    out["path"].append(xxhash.xxh3_64_intdigest(longer) - 2**63)
                    out["tokens"].append(longer)
                    out["at"].append(k + 1)
                    out["skipped"].append(int.from_bytes(sketches[i][8 * k - 8 : 8 * k], "little", signed=True) if k > at[i] else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["id"], batch.schema.field(0).type), pa.array(out["path"], pa.int64()),
                 pa.array(out["tokens"], pa.binary()), pa.array(out["at"], pa.int32()), pa.array(out["skipped"], pa.int64())],
                names=list(out),
            )

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "at", "tokens", "sketch").mapInArrow(extend, f"id {id_type}, path long, tokens binary, at int, skipped long")


def _requests(members: DataFrame, runs: int, similarity: float) -> DataFrame:
    """Rows (id, path, tokens, blocks, block): the sets that each bucket needs in whole."""
    start = members.withColumn("at", F.lit(0)).withColumn("tokens", F.unhex(F.lit("")))
    rows, done = keep(_paths(start, runs), "paths"), []
    # A path holds no pair if it has one member, or if all of its members skip the same token: they share it earlier.
    alone = (F.count("*") == 1) | ((F.count("skipped") == F.count("*")) & (F.min("skipped") == F.max("skipped")))
    alone = F.coalesce(alone, F.lit(False)).alias("alone")
    sizes = rows.groupBy("path").agg(F.count("*").alias("many"), alone).filter("not alone").drop("alone")
    # Staged at every depth, as the small, dense and split buckets all read it: a row is looked up by its path once.
    rows = keep(rows.join(sizes, "path"), "shared")
    for depth in range(1, DEPTH):
        done.append(rows.filter(f"many <= {BLOCK}"))
        large = rows.filter(f"many > {BLOCK}").withColumnRenamed("path", "parent")
        longer = _paths(large.join(members.select("id", "sketch"), "id"), runs)
        longer = keep(longer.withColumn("parent", F.xxhash64(F.substring("tokens", F.lit(1), F.lit(8 * depth)))), "paths")
        # Mean share of the members that have a sampled token, over the tokens sampled: high where sets are alike.
        counts = keep(longer.groupBy("parent", "path").agg(F.count("*").alias("n"), alone), "counts")
        shares = counts.groupBy("parent").agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("met"))
        marked = large.groupBy(F.xxhash64("tokens").alias("hash")).agg(
            F.first("parent").alias("path"), F.first("many").alias("many")
        )
        dense = keep(
            marked.join(shares, F.col("hash") == F.col("parent"), "left")
            .select("hash", "path", (F.coalesce("met", F.lit(0.0)) >= DENSE * F.col("many")).alias("dense")),
            "dense",
        )
        alike = dense.filter("dense").select(F.col("path").alias("parent"))
        done.append(large.join(alike, "parent").withColumnRenamed("parent", "path"))
        # Only paths that hold a pair are gone along, with the size that is already counted.
        open_ = counts.filter("not alone").join(dense.filter("not dense").select(F.col("hash").alias("parent")), "parent")
        sizes = open_.select("path", F.col("n").alias("many"))
        rows = keep(longer.drop("parent").join(sizes, "path"), "shared")
    done.append(rows)
    ready = done[0]
    for part in done[1:]:
        ready = ready.unionByName(part)
    blocks = F.ceil(F.col("many") / BLOCK).cast("int")
    ready = ready.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    ready = ready.select("path", "tokens", "blocks", "block", "id").join(members.select("id", "size", "sketch"), "id")

    def ask(tokens: bytes, rows: pa.Table, left: int) -> pa.Table | None:
        path = np.frombuffer(tokens, np.uint64).tolist()
        i, j = _candidates(_members(rows, "sketch"), rows.column("size").to_numpy(), path, left, similarity)
        return rows.select(["id"]).take(np.unique(np.concatenate([i, j]))) if len(i) else None

    return _met(ready, ask, _once, "id " + members.schema["id"].dataType.simpleString())


def _compare(named: DataFrame, members: DataFrame, asked: DataFrame, similarity: float) -> DataFrame:
    """Rows (id, links, root): what each block found, from the whole sets that it asked for."""
    places = F.collect_list(F.struct("path", "tokens", "blocks", "block")).alias("places")
    wanted = asked.groupBy("id").agg(places).join(members.select("id", "first_id", "copies", "print"), "id")
    texts = named.withColumnRenamed("id", "_id").join(wanted, F.col("_id") == F.col("first_id"))
    texts = texts.select("id", "copies", "print", "places", "text")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [ngram_set(t.as_py()) for t in batch.column(batch.schema.get_field_index("text"))]
            prints = batch.column(batch.schema.get_field_index("print")).to_pylist()
            same = np.array([xxhash.xxh3_128_digest(s.tobytes()) == p for s, p in zip(sets, prints)], bool)
            column = pa.array([s.tobytes() for s in sets], pa.large_binary()).cast(pa.binary())
            names = ["id", "copies", "places"]
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*arrays, column], names=[*names, "set"]).filter(pa.array(same))

    kind = "long"
    place = wanted.schema["places"].dataType.simpleString()
    whole = texts.mapInArrow(fetch, f"id {kind}, copies long, places {place}, set binary")
    dealt = whole.select("id", "copies", "set", F.inline("places"))

    def link(tokens: bytes, rows: pa.Table, left: int) -> pa.Table | None:
        ids, copies = rows.column("id").to_numpy(), rows.column("copies").to_numpy()
        sets = _members(rows, "set")
        sizes = np.array([len(s) for s in sets])
        path = np.frombuffer(tokens, np.uint64).tolist()
        i, j = _candidates([s[:SKETCH] for s in sets], sizes, path, left, similarity)
        if not len(i):
            return None
        if len(i) > 8 * len(sets):
            common = _common(sets, left)[i, j - left]
        else:
            common = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)])
        near = common >= similarity * (sizes[i] + sizes[j] - common) - 1e-9
        i, j = i[near], j[near]
        if not len(i):
            return None
        links = np.bincount(i, copies[j], len(sets)) + np.bincount(j, copies[i], len(sets))
        root = _roots(ids, i, j)
        linked = links > 0
        return pa.table({"id": ids[linked], "links": links[linked].astype(np.int64), "root": root[linked]})

    return _met(dealt, link, _merged_links, f"id {kind}, links long, root {kind}").select("id", "links", "root")


def _roots(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each id the smallest that the pairs of places connect it with."""
    root = ids.copy()
    while True:  # every member takes the smallest root among its neighbours, until none changes
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        if (root == before).all():
            return root


def _merged_links(rows: pa.Table) -> pa.Table:
    """Each id once with all its links; roots that it joins are rows without links."""
    ids, place = np.unique(np.concatenate([rows.column("id").to_numpy(), rows.column("root").to_numpy()]), return_inverse=True)
    n = rows.num_rows
    links = np.bincount(place[:n], rows.column("links").to_numpy(), len(ids)).astype(np.int64)
    root = _roots(ids, place[:n], place[n:])
    told = (links > 0) | (root < ids)
    return pa.table({"id": ids[told], "links": links[told], "root": root[told]})


def _classes(edges: DataFrame) -> DataFrame:
    """Connected components: (u, v) with v the smallest id of u's component, for every u that is not smallest.

    Alternating large and small stars; each round is staged, and the driver reads one row a round.
    """
    edges = keep(edges.distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            return edges
        before = tuple(state)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u")
        small = small.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            smallest.select("u", F.col("m").alias("v"))
        )
        edges = keep(small.distinct(), "edges")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its class; rows without an id stay."""
    marked = chosen_path_join(docs, key=key, text=text, **how)
    gone = unused(docs.columns, "gone")
    dropped = keep(marked.filter(F.col("class_id") < F.col(key)).select(F.col(key).alias(gone)).distinct(), "dropped")
    return docs.join(dropped, F.col(key) == F.col(gone), "left_anti")
