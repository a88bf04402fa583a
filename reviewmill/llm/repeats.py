"""Bytes of repeated passages, found by interval expansion on Burrows-Wheeler transforms.

Wanted are all strings of ``LENGTH`` bytes that start at two or more places of the corpus. Every such string
has one anchor, the place of the smallest hash of ``GRAM`` bytes inside it, the first of equals; equal strings
have equal anchors at equal distance. A segment is an anchor with all strings that chose it. Anchors whose hash
occurs once end there. Where all segments of a hash are equal, all their strings repeat. What is left, segments that
share an anchor and differ, is dealt by anchor to tasks, where many segments at a time are indexed by one transform:
text is read in symbols of ``SYMBOL`` bytes at every phase, suffixes are sorted, and intervals of suffixes with a common
prefix are extended backward by one symbol per round, breadth first. An interval of one suffix has found
its longest common prefix and is dropped, so rounds derive common prefixes by increasing value; they stop at
LENGTH bytes, where the intervals left are the repeated strings. A hash with more than ``MANY`` different segments is
indexed in groups: by distance of the anchor, and by the bytes that all strings of a range of distances share.

Hashes have 64 bits, of which at least two must agree for a wrong match. Defined results: a null text is empty;
texts shorter than LENGTH keep all bytes; of repeated rows all copies are removed, as the strings are judged on the
input; rows that share an id are told apart by a hash of their text; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import text_of
from reviewmill.session import keep

LENGTH = 200
GRAM = 32
SYMBOL = 40
#: Bytes that one transform indexes.
INDEXED = 500_000
#: Different segments that are indexed together; an anchor with more is divided.
MANY = 512
#: Bytes that a task hashes at a time; their places fill the low bits of a hash.
CHUNK = 1 << 18

_PLACE = np.uint64((1 << 20) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def window_hashes(data: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes at every place, put together from windows of powers of two."""
    with np.errstate(over="ignore"):
        part = _mixed(data.astype(np.uint64) + np.uint64(seed * 256 + 1))
        found, done, size, power = None, 0, 1, _ODD
        while True:
            if width & size:
                if found is None:
                    found, done = part, size
                else:  # the windows so far, moved on behind one of this size
                    n = len(data) - done - size + 1
                    found = part[:n] * _power(done) + found[size : size + n] if n > 0 else found[:0]
                    done += size
            size *= 2
            if size > width:
                return found[: max(0, len(data) - width + 1)]
            part = part[: len(part) - size // 2] * power + part[size // 2 :] if len(part) > size // 2 else part[:0]
            power = power * power


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_ODD), n, 1 << 64))


def segments(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, content hash, first start and number of strings of each segment of the texts in ``data``.

    ``bounds`` are the texts' starts and the end of the last. The place of a hash fills its low bits, so that the
    smallest number of a window is the first of its smallest hashes.
    """
    none = np.zeros(0, np.int64)
    n = len(data) - LENGTH + 1
    if n <= 0:
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    grams = _mixed(window_hashes(data, GRAM))
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    inside, size = LENGTH - GRAM + 1, 1
    while size * 2 <= inside:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:n], least[inside - size : inside - size + n])
    # Strings that would cross the end of a text are none.
    room = np.zeros(len(data) + 1, np.int32)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= LENGTH:
            room[a] += 1
            room[b - LENGTH + 1] -= 1
    starts = np.flatnonzero(np.cumsum(room)[:n])
    if not len(starts):
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    places = (least[starts] & _PLACE).astype(np.int64)
    first = np.concatenate([[True], (places[1:] != places[:-1]) | (starts[1:] != starts[:-1] + 1)])
    begin = np.flatnonzero(first)
    widths = np.diff(np.append(begin, len(starts)))
    starts, places = starts[begin], places[begin]
    return grams[places], _content(data, starts, starts + widths - 1 + LENGTH), starts, widths


def _content(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of whole segments, of LENGTH to 2 * LENGTH - GRAM bytes: four windows that cover them, and their length."""
    wide = window_hashes(data, 128, seed=1)
    with np.errstate(over="ignore"):
        h = wide[starts] + (ends - starts).astype(np.uint64) * _ODD
        for step in (128, 256):
            h = _mixed(h) + wide[np.minimum(starts + step, ends - 128)]
        return _mixed(_mixed(h) + wide[ends - 128])


def repeated_strings(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (part, first start, number of starts) of LENGTH bytes that start at two or more places in ``parts``."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    lengths = np.array([len(p) for p in parts])
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    begin = np.repeat(bounds[:-1], lengths).astype(np.int32)
    end = np.repeat(bounds[1:], lengths).astype(np.int32)
    total = len(data)
    place = np.arange(total, dtype=np.int32)
    valid = place + SYMBOL <= end
    symbols = np.zeros(total, np.uint64)
    hashes = window_hashes(data, SYMBOL, seed=2)
    symbols[: len(hashes)] = hashes

    # Suffixes in order of their symbols: equal ones are told apart by twice as many symbols each round.
    suffixes = place[valid]
    order = suffixes[np.argsort(symbols[suffixes], kind="stable")]
    n = len(order)
    new = np.concatenate([[True], symbols[order[1:]] != symbols[order[:-1]]]) if n else np.zeros(0, bool)
    rank = np.full(total, -1, np.int64)
    rank[order] = _class_starts(new)
    head = rank.copy()  # the class of a suffix's first symbol
    depth, most = 1, LENGTH // SYMBOL
    slots = np.flatnonzero(_in_company(new))
    while depth < most and len(slots):
        members = order[slots]
        after = members + SYMBOL * depth
        inside = after < end[members]
        second = np.where(inside, rank[np.minimum(after, total - 1)], -1)
        key = rank[members] * (n + 1) + second + 1
        by = np.argsort(key, kind="stable")
        members, key = members[by], key[by]
        order[slots] = members
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[members] = slots[_class_starts(new)]
        slots = slots[_in_company(new)]
        depth *= 2
    slot_of = np.zeros(total, np.int32)
    slot_of[order] = np.arange(n, dtype=np.int32)

    # Backward extension, breadth first: the transform's symbol at a slot is the one before its suffix.
    heads = head[order]
    new = np.concatenate([[True], heads[1:] != heads[:-1]]) if n else np.zeros(0, bool)
    alive = np.flatnonzero(_in_company(new))
    interval = heads[alive].astype(np.int32)
    reached = np.empty(n, np.int32)
    for _ in range(most - 1):
        before = order[alive] - SYMBOL
        there = before >= begin[order[alive]]
        reached[:] = -1
        reached[slot_of[before[there]]] = interval[there]
        alive = np.flatnonzero(reached >= 0)
        if not len(alive):
            break
        came, symbol = reached[alive], heads[alive]
        new = np.concatenate(
            [[True], (alive[1:] != alive[:-1] + 1) | (came[1:] != came[:-1]) | (symbol[1:] != symbol[:-1])]
        )
        interval = alive[_class_starts(new)].astype(np.int32)
        stay = _in_company(new)
        alive, interval = alive[stay], interval[stay]
    marked = np.zeros(total + 2, np.int8)
    marked[order[alive] + 1] = 1
    edges = np.flatnonzero(np.diff(marked))
    first, stop = edges[::2], edges[1::2]
    part = np.searchsorted(bounds, first, side="right") - 1
    return part, first - bounds[part], stop - first


def _class_starts(new: np.ndarray) -> np.ndarray:
    """For every place the place where its class begins."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0)) if len(new) else np.zeros(0, np.int64)


def _in_company(new: np.ndarray) -> np.ndarray:
    """Whether the class of a place has two members or more."""
    return ~(new & np.append(new[1:], True)) if len(new) else np.zeros(0, bool)


def _scan(docs: DataFrame, kind: str) -> DataFrame:
    """Staged narrow rows, one per segment: id, part (a hash of the text), anchor, content, start, width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "part", "anchor", "content", "start", "width"]
        for batch in batches:
            held: list[tuple[int, int, bytes]] = []
            size = 0

            def flush():
                data = np.frombuffer(b"".join(h[2] for h in held), np.uint8)
                bounds = np.concatenate([[0], np.cumsum([len(h[2]) for h in held])])
                anchor, content, start, width = segments(data, bounds)
                of = np.searchsorted(bounds, start, side="right") - 1
                rows = pa.array(np.array([h[0] for h in held], np.int64)[of])
                offset = np.array([h[1] for h in held], np.int64)[of]
                return pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows), batch.column(1).take(rows),
                        pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)),
                        pa.array(start - bounds[of] + offset), pa.array(width.astype(np.int32)),
                    ],
                    names=names,
                )

            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_py().encode()
                for at in range(0, max(1, len(text) - LENGTH + 1), CHUNK):
                    piece = text[at : at + CHUNK + LENGTH - 1]
                    if len(piece) >= LENGTH:
                        held.append((i, at, piece))
                        size += len(piece)
                    if size >= CHUNK:
                        yield flush()
                        held, size = [], 0
            if held:
                yield flush()

    return keep(docs.mapInArrow(run, f"id {kind}, part int, anchor long, content long, start long, width int"), "segments")


def _packed(docs: DataFrame, kind: str) -> DataFrame:
    """Texts compressed for the shuffle that brings them to their spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = [pack(t.as_py().encode()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["id", "part", "packed"])

    return docs.mapInArrow(run, f"id {kind}, part int, packed binary")


def _unpack(value: pa.Scalar) -> bytes:
    return zstandard.ZstdDecompressor().decompress(value.as_py())


def _fetch(packed: DataFrame, classes: DataFrame) -> DataFrame:
    """``classes`` with the bytes of each: cut from the text of its first row."""
    asked = classes.groupBy(F.col("first.id").alias("_id"), F.col("first.part").alias("_part")).agg(
        F.collect_list(F.struct("anchor", "content", "copies", "many", F.col("first.start").alias("start"), F.col("first.width").alias("width"))).alias("asked")
    )
    met = packed.join(asked, F.col("id").eqNullSafe(F.col("_id")) & (F.col("part") == F.col("_part"))).select("packed", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text, wanted = _unpack(batch.column(0)[i]), batch.column(1)[i].as_py()
                cut = [text[w["start"] : w["start"] + w["width"] - 1 + LENGTH] for w in wanted]
                fields = [pa.array([w[c] for w in wanted], pa.int64()) for c in ("anchor", "content", "copies", "many")]
                yield pa.RecordBatch.from_arrays([*fields, pa.array(cut, pa.binary())], names=["anchor", "content", "copies", "many", "bytes"])

    # Rows that share id and text would fetch a class twice.
    return met.mapInArrow(run, "anchor long, content long, copies long, many long, bytes binary")


def _indexed(segments_: DataFrame) -> DataFrame:
    """Runs (anchor, content, offset, length) of repeated strings, by transforms over whole anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[bytes, int]] = {}
        size, last = 0, None

        def flush():
            keys, parts = list(held), [p for p, _ in held.values()]
            part, offset, length = repeated_strings(parts)
            alone = np.array([copies > 1 for _, copies in held.values()])
            stay = ~alone[part] if len(part) else np.zeros(0, bool)
            whole = np.flatnonzero(alone)  # copies of one segment repeat all its strings
            part = np.concatenate([part[stay], whole]).astype(np.int64)
            offset = np.concatenate([offset[stay], np.zeros(len(whole))]).astype(np.int32)
            length = np.concatenate([length[stay], [len(parts[i]) - LENGTH + 1 for i in whole]]).astype(np.int32)
            found = np.array(keys, np.int64).reshape(-1, 2)[part]
            return pa.RecordBatch.from_arrays(
                [pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(offset), pa.array(length)],
                names=["anchor", "content", "offset", "length"],
            )

        for batch in batches:
            anchors, contents = batch.column(0).to_numpy().tolist(), batch.column(1).to_numpy().tolist()
            copies, parts = batch.column(2).to_numpy().tolist(), batch.column(3).to_pylist()
            for anchor, content, n, part in zip(anchors, contents, copies, parts):
                if size >= INDEXED and anchor != last:
                    yield flush()
                    held, size = {}, 0
                if (anchor, content) not in held:
                    held[anchor, content] = (part, n)
                    size += len(part)
                last = anchor
        if held:
            yield flush()

    rows = segments_.select("anchor", "content", "copies", "bytes").repartition("anchor").sortWithinPartitions("anchor")
    return rows.mapInArrow(run, "anchor long, content long, offset int, length int")


def _halves(data: bytes, place: int, low: int, high: int) -> Iterator[tuple[int, int, int, int]]:
    """Of the strings of a segment whose anchor, at ``place``, lies ``low`` to ``high`` bytes behind their start, the two
    halves by that distance: (low, high, nearest, farthest) with the distances that the segment has of each."""
    middle = (low + high) // 2
    for a, b in ((low, middle), (middle + 1, high)):
        nearest, farthest = max(a, place - (len(data) - LENGTH)), min(b, place)
        if nearest <= farthest:
            yield a, b, nearest, farthest


def _divided(classes: DataFrame) -> DataFrame:
    """Runs (anchor, content, offset, length) for anchors with too many segments to index at a time.

    Equal strings have their anchor at equal distance. All strings of a range of distances share the bytes around the anchor that the
    range's nearest and farthest string have in common, so segments are dealt anew by half the range and those bytes, and equal
    parts of segments become one class. Groups that are still too large are halved again; a range of one distance is one
    class. A segment is two rows a round, and only as long as its group is too large.
    """

    def halve(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        wanted = fields if whole else narrow
        for piece in (batch.slice(at, 1000) for batch in batches for at in range(0, batch.num_rows, 1000)):
            rows = []
            for row in piece.to_pylist():
                data, place = row["bytes"], row["place"]
                for low, high, nearest, farthest in _halves(data, place, row["low"], row["high"]):
                    core = data[place - low : place - high + LENGTH]
                    part = data[place - farthest : place - nearest + LENGTH]
                    group = xxhash.xxh3_64_intdigest(core + b"%d,%d,%d" % (row["anchor"], low, high)) - 2**63
                    own = xxhash.xxh3_64_intdigest(part + b"%d" % farthest, 1) - 2**63
                    strings = farthest - nearest + 1
                    rows.append((row["anchor"], row["content"], place - farthest, group, own, row["copies"], strings, farthest, low, high, part))
            columns = list(zip(*rows)) if rows else [[]] * len(fields)
            arrays = [pa.array(list(c), field.type) for c, field in zip(columns, wanted)]
            yield pa.RecordBatch.from_arrays(arrays, schema=wanted)

    names = ["anchor", "content", "base", "group", "own", "copies", "strings", "place", "low", "high", "bytes"]
    kinds = {"base": pa.int32(), "strings": pa.int32(), "place": pa.int32(), "low": pa.int32(), "high": pa.int32(), "bytes": pa.binary()}
    fields = pa.schema([pa.field(n, kinds.get(n, pa.int64())) for n in names])
    narrow = pa.schema(list(fields)[:7])
    schema = "anchor long, content long, base int, group long, own long, copies long, strings int"
    given = classes.select("anchor", "content", "copies", "place", "low", "high", "bytes")
    # Numbers only: the bytes are cut again for the few classes that have company.
    halves = keep(given.mapInArrow(lambda batches: halve(batches, False), schema), "halves")
    parts = halves.groupBy("group", "own").agg(
        F.sum("copies").alias("copies"), F.max("strings").alias("strings"), F.min(F.struct("anchor", "content")).alias("first")
    )
    sizes = parts.groupBy("group").agg(F.count("*").alias("many"))
    told = keep(parts.join(sizes, "group").filter("many > 1 or copies > 1"), "parts")
    # Alone in its group, a class repeats if it has copies, and then with all its strings.
    alone = told.filter("many = 1").select("group", "own", F.lit(0).alias("offset"), F.col("strings").alias("length"))
    company = told.filter("many > 1").select("group", "own", F.col("copies").alias("all"), "many", "first.anchor", "first.content")
    if company.isEmpty():
        runs = alone
    else:
        cut = given.join(company.select("anchor", "content").distinct(), ["anchor", "content"], "left_semi")
        cut = cut.select(given.columns).mapInArrow(lambda batches: halve(batches, True), f"{schema}, place int, low int, high int, bytes binary")
        cut = cut.join(company, ["anchor", "content", "group", "own"]).select(
            F.col("group").alias("anchor"), F.col("own").alias("content"), F.col("all").alias("copies"), "many", "place", "low", "high", "bytes"
        )
        cut = keep(cut, "part-bytes")
        found, large = _indexed(cut.filter(F.col("many") <= MANY)), cut.filter(F.col("many") > MANY)
        if not large.isEmpty():
            found = found.unionByName(_divided(large))
        runs = alone.unionByName(found.withColumnsRenamed({"anchor": "group", "content": "own"}))
    runs = keep(runs, "part-runs")
    back = halves.select("anchor", "content", "base", "group", "own").join(runs, ["group", "own"])
    return back.select("anchor", "content", (F.col("base") + F.col("offset")).alias("offset"), "length")


def _anchored(segments_: DataFrame) -> DataFrame:
    """Segments, each once, with the place of their anchor and all distances that an anchor can have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = []
            for anchor, data in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                grams = _mixed(window_hashes(np.frombuffer(data, np.uint8), GRAM)).view(np.int64)
                places.append(int(np.argmax(grams == anchor)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int32())], names=[*batch.schema.names, "place"])

    once = segments_.select("anchor", "content", "copies", "bytes").dropDuplicates(["anchor", "content"])
    placed = once.mapInArrow(run, "anchor long, content long, copies long, bytes binary, place int")
    return placed.withColumns({"low": F.lit(0), "high": F.lit(LENGTH - GRAM)})


def repeated_spans(docs: DataFrame, kind: str) -> DataFrame:
    """``id``, ``part`` and ``spans``: for each text the byte ranges (start, end) that repeated strings cover."""
    rows = _scan(docs, kind)
    shared = rows.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high")
    ).filter("n > 1").select("anchor", (F.col("low") == F.col("high")).alias("alike"))
    # Staged, so that the join stands alone and a hot anchor's rows can be split.
    shared = keep(shared, "anchors")
    met = keep(rows.join(shared, "anchor"), "shared")
    mixed = met.filter("not alike")
    classes = mixed.groupBy("anchor", "content").agg(
        F.count("*").alias("copies"), F.min(F.struct("id", "part", "start", "width")).alias("first")
    )
    classes = keep(classes, "classes")
    sizes = classes.groupBy("anchor").agg(F.count("*").alias("many"))
    fetched = keep(_fetch(_packed(docs, kind), classes.join(sizes, "anchor")), "bytes")
    runs, large = _indexed(fetched.filter(F.col("many") <= MANY)), fetched.filter(F.col("many") > MANY)
    if not large.isEmpty():
        runs = runs.unionByName(_divided(_anchored(large)))
    answers = keep(runs, "runs")
    # One row per segment class, so that the rows of a class meet one row; staged, so that a hot class can be split.
    by_class = keep(answers.groupBy("anchor", "content").agg(F.collect_list(F.struct("offset", "length")).alias("runs")), "by-class")
    begin = F.col("start")
    told = mixed.join(by_class, ["anchor", "content"]).select(
        "id", "part",
        F.transform("runs", lambda r: F.struct((begin + r["offset"]).alias("start"), (begin + r["offset"] + r["length"] - 1 + LENGTH).alias("end"))).alias("spans"),
    )
    settled = met.filter("alike").select(
        "id", "part", F.array(F.struct(begin.alias("start"), (begin + F.col("width") - 1 + LENGTH).alias("end"))).alias("spans")
    )
    return settled.unionByName(told).groupBy("id", "part").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``kept`` (the remaining bytes), n_bytes, n_removed, n_spans."""
    body = text_of(text)
    named = docs.select(F.col(key).alias("id"), F.hash(body).alias("part"), body.alias("body"))
    kind = named.schema["id"].dataType.simpleString()
    spans = repeated_spans(named, kind).withColumnsRenamed({"id": "_id", "part": "_part"})
    met = _packed(named, kind).join(
        spans, F.col("id").eqNullSafe(F.col("_id")) & (F.col("part") == F.col("_part")), "left"
    ).select("id", "packed", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, removed, counts = [], [], [], []
            for i in range(batch.num_rows):
                data = _unpack(batch.column(1)[i])
                left, last, gone, n = [], 0, 0, 0
                ranges = batch.column(2)[i].values
                if ranges is not None and len(ranges):
                    start, end = (ranges.field(c).to_numpy() for c in (0, 1))
                    by = np.argsort(start, kind="stable")
                    start, end = start[by], np.maximum.accumulate(end[by])
                    new = np.concatenate([[True], start[1:] > end[:-1]])
                    for a, b in zip(start[new].tolist(), end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)].tolist()):
                        left.append(data[last:a])
                        last, gone, n = b, gone + b - a, n + 1
                left.append(data[last:])
                kept.append(b"".join(left))
                sizes.append(len(data))
                removed.append(gone)
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), *(pa.array(c, pa.int64()) for c in (sizes, removed, counts))],
                names=["id", "kept", "n_bytes", "n_removed", "n_spans"],
            )

    return met.mapInArrow(run, f"id {kind}, kept binary, n_bytes long, n_removed long, n_spans long").withColumnRenamed("id", key)
