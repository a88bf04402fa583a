"""Language-model score of a text summed over all its segmentations into subword pieces.

The vocabulary is that of a public tokenizer. Its pieces get as unigram scores their smoothed frequency
in the tokenizer's own segmentation of the training words, each word weighted with its count. No piece crosses a
word, so the marginal probability of a text is the product over its words of the sum over all segmentations of
the word, which a forward recursion in log space yields, and of one end mark.

Words are counted and scored once each, not once per occurrence. Tasks cut their documents into blocks that hold
a bounded number of different words; documents travel as numbers of their block's words, and each block gets
back the counts and scores of its own words only. A word in every text is one row a block.

Defined results: a null or empty text is one end mark; repeated rows are scored alike and count each time in
training; characters the vocabulary lacks are spelled in bytes; without training documents all pieces
are as likely as each other; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import text_of
from reviewmill.session import keep

#: Different words of a block: what a task holds while it numbers or scores documents.
BLOCK_WORDS = 300_000
#: Tokens after which a block is closed whatever its words.
BLOCK_TOKENS = 20_000_000
SPACE_MARK = "▁"


class _Numbers(dict):
    """Words of a block, numbered in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _blocks(docs: DataFrame, held_out: Column, key: str, text: str) -> DataFrame:
    """Staged rows of two kinds: a document with its words' numbers, and a word of a block with its training count."""
    named = docs.select(F.col(key).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), text_of(text).alias("text"))
    schema = f"block long, id {named.schema['id'].dataType.simpleString()}, held_out boolean, numbers binary, number int, word binary, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        numbers, counts, tokens = _Numbers(), np.zeros(1 << 16, np.int64), 0
        pack = zstandard.ZstdCompressor(level=1).compress

        def rows(length, **columns):
            names = ["block", "id", "held_out", "numbers", "number", "word", "n"]
            kinds = [pa.int64(), id_kind, pa.bool_(), pa.binary(), pa.int32(), pa.binary(), pa.int64()]
            columns["block"] = np.full(length, block, np.int64)
            made = [columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns.get(c, [None] * length), k) for c, k in zip(names, kinds)]
            return pa.RecordBatch.from_arrays(made, names=names)

        def close():
            nonlocal block, numbers, counts, tokens
            words = list(numbers)
            for at in range(0, len(words), 20_000):
                part = words[at : at + 20_000]
                span = np.arange(at, at + len(part), dtype=np.int32)
                yield rows(len(part), number=span, word=part, n=counts[at : at + len(part)])
            block, numbers, counts, tokens = block + 1, _Numbers(), np.zeros(1 << 16, np.int64), 0

        id_kind = None
        for batch in batches:
            id_kind = batch.schema.field(0).type
            at = 0
            while at < batch.num_rows:
                found, begin = [], at
                while at < batch.num_rows and len(numbers) < BLOCK_WORDS and tokens < BLOCK_TOKENS:
                    words = batch.column(2)[at].as_py().encode().lower().split()
                    own = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
                    tokens += len(words)
                    if len(counts) < len(numbers):
                        counts = np.concatenate([counts, np.zeros(len(numbers), np.int64)])
                    if len(own) and not batch.column(1)[at].as_py():
                        counts[: own.max() + 1] += np.bincount(own)
                    found.append(pack(own.tobytes()))
                    at += 1
                if found:
                    yield rows(len(found), id=batch.column(0).slice(begin, at - begin), held_out=batch.column(1).slice(begin, at - begin), numbers=found)
                if at < batch.num_rows:
                    yield from close()
        if id_kind is not None:
            yield from close()

    return keep(named.mapInArrow(run, schema), "blocks")


class Lattice:
    """Scores words over all their segmentations; ``scores`` are log10 probabilities of pieces."""

    def __init__(self, scores: dict[str, float], bytes_: list[float]):
        self.scores, self.bytes = scores, bytes_
        self.longest = max(map(len, scores), default=1)
        self.word, self.sums = "", [0.0]

    def score(self, word: str) -> float:
        """log10 of the sum over all segmentations; words in sorted order share the work on their common start."""
        word = SPACE_MARK + word
        shared, most = 0, min(len(word), len(self.word))
        while shared < most and word[shared] == self.word[shared]:
            shared += 1
        sums, scores = self.sums[: shared + 1], self.scores
        for end in range(shared + 1, len(word) + 1):
            paths = []
            for start in range(max(0, end - self.longest), end):
                piece = scores.get(word[start:end])
                if piece is not None:
                    paths.append(sums[start] + piece)
            if scores.get(word[end - 1]) is None:
                spelled = sum(self.bytes[b] for b in word[end - 1].encode("utf-8", "surrogatepass"))
                paths.append(sums[end - 1] + spelled)
            if len(paths) == 1:
                sums.append(paths[0])
            else:
                top = max(paths)
                sums.append(top + math.log10(sum([10.0 ** (p - top) for p in paths])))
        self.word, self.sums = word, sums
        return sums[-1]


def _pieces(model: sentencepiece.SentencePieceProcessor) -> tuple[dict[str, int], list[int]]:
    """Ids of the ordinary pieces, and of the 256 byte pieces."""
    size = model.vocab_size()
    kinds = [(model.is_control(i), model.is_unknown(i), model.is_unused(i), model.is_byte(i)) for i in range(size)]
    ordinary = {model.id_to_piece(i): i for i in range(size) if not any(kinds[i]) and model.get_score(i) > -1e8}
    return ordinary, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


def piece_counts(words: DataFrame, model_bytes: bytes) -> DataFrame:
    """``piece`` id and ``n``: how often the tokenizer uses each piece in ``words`` (word, n)."""
    model_sent = words.sparkSession.sparkContext.broadcast(model_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_proto=model_sent.value)
        total = np.zeros(model.vocab_size(), np.int64)
        for batch in batches:
            texts = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            found = model.encode(texts, num_threads=1)
            weights = np.repeat(batch.column(1).to_numpy(), [len(f) for f in found])
            ids = np.fromiter((i for f in found for i in f), np.int64, len(weights))
            np.add.at(total, ids, weights)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["piece", "n"])

    return words.select("word", "n").mapInArrow(run, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def score_texts(
    docs: DataFrame, held_out: Column, model_path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    Rows that are not held out are learnt from. The driver holds the vocabulary's piece counts, whose number
    is that of the vocabulary, and the totals; word counts stay in Spark.
    """
    with open(model_path, "rb") as file:
        model_bytes = file.read()
    spark = docs.sparkSession
    staged = _blocks(docs, held_out, key, text)
    listed = staged.filter("word is not null").select("block", "number", "word", "n")
    words = keep(listed.groupBy("word").agg(F.sum("n").alias("n")), "words")
    ends = staged.filter("word is null and not held_out").count()
    known, total = words.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    train_tokens = (total or 0) + ends
    distinct = known + (ends > 0)

    model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes)
    ordinary, byte_ids = _pieces(model)
    used = {row["piece"]: row["n"] for row in piece_counts(words.filter("n > 0"), model_bytes).collect()}
    inventory = len(ordinary) + 256 + 1
    all_pieces = sum(used.get(i, 0) for i in [*ordinary.values(), *byte_ids]) + ends

    def piece_score(n: int) -> float:
        return math.log10((n + 0.5) / (all_pieces + 0.5 * inventory))

    scores = {piece: piece_score(used.get(i, 0)) for piece, i in ordinary.items()}
    spelled = [piece_score(used.get(i, 0)) for i in byte_ids]
    end_score = piece_score(ends)
    model_sent = spark.sparkContext.broadcast((scores, spelled))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*model_sent.value)
        for batch in batches:
            found = [lattice.score(w.decode("utf-8", "replace")) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["word", "n", "marginal"])

    weighed = words.sortWithinPartitions("word").mapInArrow(weigh, "word binary, n long, marginal double")
    answers = listed.select("block", "number", "word").join(weighed, "word").select("block", "number", F.col("n"), "marginal")
    id_type = staged.schema["id"].dataType
    rows = answers.select(
        "block", F.lit(0).alias("kind"), "number", "n", "marginal",
        F.lit(None).cast(id_type).alias("id"), F.lit(None).cast("boolean").alias("held_out"), F.lit(None).cast("binary").alias("numbers"),
    ).unionByName(
        staged.filter("word is null").select(
            "block", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("number"), F.lit(None).cast("long").alias("n"),
            F.lit(None).cast("double").alias("marginal"), "id", "held_out", "numbers",
        )
    )
    end_base = math.log10((ends + 0.5) / (train_tokens + 0.5 * (distinct + 1)))

    def total_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts, marginals, base = None, np.zeros(0), np.zeros(0), np.zeros(0)
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            blocks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            change = np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, b in zip([0, *change], [*change, len(blocks)]):
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    places = part.column(2).to_numpy()
                    if blocks[a] != block:
                        block, counts, marginals = blocks[a], np.zeros(0, np.int64), np.zeros(0)
                    need = int(places.max()) + 1
                    if need > len(counts):
                        more = max(need, 2 * len(counts)) - len(counts)
                        counts, marginals = np.concatenate([counts, np.zeros(more, np.int64)]), np.concatenate([marginals, np.zeros(more)])
                    counts[places], marginals[places] = part.column(3).to_numpy(), part.column(4).to_numpy()
                    base = None
                    continue
                if blocks[a] != block:  # a block of texts without words
                    block, counts, marginals, base = blocks[a], np.zeros(0, np.int64), np.zeros(0), None
                if base is None:
                    base = np.log10((counts + 0.5) / (train_tokens + 0.5 * (distinct + 1)))
                own = [np.frombuffer(unpack(x), np.int32) for x in part.column(7).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(5), part.column(6),
                        pa.array([len(x) + 1 for x in own], pa.int64()),
                        pa.array([int((counts[x] > 0).sum()) + (ends > 0) for x in own], pa.int64()),
                        pa.array([train_tokens] * len(own), pa.int64()),
                        pa.array([float(base[x].sum()) + end_base for x in own], pa.float64()),
                        pa.array([float(marginals[x].sum()) + end_score for x in own], pa.float64()),
                    ],
                    names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = f"id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    dealt = rows.repartition("block").sortWithinPartitions("block", "kind")
    return dealt.mapInArrow(total_up, schema).withColumnRenamed("id", key)
