"""Token counts by a public tokenizer library, without keeping the tokens.

An Arrow function packs the texts of its rows into batches of about equal bytes, encodes a batch in one call
of the library and returns the lengths only. A long text is cut at safe boundaries, and its parts go through the
batches like texts of their own: two neighbouring characters that stand together in no piece of the vocabulary can never
be merged across, so the counts of both sides add up. A part after the first is encoded behind a mark that no piece holds,
which keeps the library's own prefix away from it; the mark's tokens are taken off again. A text is cut only where the
library's normaliser leaves it as it is, and stays whole where no safe boundary follows.

Defined results: a null or empty text has no tokens and no bytes; repeated rows are counted each; other columns
pass through, the counts are one further column whose name is free; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import text_of, unused

#: Bytes that go to the library in one call.
BATCH_BYTES = 1 << 20
#: Characters from which a text is cut, and of its parts.
PART_CHARS = 1 << 16
SPACE_MARK = "▁"
#: Stands before each part but a text's first; usable if no piece holds it.
PART_MARK = "\n"


class PieceCounter:
    """Lengths by a sentencepiece model, given as the bytes of its file."""

    def __init__(self, model: bytes, part_chars: int = PART_CHARS):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = range(self.library.get_piece_size())
        pieces = [self.library.id_to_piece(i) for i in size if not self.library.is_byte(i)]
        self.joined = {a + b for piece in pieces for a, b in zip(piece, piece[1:])}
        # Without bytes for unknown characters the library counts a run of them as one, across a cut.
        spelled = any(map(self.library.is_byte, size))
        marked = not any(PART_MARK in piece for piece in pieces)
        self.cuts = spelled and marked and self.library.normalize(PART_MARK) == SPACE_MARK + PART_MARK
        self.mark_tokens = len(self.library.encode(PART_MARK))
        self.part_chars = part_chars

    def lengths(self, texts: list[str]) -> list[int]:
        return list(map(len, self.library.encode(texts, num_threads=1)))

    def parts(self, text: str) -> Iterator[tuple[str, int]]:
        """Parts of a text with the number of tokens to take off each."""
        plain = text.replace(" ", SPACE_MARK)
        if len(text) <= self.part_chars or not self.cuts or self.library.normalize(text) != SPACE_MARK + plain:
            yield text, 0
            return
        start = 0
        while start < len(text):
            end = start + self.part_chars
            while end < len(text) and plain[end - 1 : end + 1] in self.joined:
                end += 1
            yield (PART_MARK + text[start:end], self.mark_tokens) if start else (text[:end], 0)
            start = end


class FileCounter:
    """Lengths by a tokenizer file of the tokenizers library; texts stay whole."""

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_buffer(model)
        self.library.no_truncation()
        self.library.no_padding()

    def lengths(self, texts: list[str]) -> list[int]:
        return list(map(len, self.library.encode_batch(texts, add_special_tokens=False)))

    def parts(self, text: str) -> Iterator[tuple[str, int]]:
        yield text, 0


def counter(path: str, model: bytes) -> PieceCounter | FileCounter:
    """The counter for a vocabulary file: ``.model`` or ``.json``."""
    for suffix, kind in ((".model", PieceCounter), (".json", FileCounter)):
        if path.endswith(suffix):
            return kind(model)
    raise ValueError(f"{path} is neither a .model nor a .json file")


def count_batches(own: PieceCounter | FileCounter, texts: Iterator[str], batch_bytes: int = BATCH_BYTES) -> list[int]:
    """Tokens of each text; parts are encoded together until they make up ``batch_bytes``."""
    counts: list[int] = []
    batch: list[str] = []
    owners: list[tuple[int, int]] = []
    held = 0

    def encode():
        for (row, off), n in zip(owners, own.lengths(batch)):
            counts[row] += n - off

    for row, text in enumerate(texts):
        counts.append(0)
        for part, off in own.parts(text):
            if not part:
                continue
            batch.append(part)
            owners.append((row, off))
            held += len(part.encode())
            if held >= batch_bytes:
                encode()
                batch, owners, held = [], [], 0
    if batch:
        encode()
    return counts


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """``docs`` and a struct column ``tokens``: ``n_bytes``, ``n_tokens``, and ``over_limit`` above ``limit`` tokens.

    The vocabulary file is read by the driver and sent to the tasks; its size does not grow with the documents.
    """
    with open(path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    @F.arrow_udf("long")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(path, model.value)
        for batch in batches:
            yield pa.array(count_batches(own, (value.as_py() for value in batch)), pa.int64())

    whole = text_of(text)
    counted = docs.withColumn(name := unused(docs.columns, "tokens"), lengths(whole))
    return counted.withColumn(
        name,
        F.struct(
            F.octet_length(whole).cast("long").alias("n_bytes"),
            F.col(name).alias("n_tokens"),
            (F.col(name) > limit).alias("over_limit"),
        ),
    )
