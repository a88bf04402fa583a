"""Byte-level BPE as a tree reduction: halves are encoded and joined at their boundary.

Every match of the pattern is encoded on its own. A long match is cut in halves down to short
leaves, and neighbours are joined by encoding again a window of tokens around the boundary. A
sequence of tokens is the encoding of its bytes exactly if every two neighbours are the encoding of theirs, so a
window is wide enough once its first and last token agree with the tokens outside; until then that side doubles.
Joining is associative, its neutral element is the empty sequence, and decoding is concatenation.

Defined results: a null or empty text has no ids; repeated rows are encoded alike; other columns pass through;
an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

#: Bytes of a leaf of the tree.
LEAF = 64
#: Matches whose encoding a task keeps; the table is emptied when it is full.
KEPT = 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Encodes matches of the pattern; ``tokens`` maps ids to bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.agreed: dict[tuple[int, int], bool] = {}

    def leaf(self, piece: bytes) -> list[int]:
        """Merge the pair of lowest rank, the leftmost of equals, until no pair has a rank."""
        ranks = self.ranks
        if len(piece) > LEAF:
            return self._heap(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(piece[i : i + 2]) for i in range(len(piece) - 1)]
        while pairs:
            best = min((r for r in pairs if r is not None), default=None)
            if best is None:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1])
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i])
        return [ranks[part] for part in parts]

    def _heap(self, piece: bytes) -> list[int]:
        """The same merges for a wide window, with a heap of pairs over a linked list."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # where the part that starts here ends; 0 once it is merged away
        before = list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if not end[i] or (j := end[i]) >= n or ranks.get(piece[i : end[j]]) != rank:
                continue
            end[i], end[j] = end[j], 0
            if end[i] < n:
                before[end[i]] = i
                if (r := ranks.get(piece[i : end[end[i]]])) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := ranks.get(piece[h : end[i]])) is not None:
                heapq.heappush(heap, (r, h))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def agree(self, left: int, right: int) -> bool:
        """Whether the two tokens are the encoding of their bytes."""
        key = (left, right)
        if key not in self.agreed:
            if len(self.agreed) > KEPT:
                self.agreed.clear()
            self.agreed[key] = self.leaf(self.tokens[left] + self.tokens[right]) == [left, right]
        return self.agreed[key]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left + right
        if self.agree(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.leaf(self.decode(left[-i:] + right[:j]))
            left_done = i == len(left) or self.agree(left[-i - 1], window[0])
            right_done = j == len(right) or self.agree(window[-1], right[j])
            if left_done and right_done:
                return left[:-i] + window + right[j:]
            if not left_done:
                i = min(2 * i, len(left))
            if not right_done:
                j = min(2 * j, len(right))

    def encode_match(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        if len(piece) <= LEAF:
            return self.leaf(piece)
        half = len(piece) // 2
        return self.join(self.encode_match(piece[:half]), self.encode_match(piece[half:]))

    def encode(self, text: str) -> list[int]:
        return [i for match in self.find(text) for i in self.encode_match(match.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Written(dict):
    """The ids of a match as decimal text, worked out when first asked for."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, match: str) -> str:
        if len(self) > KEPT:
            self.clear()
        written = " ".join(map(str, self.encoder.encode_match(match.encode())))
        if len(match) <= LEAF:
            self[match] = written
        return written


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: bool = False) -> DataFrame:
    """``docs`` without the text, with ``n_tokens`` and the SHA-256 of the written ids and of the decoded bytes.

    Columns of those names are replaced. With ``ids`` also the ids themselves. The rank file is read by the driver and sent to the tasks: its
    size is that of the vocabulary, whatever the number of documents.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(path))
    others = [c for c in docs.columns if c not in (text, "n_tokens", "ids_sha256", "decoded_sha256", "ids")]
    schema = docs.select(*(f"`{c}`" for c in others)).schema
    schema = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if ids:
        schema = schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks.value, pattern)
        written, find = _Written(encoder), encoder.find
        tokens = {str(rank): token for rank, token in encoder.tokens.items()}
        for batch in batches:
            columns = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for value in batch.column(batch.schema.get_field_index(text)):
                joined = " ".join(map(written.__getitem__, find(value.as_py() or "")))
                split = joined.split()
                decoded = b"".join(map(tokens.__getitem__, split))
                columns["n_tokens"].append(len(split))
                columns["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                columns["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
                if ids:
                    columns["ids"].append(list(map(int, split)))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in others]
            made = [pa.array(columns["n_tokens"], pa.int64()), *(pa.array(columns[c], pa.string()) for c in ("ids_sha256", "decoded_sha256"))]
            names = [*others, "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                made, names = [*made, pa.array(columns["ids"], pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=names)

    return docs.mapInArrow(run, schema)
