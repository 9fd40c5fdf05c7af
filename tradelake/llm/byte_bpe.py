"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece there is exactly one token that ends its encoding.  A token ``t`` that ends
at byte ``i`` is that token if the encoding of the bytes before it ends in a token ``s`` such that the two
bytes strings together encode to ``[s, t]``.  So one pass stores the last token of each prefix; following
it backwards gives the encoding.  Appending bytes extends the table exactly, and an edit leaves the table
valid up to its first changed byte.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Kept, TextEncoder, bound_batches, worker_value

#: Bytes of a piece whose table is kept for other pieces that begin alike.
PREFIX = 6
#: Entries of the tables that a worker keeps: pairs of tokens and beginnings of pieces (which start anew when
#: full), pieces and segments (in each of two generations).
PAIR_LIMIT, BEGUN_LIMIT, PIECE_LIMIT, SEGMENT_LIMIT = 400_000, 60_000, 80_000, 120_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of base64 tokens and numbers."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PrefixBPE:
    """Encoder of pieces by the table of last tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.matcher = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.matcher.add_word(token.decode("latin-1"), (rank, len(token)))
        self.matcher.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.trees: dict[int, tuple | None] = {}
        self.begun: dict[bytes, list[int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The definition: merge the neighbours of lowest rank, leftmost first, until none can be merged."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def spines(self, token: int) -> tuple | None:
        """What stands at a token's right and left edge while it is merged: (bytes, made at, used up at) by rank.

        None if its own merges don't give the token, or not in the order of their ranks.
        """
        if token in self.trees:
            return self.trees[token]
        whole, ranks = self.token_bytes[token], self.ranks
        parts, never = [(whole[i : i + 1], -1) for i in range(len(whole))], len(ranks) + 1
        right, left, last, fine = [parts[-1]], [parts[0]], -1, True
        while len(parts) > 1:
            found = [(rank, i) for i in range(len(parts) - 1) if (rank := ranks.get(parts[i][0] + parts[i + 1][0])) is not None]
            if not found:
                fine = False
                break
            rank, i = min(found)
            fine, last = fine and rank >= last, rank
            parts[i : i + 2] = [(parts[i][0] + parts[i + 1][0], rank)]
            if i == len(parts) - 1:
                right.append(parts[-1])
            if i == 0:
                left.append(parts[0])
        ends = lambda spine: [(*x, y[1]) for x, y in zip(spine, [*spine[1:], (b"", 1 << 60)])]
        self.trees[token] = out = (ends(right), ends(left)) if fine and last < never else None
        return out

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` can follow ``before`` (-1: the start) in an encoding.

        The two meet in the middle: if what stands at both edges at some time has a merge of lower rank than
        those that use the edges up (on a tie the left one goes first), that merge breaks the pair.
        """
        key = before << 32 | token
        known = self.pairs.get(key)
        if known is not None:
            return known
        if len(self.pairs) >= PAIR_LIMIT:
            self.pairs.clear()
        mine = self.spines(token)
        if before < 0:
            known = mine is not None or self.merge(self.token_bytes[token]) == [token]
        elif mine is None or (other := self.spines(before)) is None:
            known = self.merge(self.token_bytes[before] + self.token_bytes[token]) == [before, token]
        else:
            known, (right, _), (_, left), i, j = True, other, mine, 0, 0
            while i < len(right) and j < len(left):
                (x, _, x_end), (y, _, y_end) = right[i], left[j]
                rank = self.ranks.get(x + y)
                if rank is not None and rank < x_end and rank <= y_end:
                    known = False
                    break
                if x_end <= y_end:
                    i += 1
                else:
                    j += 1
        self.pairs[key] = known
        return known

    def extend(self, piece: bytes, table: list[int], keep: int = 0) -> list[int]:
        """The table of last tokens of ``piece``, of which ``table`` covers the first ``keep`` bytes already."""
        table = table[: keep + 1] or [-1]
        start = max(0, keep - self.longest)
        ready, known, fits, put = keep - 1, self.pairs.get, self.fits, table.append
        for end, (token, n) in self.matcher.iter(piece[start:].decode("latin-1")):
            end += start
            if end > ready:
                before = table[end + 1 - n]
                found = known(before << 32 | token)
                if found or found is None and fits(before, token):
                    put(token)
                    ready = end
        return table

    @property
    def longest(self) -> int:
        if not hasattr(self, "_longest"):
            self._longest = max(map(len, self.ranks), default=0)
        return self._longest

    def follow(self, piece_length: int, table: list[int]) -> list[int]:
        out, i = [], piece_length
        while i:
            out.append(table[i])
            i -= len(self.token_bytes[table[i]])
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        start = piece[:PREFIX]
        begun = self.begun.get(start)
        if begun is None:
            if len(self.begun) >= BEGUN_LIMIT:
                self.begun.clear()
            begun = self.begun[start] = self.extend(start, [])
        table = self.extend(piece, begun, len(start)) if len(begun) == len(start) + 1 else []
        if len(table) != len(piece) + 1:  # ranks that no merging order gives
            return self.merge(piece)
        return self.follow(len(piece), table)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.token_bytes[i] for i in ids])


class EditableEncoding:
    """A piece with its table: appends are exact, and an edit re-encodes from its first changed byte on."""

    def __init__(self, bpe: PrefixBPE, piece: bytes = b""):
        self.bpe, self.piece, self.table = bpe, piece, bpe.extend(piece, [])

    def append(self, more: bytes) -> None:
        self.table = self.bpe.extend(self.piece + more, self.table, len(self.piece))
        self.piece += more

    def replace(self, start: int, end: int, new: bytes) -> None:
        self.piece = self.piece[:start] + new + self.piece[end:]
        self.table = self.bpe.extend(self.piece, self.table, start)

    def ids(self) -> list[int]:
        whole = self.bpe.ranks.get(self.piece)
        return [whole] if whole is not None else self.bpe.follow(len(self.piece), self.table)


class TextCodec:
    """Encode whole texts, each match of a pattern separately, and decode ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe, self.pattern = PrefixBPE(ranks), regex.compile(pattern)
        self.kind = np.dtype("<u2" if max(ranks.values(), default=0) < 1 << 16 else "<u4")
        self.pieces = Kept(PIECE_LIMIT)

    def piece(self, match: str) -> bytes:
        return np.array(self.bpe.encode_piece(match.encode()), self.kind).tobytes()

    def packed(self, text: str) -> bytes:
        """The ids as numbers of type ``kind``."""
        return b"".join([self.pieces.one(match, self.piece) for match in self.pattern.findall(text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), self.kind).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return self.bpe.decode(ids)


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and decode every text: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids``.

    ``ids_sha256`` is of the decimal ids joined by commas, ``decoded_sha256`` of the bytes that decoding
    the ids gives.  A null text counts as empty and an empty one has no tokens; null ids and repeated rows
    are kept; other columns are not read.  Rows are independent: there is no shuffle, a lost task is done
    again.  Each worker keeps tables of bounded size.  The ranks file must be at ``ranks_path`` on every
    machine, as the tokenizer's library is.
    """
    bound_batches(docs.sparkSession)
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def make() -> tuple:
        codec = TextCodec(load_ranks(ranks_path), pattern)
        names, token_bytes = [""] * (1 + max(codec.bpe.token_bytes, default=0)), [b""] * (1 + max(codec.bpe.token_bytes, default=0))
        for i, token in codec.bpe.token_bytes.items():
            names[i], token_bytes[i] = str(i), token
        return TextEncoder(lambda parts, before: [codec.packed(before + part) for part in parts], codec.kind, SEGMENT_LIMIT), names, token_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, names, token_bytes = worker_value("byte_bpe", (ranks_path, pattern), make)
        sha = hashlib.sha256
        for batch in batches:
            n, a, b, lists = [], [], [], []
            for packed in encoder.encoded(batch.column(1)):
                ids = packed.tolist()
                n.append(len(ids))
                a.append(sha(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                b.append(sha(b"".join(map(token_bytes.__getitem__, ids))).hexdigest())
                if with_ids:
                    lists.append(ids)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            if with_ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
