"""Exact SentencePiece BPE encoding by backtracking, and decoding.

A tokenization is the one that merging gives exactly if every token merges back to itself and every
two adjacent tokens, merged anew from their characters, give the same two tokens: no merge can be the
first to cross one of its boundaries. So the encoder walks from the left over the longest vocabulary
matches (Aho-Corasick), takes the longest one whose pair with the token before is compatible, goes to
its next shorter prefix otherwise, and on a dead end steps back and marks the position as failed in
a bit field, so that no position is tried twice.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.functions import arrow_udf

from tallyfold.llm.common import fresh, text_or_empty

SPACE = "▁"
RESULT = "n_tokens:long, ids_sha256:string, decoded_sha256:string"


class _Chunks(dict):
    """Chunk to its ids as bytes. When full, it keeps what was used since it was last full."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit, self.older = encode, limit, {}

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        found = self.older.get(chunk)
        if found is None:
            found = array("I", self.encode(chunk)).tobytes()
        self[chunk] = found
        return found


class BacktrackingEncoder:
    """Encodes like the library for BPE models whose every character is a piece, with byte fallback.

    Other models (other types, characters that are no pieces, user-defined pieces) are refused.
    """

    def __init__(self, model: bytes, cached_chunks: int = 300_000, cached_pairs: int = 400_000):
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise ValueError("ids are packed as little-endian 32-bit integers")
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.score, self.id_of, self.byte_id = {}, {}, {}
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
            elif lib.is_unused(i):
                raise ValueError("unused pieces are not supported")
            elif not (lib.is_control(i) or lib.is_unknown(i)):
                self.score[piece], self.id_of[piece] = lib.get_score(i), i
        chars = {c for piece in self.id_of for c in piece}
        if len(self.byte_id) != 256 or not chars <= self.id_of.keys():
            raise ValueError("the model needs byte fallback and a piece for each of its characters")
        probe = " a  béﬁ　\t "
        if lib.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model normalises its input")
        self.piece_of = {i: p for p, i in self.id_of.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.length = {i: len(p) for p, i in self.id_of.items()}
        self.shorter = {i: next((self.id_of[p[:k]] for k in range(len(p) - 1, 0, -1)
                                 if p[:k] in self.id_of), -1) for p, i in self.id_of.items()}
        self.split = self._splitter(chars)
        self.pairs: dict[int, bool] = {}  # key: last << 32 | token
        self.cached_pairs = cached_pairs
        self.chunks = _Chunks(self.encode_chunk, cached_chunks)

    def _splitter(self, chars: set[str]):
        """Cuts a text into chunks at places that no merge can cross.

        Those are: around characters that no longer piece holds, and, if no piece holds a space
        behind another character, before a run of spaces.
        """
        joined = {c for p in self.id_of if len(p) > 1 for c in p} - {SPACE}
        group = "".join(f"\\U{ord(c):08x}" for c in sorted(joined))
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id_of):
            word = f"[{group}{SPACE}]+"
        else:
            word = f"{SPACE}*[{group}]+"
        return re.compile(f"{word}|{SPACE}+|.", re.DOTALL).findall

    def merged(self, text: str) -> list[str]:
        """The pieces that merging leaves: the best-scored, then leftmost pair first."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, last: int, token: int) -> bool:
        """Whether the two tokens stay apart and whole when merged anew; last -1: token alone."""
        if len(self.pairs) >= self.cached_pairs:
            self.pairs.clear()
        tokens = [self.piece_of[t] for t in (last, token) if t >= 0]
        known = self.pairs[last << 32 | token] = self.merged("".join(tokens)) == tokens
        return known

    def encode_chunk(self, chunk: str) -> list[int]:
        if len(chunk) == 1:
            return [self.id_of[chunk]] if chunk in self.id_of else [
                self.byte_id[b] for b in chunk.encode()]
        length, shorter, known = self.length, self.shorter, self.pairs.get
        size = len(chunk)
        longest = [-1] * (size + 1)
        for end, token in self.automaton.iter(chunk):
            longest[end + 1 - length[token]] = token  # ends ascend: the last one is the longest
        open_at = bytearray(b"\xff" * (size // 8 + 1))  # one bit a position, 0: failed
        tokens: list[int] = []
        at, last, token = 0, -1, longest[0]
        while at < size:
            while token >= 0:
                end = at + length[token]
                if open_at[end >> 3] >> (end & 7) & 1:
                    fits = known(last << 32 | token)
                    if self.compatible(last, token) if fits is None else fits:
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at, last, token = end, token, longest[end]
            elif tokens:
                open_at[at >> 3] &= ~(1 << (at & 7)) & 255
                token = tokens.pop()
                at, last = at - length[token], tokens[-1] if tokens else -1
            else:
                raise AssertionError(f"no tokenization of {chunk!r}")
        return tokens

    def encode(self, text: str) -> np.ndarray:
        """Ids with the begin and end ids, unsigned 32-bit little-endian."""
        body = ""
        if text:
            body = SPACE + text.replace(" ", SPACE)
        ends = np.array([self.library.bos_id(), self.library.eos_id()], dtype="<u4").tobytes()
        packed = b"".join(map(self.chunks.__getitem__, self.split(body)))
        return np.frombuffer(ends[:4] + packed + ends[4:], dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


def codec(spark: SparkSession, model_path: str, keep_ids: bool = False):
    """An Arrow UDF of a text column: struct of ``n_tokens, ids_sha256, decoded_sha256``.

    ``keep_ids`` adds ``ids`` (array of int) and ``decoded`` (string), the real outputs. The
    vocabulary file (its size is that of one tokenizer) reaches the executors as a broadcast.
    """
    with open(model_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())
    kind = RESULT + (", ids:array<int>, decoded:string" if keep_ids else "")

    @arrow_udf(f"struct<{kind}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = BacktrackingEncoder(model.value)
        for batch in batches:
            counts, digests, back, all_ids, decoded = [], [], [], [], []
            for scalar in batch:
                text = scalar.as_py() or ""
                ids = encoder.encode(text)
                plain = encoder.decode(ids)
                counts.append(len(ids))
                digests.append(hashlib.sha256(ids.tobytes()).hexdigest())
                back.append(hashlib.sha256(plain.encode()).hexdigest())
                if keep_ids:
                    all_ids.append(ids.astype(np.int32))
                    decoded.append(plain)
            columns = [pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                       pa.array(back, pa.string())]
            names = ["n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.StructArray.from_arrays(columns, names)

    return run


def encode_and_decode(docs: DataFrame, model_path: str, text: str | Column = "text",
                      keep_ids: bool = False) -> DataFrame:
    """``docs`` with a struct column ``codec`` (renamed by underscores if taken): see ``codec``.

    One row for each row, repeated ones too, no shuffle. A null or empty text has the begin and end
    ids only and decodes to the empty text. An empty table gives an empty one.
    """
    udf = codec(docs.sparkSession, model_path, keep_ids)
    return docs.withColumn(fresh(docs, "codec"), udf(text_or_empty(text)))
