"""Operator 9: byte-level BPE encoding and decoding over Arrow batches.

Encoding uses the tokenizers library with a vocabulary given as a rank file
(base64 bytes and rank per line). Each match of the pattern is encoded by
itself, and every pair of known parts of a known token may merge, at the
token's rank, which is what rank-based encoders do. Decoding goes from ids to
bytes by table; characters that are split between tokens come back whole since
bytes are joined before they are read as UTF-8.

Defined results: null text counts as empty (no ids); empty tables give empty
results; repeated rows and ids are encoded row by row; columns of the input
other than the id and the text are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bizlens.llm.common import documents, gather, py_texts, slices
from bizlens.llm.piece_cache import PieceCache, byte_characters, spaced_pieces


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def build_tokenizer(ranks: dict[bytes, int], pattern: str):
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    chars = byte_characters()
    name = lambda token: "".join(chars[b] for b in token)
    merges = [(name(t[:i]), name(t[i:])) for t in sorted(ranks, key=ranks.get) if len(t) > 1
              for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    out = Tokenizer(models.BPE({name(t): r for t, r in ranks.items()}, merges, ignore_merges=True))
    out.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return out


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.cache = PieceCache(build_tokenizer(ranks, pattern))
        tokens = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            tokens[r] = t
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and each text's number of ids."""
        return self.cache.ids([spaced_pieces(t) for t in texts])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids in a row, and each id's number of bytes."""
        return gather(self.offsets, self.bytes, ids.astype(np.int64))

    def char_spans(self, ids: np.ndarray) -> np.ndarray:
        """Start and end of each token in characters of its text. A token that
        holds only the later bytes of a character shares that character's span."""
        data, lens = self.decode(ids)
        first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters begun before each byte
        end = np.cumsum(lens)
        begun, done = first[end - lens], first[end]
        inside = (data[np.minimum(end - lens, len(data) - 1)] & 0xC0) == 0x80 if len(data) else np.zeros(0, bool)
        return np.stack([begun - (inside & (lens > 0)), done], axis=1)


@functools.lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``ids`` (list of int) and ``spans`` (start and
    end of each token in characters, alternating)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            for lo, hi in slices(b.column(1)):
                texts = py_texts(b.column(1).slice(lo, hi - lo))
                ids, counts = c.encode(texts)
                parts = np.split(ids, np.cumsum(counts)[:-1])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())),
                     pa.array([c.char_spans(p).ravel().astype(np.int32) for p in parts], pa.list_(pa.int32()))],
                    ["id", "ids", "spans"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return out.mapInArrow(run, f"id {out.schema['id'].dataType.simpleString()}, ids array<int>, spans array<int>"
                          ).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds the bytes of each row's ids (binary; null ids give null)."""
    @F.pandas_udf("binary")
    def to_bytes(ids):
        c = codec(path, pattern)
        return ids.map(lambda x: None if x is None else c.decode(np.asarray(x))[0].tobytes())

    return encoded.withColumn(out_col, to_bytes(ids_col))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document the number of ids, and the SHA-256 of the ids (decimal,
    joined by a space) and of the bytes that the ids decode to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        names = [b"%d " % i for i in range(len(c.offsets) - 1)]
        at, written = np.concatenate([[0], np.cumsum([len(n) for n in names])]).astype(np.int64), np.frombuffer(b"".join(names), np.uint8)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            for lo, hi in slices(b.column(1)):
                ids, counts = c.encode(py_texts(b.column(1).slice(lo, hi - lo)))
                back, lens = c.decode(ids)
                text, digits = gather(at, written, ids.astype(np.int64))
                row = np.concatenate([[0], np.cumsum(counts)])
                to_b, to_t = (np.concatenate([[0], np.cumsum(x)])[row] for x in (lens, digits))
                back, text = back.tobytes(), text.tobytes()
                n = hi - lo
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, n), pa.array(counts, pa.int64()),
                     pa.array([sha(text[to_t[k] : max(to_t[k], to_t[k + 1] - 1)]) for k in range(n)]),
                     pa.array([sha(back[to_b[k] : to_b[k + 1]]) for k in range(n)])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocabularies

    return digests(documents(spark, sf_dir), vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN)
