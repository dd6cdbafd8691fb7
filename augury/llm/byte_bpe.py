"""Byte-level BPE through sentencepiece: its model is serialised straight from the ranks."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.llm.shared import rows_of

#: Where the printable stand-ins of the 256 bytes begin; a letter-like block without case or composition.
BYTE_BASE = 0x4E00
#: Chunks that a task remembers the ids of; beyond it, it starts anew.
REMEMBER = 400_000

_UNKNOWN, _BYTE_MODEL = 2, 2


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: base64 of a token's bytes, and its rank, on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


# --- the model as sentencepiece stores it: protocol buffer messages ----------


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


_STAND_INS = {b: BYTE_BASE + b for b in range(256)}


def stand_in(data: bytes) -> str:
    """A character for each byte."""
    return data.decode("latin-1").translate(_STAND_INS)


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def serialised(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece ``r`` is the token of rank ``r``.

    A piece scores the negative rank, so the pair merged first is the one of lowest rank, at
    equal ranks the leftmost. Normalisation is the identity: no prefix, no white space removed
    or escaped. One unknown piece follows the last rank; no text holds it.
    """
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every byte needs a rank")
    unknown = "<unk>".encode()
    pieces = [_field(1, stand_in(t).encode()) + _field(2, -float(r)) for r, t in enumerate(tokens)]
    pieces.append(_field(1, unknown) + _field(2, 0.0) + _field(3, _UNKNOWN))
    trainer = _field(3, _BYTE_MODEL) + _field(4, len(pieces)) + _field(40, len(tokens))
    # ids of <s>, </s> and <pad>: none
    trainer += b"".join(_field(n, (1 << 64) - 1) for n in (41, 42, 43))
    normaliser = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


class ByteBpe:
    """Encode whole texts to packed unsigned 32-bit ids, and back to bytes."""

    def __init__(self, path: str, pattern: str, remember: int = REMEMBER):
        import sentencepiece

        ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised(ranks))
        self.tokens = sorted(ranks, key=ranks.get)
        self.whole = {token: struct.pack("<I", rank) for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.remember = remember

    def _learn(self, chunks: set[str]) -> None:
        if len(self.parts) > self.remember:
            self.parts.clear()
        parts, whole, find = self.parts, self.whole, self.pattern.findall
        split = [(chunk, find(chunk)) for chunk in chunks]
        new, coded = [], []
        for part in {p for _, own in split for p in own}.difference(parts):
            data = part.encode()
            # As usual for these vocabularies, a match that is a token is that token.
            if data in whole:
                parts[part] = whole[data]
            else:
                new.append(part)
                coded.append(stand_in(data))
        for part, ids in zip(new, self.model.encode(coded, num_threads=1)):
            parts[part] = packed(ids)
        for chunk, own in split:
            self.known[chunk] = parts[own[0]] if len(own) == 1 else b"".join(map(parts.__getitem__, own))

    def encode(self, text: str) -> bytes:
        """Ids of the text's matches, one after the other.

        No match crosses a single space between two other characters: the space begins the
        next one. So a text may be cut there, and its chunks come back often. A text with any
        other white space around a space is one chunk.
        """
        chunks = text.split(" ")
        if _LONE.search(text) is None:
            chunks = [chunks[0], *[" " + c for c in chunks[1:]]]
        else:
            chunks = _whole(text, chunks)
        try:
            return b"".join(map(self.known.__getitem__, chunks))
        except KeyError:
            if len(self.known) > self.remember:
                self.known.clear()
            self._learn({c for c in chunks if c not in self.known})
            return b"".join(map(self.known.__getitem__, chunks))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


#: A space at an end of the text or beside other white space.
_LONE = regex.compile(r"\s\x20|\x20\s|^\x20|\x20$|\x20[\x1c-\x1f\x85]|[\x1c-\x1f\x85]\x20")


def _whole(text: str, chunks: list[str]) -> list[str]:
    """Cut only at spaces between two characters that are not white space."""
    out, held = [], chunks[0]
    for chunk in chunks[1:]:
        if held and chunk and not held[-1].isspace() and not chunk[0].isspace():
            out.append(held)
            held = " " + chunk
        else:
            held += " " + chunk
    out.append(held)
    return out


def _coded(path: str, pattern: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteBpe(path, pattern)
        for batch in batches:
            count, digest, back, ids = [], [], [], []
            for text in batch.column("text"):
                coded = coder.encode(text.as_py() or "")
                count.append(len(coded) // 4)
                digest.append(hashlib.sha256(coded).hexdigest())
                back.append(hashlib.sha256(coder.decode(coded)).hexdigest())
                if with_ids:
                    ids.append(np.frombuffer(coded, "<u4").astype(np.int32))
            columns = [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(digest, pa.string()), pa.array(back, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encode_and_decode(
    docs: DataFrame, ranks: str, pattern: str, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row, and ``ids`` if asked for.

    Each match of ``pattern`` is encoded by itself, without special tokens. Null is the empty
    text: no ids. Ids and repeated rows pass through as they are; an empty table gives no rows.
    One narrow stage; ``ranks`` is a file that every executor has.
    """
    rows = rows_of(docs, id_col, text_col).withColumnRenamed(text_col, "text")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return rows.mapInArrow(_coded(ranks, pattern, with_ids), schema)


def decode_ids(coded: DataFrame, ranks: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``, the bytes of the ids in ``ids_col``; null stays null."""
    schema = coded.withColumn("decoded", F.lit(None).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = read_ranks(ranks)
        tokens = sorted(known, key=known.get)
        for batch in batches:
            out = [None if row is None else b"".join(tokens[i] for i in row) for row in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    return coded.mapInArrow(run, schema)
