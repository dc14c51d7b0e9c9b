"""Byte-level BPE through a sentencepiece model serialised from a rank file.

The rank vocabulary (token bytes, rank) becomes a sentencepiece BPE
``ModelProto``: every token's bytes are mapped one to one to printable
characters, its score is the negative rank (so the highest-scored merge is the
lowest rank), normalisation is the identity, and ids are ranks shifted by the
one place that the obligatory unknown piece takes. Pre-tokens are cut by the
vocabulary's pattern; decoding maps ids back to bytes. Tokenizers are never
trained here.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.words import ready

#: Pre-tokens whose ids a Python worker remembers; beyond it starts afresh.
CACHE = 150_000
#: Pre-tokens of more characters are encoded each time and never remembered.
CACHE_CHARS = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of base64 token and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def byte_chars() -> str:
    """The character of each byte: visible Latin-1 bytes stand for themselves,
    the others for the characters from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return "".join(chr(b if b in shown else next(free)) for b in range(256))


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """The ModelProto as protocol-buffer bytes: pieces (1), trainer settings
    (2: model type BPE) and an identity normaliser (3). Piece 0 is the unknown
    piece; the token of the n-th rank is piece n + 1."""
    chars = byte_chars()
    unknown = _field(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + b"\x18\x02"
    out = [_field(1, unknown)]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        piece = "".join(chars[b] for b in token).encode()
        out.append(_field(1, _field(1, piece) + b"\x15" + struct.pack("<f", -float(rank)) + b"\x18\x01"))
    model_type = _varint(3 << 3) + b"\x02"
    no = lambda number: _varint(number << 3) + b"\x00"
    out.append(_field(2, model_type + _varint(4 << 3) + _varint(len(ranks) + 1)))
    # No character map, no dummy prefix, white space neither removed nor escaped.
    out.append(_field(3, _field(1, b"identity") + no(3) + no(4) + no(5)))
    return b"".join(out)


class _Known(dict):
    """Ids of the pre-tokens met so far, filled on first use."""

    def __init__(self, owner: Codec):
        super().__init__()
        self.owner = owner

    def __missing__(self, part: str) -> tuple[int, ...]:
        ids = self.owner.pre_token(part)
        if len(part) <= CACHE_CHARS:
            if len(self) >= CACHE:
                self.clear()
            self[part] = ids
        return ids


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        order = sorted(ranks.items(), key=lambda x: x[1])
        self.rank_of = [r for _, r in order]
        self.dense = self.rank_of == list(range(len(order)))
        self.tokens = {r: t for t, r in order}
        self.bytes_of = [t for t, _ in order] if self.dense else self.tokens
        self.whole = {t.decode(): r for t, r in order if self._is_text(t)}
        self.chars = byte_chars()
        self.find = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(serialise_model(ranks))
        self.known = _Known(self)

    @staticmethod
    def _is_text(token: bytes) -> bool:
        try:
            token.decode()
        except UnicodeDecodeError:
            return False
        return True

    def encode(self, text: str) -> array:
        """Ids of a text, pre-token by pre-token."""
        return array("I", chain.from_iterable(map(self.known.__getitem__, self.find(text))))

    def pre_token(self, part: str) -> tuple[int, ...]:
        """Ids of one pre-token: one that is a token itself is that token, any
        other is merged by the model."""
        if part in self.whole:
            return (self.whole[part],)
        pieces = self.model.encode(part.encode().decode("latin-1").translate(self.chars))
        return tuple(i - 1 for i in pieces) if self.dense else tuple(self.rank_of[i - 1] for i in pieces)

    def decode(self, ids) -> bytes:
        """The bytes of the ids: the inverse of the vocabulary."""
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per Python worker and vocabulary."""
    return Codec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Encode every whole text, then decode its ids.

    Returns ``(id_col, n_tokens, ids array<int>, ids_sha256, decoded_sha256,
    round_trip)``; ``ids`` is left out with ``keep_ids=False``. The vocabulary
    file must be at ``path`` on every executor. A null text is the empty text
    (no ids); null ids and repeated rows pass through row by row, and extra
    columns are ignored. One narrow pass: no shuffle.
    """
    ready(docs.sparkSession, 512)
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
              ("decoded_sha256", pa.string()), ("round_trip", pa.bool_())]
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"
    if keep_ids:
        fields.append(("ids", pa.list_(pa.int32())))
        schema += ", ids array<int>"
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches):
        tool = codec(path, pattern)
        for batch in batches:
            out, ends, every = {n: [] for n, _ in fields}, [0], []
            for text in batch.column(1):
                text = text.as_py() or ""
                ids = tool.encode(text)
                raw = tool.decode(ids)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(_little_endian(ids)).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(raw).hexdigest())
                out["round_trip"].append(raw == text.encode())
                if keep_ids:
                    every.append(_little_endian(ids))
                    ends.append(ends[-1] + len(ids))
            cols = [pa.array(out[n], t) for n, t in fields if n != "ids"]
            if keep_ids:
                flat = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(every))])
                cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))
            yield pa.record_batch([batch.column(0), *cols], names=["_id", *(n for n, _ in fields)])

    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")) \
        .mapInArrow(run, f"_id {id_type}, {schema}")
    return out.withColumnRenamed("_id", id_col)


def _little_endian(ids: array) -> bytes:
    import sys

    if sys.byteorder != "little":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()
