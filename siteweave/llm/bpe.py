"""Byte-level BPE by a sentencepiece model that is serialised directly from a rank file.

Every byte has a printable character; a vocabulary entry becomes the piece of its bytes' characters, scored by its negative
rank, so that sentencepiece's merges (highest score first, leftmost first) are the merges of the rank file. The model has an
identity normaliser and neither dummy prefix nor space handling. Text is cut into pre-tokens by the vocabulary's pattern and
each pre-token is encoded on its own: a pre-token that is itself an entry is one token, every other one goes through the
model. Decoding maps ids back to bytes.

Defined results: null text is empty; empty text has no tokens, and its decoded bytes are empty; texts of any length are
encoded whole; special tokens do not exist, their strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from siteweave.recovery import handed_back

#: A worker remembers the ids of so many different pre-tokens; then it forgets them all and goes on.
REMEMBERED = 150_000
#: Texts are encoded in groups of about so many characters.
GROUP_CHARS = 400_000
#: Longer pre-tokens are not remembered.
REMEMBERED_LENGTH = 48


def byte_characters() -> list[str]:
    """A printable character for each byte: printable Latin-1 stands for itself, the others follow from code point 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file in the order of their ranks, which must be 0, 1, 2, ..."""
    with open(path, "rb") as lines:
        found = sorted((int(rank), base64.b64decode(entry)) for entry, rank in map(bytes.split, lines))
    if [rank for rank, _ in found] != list(range(len(found))):
        raise ValueError(f"{path}: the ranks are not 0 to {len(found) - 1}")
    return [entry for _, entry in found]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _message(number: int, body: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(body)) + body


def _flag(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def serialise_model(entries: list[bytes]) -> bytes:
    """The entries as a sentencepiece ModelProto of type BPE; id = rank, and <unk> after the last."""
    chars = byte_characters()
    # fixed values, field numbers of the public sentencepiece schema: ModelProto pieces 1, trainer_spec 2, normalizer_spec 3;
    # piece 1, score 2, type 3 (UNKNOWN 2); model_type 3 (BPE 2), vocab_size 4; name 1, add_dummy_prefix 3,
    # remove_extra_whitespaces 4, escape_whitespaces 5; unk_id 40, bos_id 41, eos_id 42, pad_id 43
    out = [_message(1, _message(1, "".join(chars[b] for b in entry).encode()) + b"\x15" + struct.pack("<f", -rank)) for rank, entry in enumerate(entries)]
    out.append(_message(1, _message(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _flag(3, 2)))
    absent = (1 << 64) - 1
    out.append(_message(2, _flag(3, 2) + _flag(4, len(entries) + 1) + _flag(40, len(entries)) + _flag(41, absent) + _flag(42, absent) + _flag(43, absent)))
    out.append(_message(3, _message(1, b"identity") + _flag(3, 0) + _flag(4, 0) + _flag(5, 0)))
    return b"".join(out)


class Codec:
    """Encoder and decoder for one rank file and one pre-token pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        import sentencepiece

        self.entries = read_ranks(path)
        self._rank = {entry: rank for rank, entry in enumerate(self.entries)}
        self._chars = {b: c for b, c in enumerate(byte_characters())}
        self._model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.entries))
        self._cut = regex.compile(pattern).findall
        self._decimal = [str(rank) for rank in range(len(self.entries))]
        self._known: dict[str, tuple[int, ...]] = {}

    def _learn(self, tokens: Iterable[str]) -> list[str]:
        """Adds the ids of new pre-tokens; returns those that are too long to be remembered."""
        asked, mapped, known = [], [], self._known
        for token in tokens:
            raw = token.encode()
            rank = self._rank.get(raw)
            if rank is not None:
                known[token] = (rank,)
            else:
                asked.append(token)
                mapped.append(raw.decode("latin-1").translate(self._chars))
        if asked:
            known.update(zip(asked, map(tuple, self._model.encode(mapped, out_type=int, num_threads=1)), strict=True))
        return [token for token in asked if len(token) > REMEMBERED_LENGTH]

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        """The ids of each text. Texts are cut in groups, so that the model is asked once for all new pre-tokens of a group."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size > GROUP_CHARS:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> list[list[int]]:
        cut = [self._cut(text) for text in texts]
        if len(self._known) > REMEMBERED:
            self._known.clear()
        new = set().union(*cut).difference(self._known)
        long = self._learn(new) if new else ()
        get = self._known.__getitem__
        ids = [list(chain.from_iterable(map(get, tokens))) for tokens in cut]
        for token in long:
            del self._known[token]
        return ids

    def forget(self) -> None:
        """At the end of a task: the worker lives on, for other tasks, of which some are other operators'."""
        self._known.clear()
        handed_back()

    def encode(self, text: str | None) -> list[int]:
        return self._encode_group([text or ""])[0]

    def spelt(self, ids: Iterable[int]) -> str:
        """The decimal ids joined by commas."""
        return ",".join(map(self._decimal.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids))


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker process."""
    return Codec(path, pattern)


def encode_column(text: Column, path: str, pattern: str) -> Column:
    """The ids of each text as array<int>."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for texts in batches:
            yield pd.Series(list(own.encode_all(texts)), index=texts.index, dtype=object)

    return ids(text)


def decode_column(ids: Column, path: str, pattern: str) -> Column:
    """The bytes of each array of ids; null for null."""

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for rows in batches:
            yield pd.Series([None if x is None else own.decode(x) for x in rows], index=rows.index, dtype=object)

    return decoded(ids)


def round_trip(docs: DataFrame, columns: list[str], path: str, pattern: str, text: str = "text") -> DataFrame:
    """``columns`` of ``docs`` with n_tokens, ids and round_trip (do the ids decode to the text?) of each text.

    One worker encodes and decodes, and hands on slices of about ``GROUP_CHARS`` characters, so that it never holds the ids
    of a whole batch. ``columns`` have other names than the three new ones.
    """
    own = StructType([docs.schema[c] for c in columns])
    schema = StructType([*own.fields, StructField("n_tokens", LongType()), StructField("ids", ArrayType(IntegerType())), StructField("round_trip", BooleanType())])
    n = len(columns)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = codec(path, pattern)
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(n)), 0).to_numpy(zero_copy_only=False))
            cuts = [0, *(np.flatnonzero(np.diff(sizes // GROUP_CHARS)) + 1).tolist(), batch.num_rows]
            for low, high in pairwise(cuts):
                part = batch.slice(low, high - low)
                counts, ids, same = [], [], []
                texts = part.column(n).to_pylist()
                for t, found in zip(texts, by.encode_all(texts), strict=True):
                    counts.append(len(found))
                    same.append(by.decode(found) == (t or "").encode())
                    ids.append(np.array(found, np.int32))
                values = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts, dtype=np.int64)].astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(counts, pa.int64()), lists, pa.array(same, pa.bool_())], names=schema.names)
        by.forget()

    return docs.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").alias("\x00text")).mapInArrow(encoded, schema)


def digest_column(text: Column, path: str, pattern: str) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256): encodes each text, then decodes those ids."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(path, pattern)
        for texts in batches:
            rows = []
            for ids in own.encode_all(texts):
                rows.append((len(ids), hashlib.sha256(own.spelt(ids).encode()).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"], index=texts.index)
        own.forget()

    return digests(text)
