"""Byte-level BPE through a sentencepiece model that is serialised directly from a vocabulary of byte strings.

Each of the 256 bytes stands for one character, each vocabulary entry becomes a piece of such characters with its negative rank
as score, and normalisation is the identity. sentencepiece then merges, at each step, the pair whose union has the lowest rank
(the leftmost among equals), which is what byte-level BPE does. A text is cut into pre-tokens by the pattern; a pre-token that is
itself an entry has that id, every other one is encoded by the model. Decoding maps ids back to bytes.

A null text counts as empty and has no ids. Any string is accepted, control characters and lone lines included; texts are read
whole. Repeated rows are encoded alike, other columns ignored, and an empty table gives an empty result. Decoding rejects ids
outside the vocabulary with a ValueError. A null id is carried like any other.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_or_empty, worker_slot

#: Bytes, about, of the pre-tokens and of the coarse cuts with their ids that a worker remembers; beyond them a memory is emptied.
FINE_BYTES, COARSE_BYTES = 96 << 20, 192 << 20

#: Coarse cuts of a text, each a run of whole pre-tokens of public_tokenizers.PATTERN: a pre-token reaches over white space only
#: by one leading space, so a word with that space and its punctuation can be looked up at once.
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
COARSE = rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"

#: One character for each byte: a block of letters without white space, marks or case pairs that could be joined; its low byte is 0.
FIRST_CHARACTER = 0x4E00


def read_ranks(path: str) -> list[bytes]:
    """Entries of a .tiktoken file in order of rank, which must run from 0 without gaps."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in (line.split() for line in f if line.strip()))
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must run from 0 without gaps")
    return [token for _, token in pairs]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def model_bytes(tokens: list[bytes]) -> bytes:
    """A sentencepiece ModelProto: one NORMAL piece for each token, in order, then the unknown piece it must have."""
    import struct

    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join(chr(FIRST_CHARACTER + b) for b in token).encode()
        out += _field(1, _field(1, piece) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)) + _number(3, 1))
    out += _field(1, _field(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2))
    minus_one = _varint((1 << 64) - 1)
    trainer = _number(3, 2) + _number(4, len(tokens) + 1) + _number(24, 0) + _number(40, len(tokens)) + b"".join(_varint(n << 3) + minus_one for n in (41, 42, 43))
    normaliser = _field(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    out += _field(2, trainer) + _field(3, normaliser)
    return bytes(out)


@lru_cache(maxsize=1)
def _stand_ins() -> dict[int, str]:
    """Characters that the regex library and tiktoken's engine class differently (their Unicode versions differ), each with a
    common character of the class that tiktoken gives it. Found by asking both about every character."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    single = {bytes([b]): b for b in range(256)}
    classes = {}
    for pattern, common in ((r"\p{L}", "\u00e9"), (r"\p{N}", "1"), (r"\s", " ")):
        theirs = set(bytes(tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode())
        ours = set(regex.findall(pattern, every))
        classes |= {ord(c): common for c in theirs - ours}
        for c in ours - theirs:
            classes.setdefault(ord(c), "\u2020")
    return classes


class ByteBpe:
    """coarse: a pattern whose matches are runs of whole matches of `pattern`, or None to cut by `pattern` alone."""

    def __init__(self, tokens: list[bytes], pattern: str, coarse: str | None = None):
        self.tokens = tokens
        self.whole = {t: i for i, t in enumerate(tokens)}
        self.pattern = regex.compile(pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(tokens))
        self.stand_ins = _stand_ins()
        #: A fast test that common texts pass; only then are all characters looked up.
        self.plain = min(self.stand_ins, default=0x110000)
        self.unusual = re.compile(f"[^\\x00-{chr(min(self.plain - 1, 0x24F))}]") if self.plain > 0x80 else re.compile(r"(?s).")
        self.single = [[i] for i in range(len(tokens))]
        self.decimal = [str(i) for i in range(len(tokens))]
        self.known: dict[str, list[int]] = {}
        self.fine_held = self.coarse_held = 0
        self.coarse = re.compile(coarse or r"(?s).+")
        self.use_coarse = coarse is not None
        self.packed: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        """Remember the ids of these pre-tokens; those that are no entries themselves are encoded in one call."""
        if self.fine_held > FINE_BYTES:
            self.known, self.fine_held = {}, 0
        new = list(words.difference(self.known))
        raw = [w.encode() for w in new]
        ids = [self.whole.get(r) for r in raw]
        ask = [k for k, i in enumerate(ids) if i is None]
        if ask:
            # chr(FIRST_CHARACTER + byte) in UTF-16 is the byte itself and the high byte of FIRST_CHARACTER.
            joined = b"".join([raw[k] for k in ask])
            wide = bytearray(2 * len(joined))
            wide[0::2], wide[1::2] = joined, bytes([FIRST_CHARACTER >> 8]) * len(joined)
            pieces, at, mapped = wide.decode("utf-16-le"), 0, []
            for k in ask:
                mapped.append(pieces[at : at + len(raw[k])])
                at += len(raw[k])
            for k, found in zip(ask, self.model.encode(mapped, num_threads=1), strict=True):
                self.known[new[k]] = found
        self.known.update((w, self.single[i]) for w, i in zip(new, ids, strict=True) if i is not None)
        self.fine_held += 160 * len(new) + 2 * sum(map(len, raw)) + 40 * sum(len(self.known[new[k]]) for k in ask)

    def is_odd(self, text: str) -> bool:
        return bool(self.unusual.search(text)) and not self.stand_ins.keys().isdisjoint(map(ord, text))

    def split(self, text: str) -> list[str]:
        """The pre-tokens: what the pattern matches, one after the other."""
        if self.is_odd(text):
            return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.stand_ins))]
        return self.pattern.findall(text)

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        if self.coarse_held > COARSE_BYTES:
            self.packed, self.coarse_held = {}, 0
        cuts: list[list[str] | None] = [self.coarse.findall(t) if self.use_coarse and not self.is_odd(t) else None for t in texts]
        new = list(set(chain.from_iterable(c for c in cuts if c)).difference(self.packed))
        whole = [self.split(t) for t, c in zip(texts, cuts, strict=True) if c is None]
        fine = [self.pattern.findall(c) for c in new]
        self.learn(set(chain.from_iterable(fine)) | set(chain.from_iterable(whole)))
        ids = [array("i", self.ids_of(words)).tobytes() for words in fine]
        self.packed.update(zip(new, ids, strict=True))
        self.coarse_held += 190 * len(new) + 2 * sum(map(len, new)) + sum(map(len, ids))
        rest = iter(whole)
        out = []
        for c in cuts:
            if c is None:
                out.append(self.ids_of(next(rest)))
            else:
                out.append(array("i", b"".join(map(self.packed.__getitem__, c))).tolist())
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def ids_of(self, words: list[str]) -> list[int]:
        return list(chain.from_iterable(map(self.known.__getitem__, words)))

    def decode(self, ids) -> bytes:
        try:
            if min(ids, default=0) < 0:
                raise IndexError
            return b"".join(map(self.tokens.__getitem__, ids))
        except IndexError:
            raise ValueError("an id lies outside the vocabulary") from None


def load(path: str, pattern: str, coarse: str | None = None) -> ByteBpe:
    return worker_slot(("byte_bpe", path, pattern, coarse), lambda: ByteBpe(read_ranks(path), pattern, coarse))


def encode_texts(docs: DataFrame, *, vocabulary: str, pattern: str, coarse: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary, pattern, coarse)
        for b in small_batches(batches, ["text"]):
            ids = bpe.encode_all(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, *, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, bytes (binary) of rows with doc_id and ids; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([bpe.decode(i or ()) for i in b.column("ids").to_pylist()], pa.binary())], names=["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip_digests(docs: DataFrame, *, vocabulary: str, pattern: str, coarse: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row: encodes, decodes the ids, and keeps digests only, so that no array of ids leaves the worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary, pattern, coarse)
        for b in small_batches(batches, ["text"], 2 << 20):
            counts, said, back = [], [], []
            for ids in bpe.encode_all(b.column("text").to_pylist()):
                counts.append(len(ids))
                said.append(hashlib.sha256(",".join(map(bpe.decimal.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(said), pa.array(back)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
