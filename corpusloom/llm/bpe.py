"""Operator 2, byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece there is exactly one token that ends its encoding. It is the vocabulary entry that (a) is a
suffix of the prefix, found by an Aho-Corasick automaton over the vocabulary, and (b) is compatible with the last token of
the prefix it leaves. Following these last tokens back from the end gives the ids. The cost is linear in the piece, however
long, and no merge queue is kept.

Compatibility of (a, b): undo merges on the side that was made last and see whether, at any moment, the vocabulary has a
merge across the border that would have come earlier.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import bound_batches, caches, chunks, claim
from corpusloom.shipping import ship

#: The white space of Unicode, and the split of byte-level vocabularies.
_WS = r"\t-\r \x85\xA0  -     　"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
#: Entries that a worker's cache of pieces may hold, and the longest piece that it keeps.
CACHE, CACHED_LENGTH = 120_000, 64
#: Results of pair tests that a worker may hold.
TESTS = 200_000
_SCHEMA = "doc_id long, n_tokens long, ids binary, decoded_sha256 string"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next code point from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class BytePairCodec:
    """Encodes and decodes with one vocabulary, given as the bytes of its tokenizer file."""

    def __init__(self, source: bytes) -> None:
        spec = json.loads(source)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ()) if t["content"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.alphabet = dict(enumerate(byte_alphabet()))
        self.split = regex.compile(SPLIT)
        back = {c: b for b, c in self.alphabet.items()}
        self.token_bytes = {i: bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t, i in (vocabulary | self.special).items()}
        #: made[token]: when a merge makes it; parts[token]: of what. Single bytes were there before any merge.
        self.made, self.parts, self.joined = {}, {}, {}
        for order, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, whole = vocabulary[left], vocabulary[right], vocabulary[left + right]
            self.joined[a, b] = (order, whole)
            if whole not in self.made:
                self.made[whole], self.parts[whole] = order, (a, b)
        self.automaton = ahocorasick.Automaton()
        for token, i in vocabulary.items():
            if len(token) == 1 or i in self.made:
                self.automaton.add_word(token, (len(token), i))
        self.automaton.make_automaton()
        self.cache, self.tests = _Cache(self), {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoding of a's bytes followed by b's is exactly (a, b).

        The border is rolled back in time. A merge over it wins over the merge that was undone last if it comes earlier; at
        the same time (one rule, overlapping) the left place wins.
        """
        made, joined = self.made, self.joined
        bound, bound_is_left = None, False
        while True:
            across = joined.get((a, b))
            if across is not None and (bound is None or across[0] < bound or (across[0] == bound and not bound_is_left)):
                return False
            ta, tb = made.get(a, -1), made.get(b, -1)
            if ta < 0 and tb < 0:
                return True
            if ta > tb or (ta == tb and tb < 0):
                bound, bound_is_left, a = ta, True, self.parts[a][1]
            else:
                bound, bound_is_left, b = tb, False, self.parts[b][0]

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece of the split: last[i] is the token that ends the encoding of the first i bytes."""
        word = piece.encode().decode("latin-1").translate(self.alphabet)
        last = [-1] * (len(word) + 1)
        size = [0] * (len(word) + 1)
        tests = self.tests
        for end, (length, token) in self.automaton.iter(word):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                fits = tests.get(pair := before << 32 | token)
                if fits is None:
                    if len(tests) >= TESTS:
                        tests.clear()
                    fits = tests[pair] = self.compatible(before, token)
                if not fits:
                    continue
            last[end], size[end] = token, length
        at, ids = len(word), []
        while at > 0:
            if last[at] < 0:
                raise ValueError("the vocabulary does not cover a byte")
            ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def encode(self, text: str) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit integers."""
        if self.special_split is not None and any(s in text for s in self.special):
            parts = self.special_split.split(text)
            return b"".join(self.special[p].to_bytes(4, "little") if p in self.special else self._plain(p) for p in parts)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.cache.__getitem__, self.split.findall(text)))

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


class _Cache(dict):
    """Ids of pieces seen lately, in two generations: when the young one is full it becomes the old one, so memory is bounded."""

    def __init__(self, codec: BytePairCodec) -> None:
        super().__init__()
        self.codec, self.old = codec, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(self.codec.encode_piece(piece), "<u4").tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


_codecs: dict[bytes, BytePairCodec] = {}
caches["bpe"] = _codecs.clear


def codec_of(source: bytes) -> BytePairCodec:
    """The process's codec of a vocabulary, built once."""
    key = hashlib.sha256(source).digest()
    if key not in _codecs:
        _codecs[key] = BytePairCodec(source)
    return _codecs[key]


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the SHA-256 of the decoded text.

    The vocabulary file is read on the driver and sent to the workers (a fixed size). A null text counts as empty and has no
    tokens; special tokens in a text are encoded as such. Repeated rows give repeated rows, an empty table an empty one;
    other columns of docs are not read.
    """
    ship(docs.sparkSession)
    bound_batches(docs.sparkSession)
    with open(tokenizer_path, "rb") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("bpe")
        codec = codec_of(vocabulary.value)
        for batch in chunks(batches, "text"):
            ids = [codec.encode(t or "") for t in batch.column("text").to_pylist()]
            decoded = [hashlib.sha256(codec.decode(i).encode()).hexdigest() for i in ids]
            arrays = [batch.column("doc_id").cast(pa.int64()), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())]
            yield pa.record_batch(arrays, names=["doc_id", "n_tokens", "ids", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(rows, _SCHEMA)
