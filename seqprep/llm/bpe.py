"""Byte-pair encoding by one dynamic program per word: each prefix has one possible last token."""

from __future__ import annotations

import gc
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

WORD_CACHE = 200_000  # words of a generation; a task remembers the tokens of two
PAIR_CACHE = 300_000  # pairs of tokens that a task remembers before it starts again
SLICE = 1 << 20  # characters or tokens worked on at a time

# The pattern of byte-level tokenizers, white space spelt out as Unicode's White_Space.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECE = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
)
# A blank that does not by itself begin the next word.
_ODD_BLANK = regex.compile(r" (?:\s|$)")


def byte_characters() -> dict[str, int]:
    """Printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(kept)]
    return {chr(byte): byte for byte in kept} | {chr(256 + place): byte for place, byte in enumerate(others)}


def token_bytes(state: dict) -> tuple[dict[int, bytes], dict[str, int]]:
    """Bytes of every token of a vocabulary file, and the special tokens by name."""
    as_byte = byte_characters()
    special = {token["content"]: token["id"] for token in state.get("added_tokens", [])}
    table = {}
    for name, number in (state["model"]["vocab"] | special).items():
        spelt = [as_byte.get(character) for character in name]
        table[number] = name.encode() if None in spelt else bytes(spelt)
    return table, special


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file."""

    def __init__(self, content: bytes) -> None:
        state = json.loads(content)
        model = state["model"]
        self.bytes, self.special = token_bytes(state)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token to (rank, left, right) of its merge
        for rank, (left, right) in enumerate(merges):
            pair = ids[left], ids[right]
            self.rank[pair] = rank
            self.parts[ids[left + right]] = (rank, *pair)
        self._packed = [array("i", [token]).tobytes() for token in range(max(self.bytes) + 1)]
        self._edges = lru_cache(None)(self._edge)  # two lists a token at most
        ordinary = [t for t in self.bytes if t not in set(self.special.values())]
        usable = [t for t in ordinary if self._stands(t)]
        self.automaton = ahocorasick.Automaton()
        for token in usable:
            self.automaton.add_word(self.bytes[token].decode("latin-1"), token)
        self.automaton.make_automaton()
        self.splitter = (
            regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
            if self.special
            else None
        )
        self._whole = {self.bytes[token].decode("latin-1"): token for token in usable}
        self._lengths = [len(self.bytes.get(token, b"")) for token in range(max(self.bytes) + 1)]
        self._pairs: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Pieces that stand at the token's edge while it grows, smallest first, each with the rank that ends it."""
        chain, ends = [], float("inf")
        while True:
            chain.append((token, ends))
            if token not in self.parts:
                return chain[::-1]
            ends = self.parts[token][0]
            token = self.parts[token][side]

    def _first_meeting(self, left: int, right: int) -> tuple[int, int] | None:
        """The pieces that would merge across the border of two tokens, if any do, in order of rank."""
        before, after = self._edges(left, 2), self._edges(right, 1)
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = before[i], after[j]
            across = self.rank.get((a, b), float("inf"))
            if across < a_ends and across <= b_ends:  # of equal ranks the leftmost pair merges first
                return a, b
            if a_ends == b_ends == float("inf"):
                return None
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1

    def _stands(self, token: int) -> bool:
        """Whether encoding the token's own bytes gives the token."""
        if token not in self.parts:
            return len(self.bytes[token]) == 1
        _, left, right = self.parts[token]
        return self._first_meeting(left, right) == (left, right) and self._stands(left) and self._stands(right)

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the tokens stay apart when their bytes are encoded together; remembered."""
        if left < 0:
            return False
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= PAIR_CACHE:
                self._pairs.clear()
            known = self._pairs[key] = self._first_meeting(left, right) is None
        return known

    def encode_piece(self, piece: str) -> bytes:
        """Tokens of one word, packed as 32-bit numbers.

        For every prefix, of the tokens that end there (all suffixes of the prefix that the automaton finds)
        the one is kept that can follow the last token of the prefix before it; there is exactly one, and it
        is the last token of the prefix's encoding.
        """
        text = piece if piece.isascii() else piece.encode().decode("latin-1")
        packed = self._packed
        if text in self._whole:
            return packed[self._whole[text]]
        pairs, lengths = self._pairs, self._lengths
        last = [-1] * (len(text) + 1)
        end = 0
        for end, token in self.automaton.iter(text):
            end += 1
            if last[end] < 0:
                start = end - lengths[token]
                if start:
                    known = pairs.get(last[start] << 32 | token)
                    if known is False or known is None and not self._compatible(last[start], token):
                        continue
                last[end] = token
        found, at = [], len(text)
        while at:
            token = last[at]
            if token < 0:
                raise ValueError(f"the vocabulary cannot encode {piece!r}")
            found.append(packed[token])
            at -= lengths[token]
        return b"".join(found[::-1])


class Encoder:
    """Encodes whole texts, remembering the tokens of words."""

    def __init__(self, content: bytes) -> None:
        self.vocabulary = Vocabulary(content)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        """Empty the memory of words and pairs: workers outlive their tasks."""
        self.words, self.older = {}, {}
        self.vocabulary._pairs.clear()

    def _word(self, word: str) -> bytes:
        """Tokens of a stretch of text that is not among the latest; one used lately is still among the older."""
        packed = self.older.get(word)
        if packed is None:
            letters = word[1:] if word[0] == " " else word
            pieces = [word] if letters.isalpha() else _PIECE.findall(word)
            if len(pieces) == 1:
                packed = self.vocabulary.encode_piece(word)
            else:
                words = self.words
                packed = b"".join([words[p] if p in words else self._word(p) for p in pieces])
        if len(self.words) >= WORD_CACHE:
            self.words, self.older = {}, self.words
        if len(word) <= 64:
            self.words[word] = packed
        return packed

    def _plain(self, text: str) -> bytes:
        if _ODD_BLANK.search(text):
            pieces = _PIECE.findall(text)
        else:
            first, *rest = text.split(" ")
            pieces = [first, *[" " + word for word in rest]] if first else [" " + word for word in rest]
        words = self.words
        return b"".join([words[w] if w in words else self._word(w) for w in pieces])

    def encode(self, text: str) -> bytes:
        splitter = self.vocabulary.splitter
        if splitter is None or not any(name in text for name in self.vocabulary.special):
            return self._plain(text)
        packed = []
        for place, part in enumerate(splitter.split(text)):
            if place % 2:
                packed.append(array("i", [self.vocabulary.special[part]]).tobytes())
            elif part:
                packed.append(self._plain(part))
        return b"".join(packed)


class Decoder:
    """The bytes of all tokens in a row, and where each begins."""

    def __init__(self, content: bytes) -> None:
        table, _ = token_bytes(json.loads(content))
        names = [table.get(number, b"") for number in range(max(table) + 1)]
        self.data = np.frombuffer(b"".join(names), np.uint8)
        self.lengths = np.array([*map(len, names), 0])  # the last stands for unknown tokens
        self.starts = np.cumsum(self.lengths) - self.lengths

    def decode(self, tokens: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The text of tokens[bounds[i]:bounds[i + 1]] for every i."""
        parts = [pa.array([], pa.string())]
        for begin, end in _slices(bounds):
            parts.append(self._slice(tokens[bounds[begin] : bounds[end]], bounds[begin : end + 1] - bounds[begin]))
        return pa.concat_arrays(parts)

    def _slice(self, tokens: np.ndarray, bounds: np.ndarray) -> pa.Array:
        unknown = len(self.lengths) - 1
        tokens = np.where((tokens >= 0) & (tokens < unknown), tokens, unknown)
        lengths = self.lengths[tokens]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        data = self.data[np.arange(ends[-1]) + np.repeat(self.starts[tokens] - ends[:-1], lengths)]
        limits = ends[bounds]
        buffers = [None, pa.py_buffer(limits.astype(np.int64)), pa.py_buffer(data)]
        texts = pa.Array.from_buffers(pa.large_string(), len(limits) - 1, buffers)
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:  # bytes that are not UTF-8
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(limits[:-1].tolist(), limits[1:].tolist())]
            return pa.array(texts, pa.string())
        return texts.cast(pa.string())


def _slices(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``SLICE`` members each; a longer row is a range of its own."""
    begin = 0
    while begin < len(bounds) - 1:
        end = int(np.searchsorted(bounds, bounds[begin] + SLICE, side="right")) - 1
        end = max(begin + 1, end)
        yield begin, end
        begin = end


@lru_cache(2)
def _encoder(content: bytes) -> Encoder:
    encoder = Encoder(content)
    gc.freeze()  # the tables stay; collections need not walk them
    return encoder


@lru_cache(2)
def _decoder(content: bytes) -> Decoder:
    return Decoder(content)


def read_vocabulary(path: str) -> bytes:
    """Content of a vocabulary file (a few MB), read by the driver and sent along with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def _int_lists(packed: list[bytes]) -> pa.Array:
    sizes = np.fromiter((len(p) // 4 for p in packed), dtype=np.int64, count=len(packed))
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), dtype=np.int32)))


def _encoded(encoder: Encoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts in a row, and where each text's begin."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
    parts, counts = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    for begin, end in _slices(np.concatenate(([0], np.cumsum(sizes)))):
        packed = [encoder.encode(text) if text else b"" for text in texts[begin:end].to_pylist()]
        counts.append(np.array([len(part) // 4 for part in packed], dtype=np.int64))
        parts.append(np.frombuffer(b"".join(packed), np.int32))
    return np.concatenate(parts), np.cumsum(np.concatenate(counts))


def _lists(tokens: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(tokens))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add ``ids`` (array<int>): the tokens of ``text`` by the vocabulary file at ``path``.

    As the tokenizers library encodes with add_special_tokens=False: names of special tokens found in the
    text become these tokens. With ``decoded`` a column of that name gets what the tokens decode to, in the same
    pass. Null and empty texts give an empty array (and empty text). The whole text is encoded at any length;
    columns already called like the new ones are replaced; an empty table stays empty.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    back = decoded is not None

    @F.arrow_udf("ids array<int>, decoded string")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(content.value)
        try:
            for texts in batches:
                numbers, bounds = _encoded(encoder, texts)
                plain = _decoder(content.value).decode(numbers, bounds) if back else pa.nulls(len(texts), pa.string())
                yield pa.StructArray.from_arrays([_lists(numbers, bounds), plain], names=["ids", "decoded"])
        finally:
            encoder.forget()

    found = docs.withColumn(ids, tokens(F.col(text)))
    if back:
        found = found.withColumn(decoded, F.col(f"{ids}.decoded"))
    return found.withColumn(ids, F.col(f"{ids}.ids"))


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``: the bytes of the tokens in ``ids``, special tokens included, read as UTF-8.

    Bytes that are not UTF-8 become U+FFFD; null arrays give null, null or unknown tokens add nothing.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    @F.arrow_udf(T.StringType())
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = _decoder(content.value)
        for batch in batches:
            offsets = batch.offsets.to_numpy().astype(np.int64)
            numbers = batch.values.fill_null(-1).to_numpy()[offsets[0] : offsets[-1]]
            plain = decoder.decode(numbers, offsets - offsets[0])
            yield pc.if_else(batch.is_valid(), plain, pa.scalar(None, pa.string()))

    return docs.withColumn(text, texts(F.col(ids)))
