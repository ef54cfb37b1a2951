"""Byte-level BPE encoding and decoding with a published vocabulary.

Method: for every prefix of a piece of text, BPE ends in one token; it is the only token that
ends there and stands next to the last token of the prefix before it without BPE merging
across their border. An automaton over the vocabulary gives the tokens that end at a place,
a test of the pair settles which one is right, and the chain of last tokens, followed back from
the end, is exactly what merging by rank gives. The cost grows with the length of the piece,
also for pieces that hold no white space.

The border test: merging grows tokens by rank, so the part of the left token that touches the
border is, over time, one of its right-most parts, and the part of the right token one of its
left-most parts. BPE merges across the border if such parts form a merge that comes before
both are swallowed by their own tokens; at equal rank the merge further left goes first.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municare.llm.common import map_texts

# Fixed values of the byte-level scheme: how it cuts text, and the printable bytes that stand
# for themselves in vocabulary files; the others follow from code point 256 on.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100)]
WHITE = "\t-\r \x85\xa0  -     　"
# Cuts a text where no piece can reach across: before white space, or before its last blank.
CHUNKS = rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
_REMEMBERED = 500_000  # chunks and pairs a worker remembers; a memory, not a limit of the input
_LONG = 64  # longer chunks are not remembered


def letters_of_bytes() -> list[str]:
    shown = {b for r in PRINTABLE for b in r}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def read_vocabulary(path: str) -> dict:
    """Vocabulary, merges and special tokens of a tokenizer file, as plain values to broadcast."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in content["model"]["merges"]]
    special = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
    return {"vocabulary": content["model"]["vocab"], "merges": merges, "special": special}


class _Remembered(dict):
    """What ``make`` gives for a chunk, remembered unless the chunk is long."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, chunk: str):
        made = self.make(chunk)
        if len(chunk) <= _LONG:
            self[chunk] = made
        return made


class Codec:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int]):
        self.letters = letters_of_bytes()
        self.rank = {(vocabulary[a], vocabulary[b]): i for i, (a, b) in enumerate(merges)}
        self.parts = {vocabulary[a + b]: (vocabulary[a], vocabulary[b]) for a, b in reversed(merges)}
        for i, pair in enumerate(self.rank):
            if any(self.rank[self.parts[t]] >= i for t in pair if t in self.parts):
                raise ValueError("a merge comes before the merges of its own parts")
        byte_of = {c: bytes([b]) for b, c in enumerate(self.letters)}
        self.bytes_of = {i: b"".join(byte_of[c] for c in t) for t, i in vocabulary.items() if t not in special}
        self.bytes_of |= {i: t.encode() for t, i in special.items()}
        self.special = special
        self.split = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.chunks = re.compile(CHUNKS)
        self.pieces = regex.compile(PIECES)
        self.ends = ahocorasick.Automaton()
        for token, i in vocabulary.items():
            if token not in special and (len(token) == 1 or i in self.parts):
                self.ends.add_word(token, (i, len(token)))
        self.ends.make_automaton()
        self.whole = {t: i for t, i in vocabulary.items() if t not in special and (len(t) == 1 or i in self.parts)}
        self.shown = dict(enumerate(self.letters))
        self.fits: dict[int, bool] = {}
        self.known = _Remembered(self._chunk)
        self.told = _Remembered(self._tell)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Parts of a token on its left (0) or right (1) edge, with the rank that swallows them."""
        edge, until = [(token, len(self.rank))], 0
        while token in self.parts:
            until = self.rank[self.parts[token]]
            token = self.parts[token][side]
            edge.append((token, until))
        return edge

    def stands(self, left: int, right: int) -> bool:
        """Whether BPE leaves the border between the two tokens alone."""
        rank, never = self.rank, len(self.rank)
        return not any(
            (merge := rank.get((a, b), never)) < a_until and merge <= b_until and merge < never
            for a, a_until in self._edge(left, 1)
            for b, b_until in self._edge(right, 0)
        )

    def piece(self, shown: str) -> list[int]:
        """Ids of one piece, given in the letters of the vocabulary file."""
        if shown in self.whole:
            return [self.whole[shown]]
        fits = self.fits
        if len(fits) > _REMEMBERED:
            fits.clear()
        last: list[int] = []
        length: list[int] = []
        done = 0
        for end, (token, size) in self.ends.iter(shown):  # the longest token of an end first
            if end < done:
                continue
            if end >= size:
                pair = last[end - size] << 32 | token
                if pair not in fits:
                    fits[pair] = self.stands(last[end - size], token)
                if not fits[pair]:
                    continue
            last.append(token)
            length.append(size)
            done += 1
        out, at = [], len(shown) - 1
        while at >= 0:
            out.append(last[at])
            at -= length[at]
        return out[::-1]

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        shown = chunk.encode().decode("latin-1").translate(self.shown)
        word = chunk[1:] if chunk[0] == " " else chunk
        if word.isascii() and word.isalpha():
            return tuple(self.piece(shown))
        out, at = [], 0
        for piece in self.pieces.findall(chunk):
            size = len(piece.encode())
            out += self.piece(shown[at : at + size])
            at += size
        return tuple(out)

    def _tell(self, chunk: str) -> tuple[int, bytes, bytes]:
        """Number of ids, the ids in decimal joined by commas, and the bytes they decode to."""
        ids = self._chunk(chunk)
        return len(ids), ",".join([str(i) for i in ids]).encode(), b"".join([self.bytes_of[i] for i in ids])

    def _plain(self, text: str) -> list[int]:
        if len(self.known) > _REMEMBERED:
            self.known.clear()
        return list(chain.from_iterable(map(self.known.__getitem__, self.chunks.findall(text))))

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and digests of the ids and of the text they decode to. What is joined is
        remembered per chunk of text, so no id of a known chunk is touched again."""
        if self.split and self.split.search(text):
            ids = self.encode(text)
            count, listed, raw = len(ids), ",".join([str(i) for i in ids]).encode(), self.decode(ids).encode()
        else:
            if len(self.told) > _REMEMBERED:
                self.told.clear()
            found = list(map(self.told.__getitem__, self.chunks.findall(text)))
            count = sum([f[0] for f in found])
            listed, raw = b",".join([f[1] for f in found]), b"".join([f[2] for f in found])
            try:
                raw.decode()
            except UnicodeDecodeError:  # decoding shows such bytes as the replacement character
                raw = raw.decode("utf-8", "replace").encode()
        return count, hashlib.sha256(listed).hexdigest(), hashlib.sha256(raw).hexdigest()

    def encode(self, text: str) -> list[int]:
        """Ids of a text; strings of special tokens in it give their ids."""
        if not self.split or not self.split.search(text):
            return self._plain(text)
        out, at = [], 0
        for match in self.split.finditer(text):
            out += self._plain(text[at : match.start()])
            out.append(self.special[match[0]])
            at = match.end()
        return out + self._plain(text[at:])

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 show as the replacement character. Ids that
        the vocabulary lacks give nothing."""
        return b"".join([self.bytes_of.get(i, b"") for i in ids]).decode("utf-8", "replace")


def shared_codec(state: dict) -> Codec:
    """The codec of a broadcast vocabulary, built once per worker and kept in the value."""
    if "codec" not in state:
        state["codec"] = Codec(state["vocabulary"], state["merges"], state["special"])
    return state["codec"]


def encode(documents: DataFrame, vocabulary: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``token_ids`` (array of int) of every whole text; null is empty.

    ``vocabulary`` is the path of the tokenizer file on the driver. Other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def each(texts):
        codec = shared_codec(shared.value)
        return {"token_ids": pa.array([codec.encode((t or b"").decode()) for t in texts], pa.list_(pa.int32()))}

    return map_texts(documents, keep, text, each, "token_ids array<int>")


def decode(tokens: DataFrame, vocabulary: str, out: str = "text") -> DataFrame:
    """Adds the text of ``token_ids``; null ids give an empty text."""
    shared = tokens.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    @F.arrow_udf("string")
    def texts(ids: pa.Array) -> pa.Array:
        codec = shared_codec(shared.value)
        return pa.array([codec.decode(x or []) for x in ids.to_pylist()], pa.string())

    return tokens.withColumn(out, texts("token_ids"))


def digests(documents: DataFrame, vocabulary: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256 and decoded_sha256: every whole text is encoded,
    its ids decoded again, and both digested in the same task, so no ids are shipped."""
    shared = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def each(texts):
        codec = shared_codec(shared.value)
        told = [codec.digest((text or b"").decode()) for text in texts]
        counts, of_ids, of_text = zip(*told) if told else ([], [], [])
        return {
            "n_tokens": pa.array(counts, pa.int64()),
            "ids_sha256": pa.array(of_ids, pa.string()),
            "decoded_sha256": pa.array(of_text, pa.string()),
        }

    return map_texts(documents, keep, text, each, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
