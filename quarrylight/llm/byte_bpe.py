"""Byte-level BPE encoding by backtracking, and decoding.

A text is cut by the vocabulary's pattern, and each match is encoded separately. The bytes of a match are read as Latin-1, so that
an Aho-Corasick automaton over strings finds the tokens at every byte. No merges run over the text: the longest token is taken whose end
isn't marked as failed and which is compatible with the token before it, that is, merging the bytes of the two anew gives just
these two; where none fits, the place is marked as failed and the token before it gives way to its next shorter one. A sequence
whose neighbours are all compatible is the one that merging gives. A place is marked at most once, so the work is linear in the match,
and compatibility is remembered by pair. A match that is a token itself is that token.

The rank file is read once on the driver and broadcast: its size is the vocabulary's, whatever the corpus. A Python
worker remembers a bounded number of matches and pairs; those over ``LONGEST`` characters are encoded anew. Nothing is shuffled.

Cases: a null or empty text has no ids and decodes to no bytes. Strings of special tokens are ordinary text. Very long matches take memory
in proportion to their length. Repeated rows give equal results, and an empty table an empty one. Other columns pass through. A
vocabulary that lacks one of the 256 bytes is an error, and so is an id outside the vocabulary; decoding to text puts U+FFFD for bytes that form no character.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, documents
from .pieces import _id_lists, _mapped
from .token_counts import read_ranks

MATCHES_KEPT, PAIRS_KEPT, LONGEST = 600_000, 400_000, 64  # what a Python worker remembers at most, and how long a match it remembers: about 150 MB
SHORT = 48  # bytes up to which a plain search for the least rank beats a heap
NONE = 1 << 62


def class_of(name: str) -> str:
    """The characters of the basic plane that a class of the pattern language holds, as ranges."""
    plane = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    return "".join(f"{re.escape(r[0])}-{re.escape(r[-1])}" for r in regex.findall(f"{name}+", plane))


def plain_pattern(pattern: str) -> str:
    """The pattern for the standard library, which is faster but has no classes of characters by property: they are spelled out."""
    out, inside = [], False
    for token in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S):
        inside = token == "[" or (inside and token != "]")
        if token.startswith("\\p") or token == "\\s":
            out.append(class_of(token) if inside else f"[{class_of(token)}]")
        elif token == "\\S" and not inside:
            out.append(f"[^{class_of(r'\s')}]")
        elif re.fullmatch(r"\\[a-zA-Z]", token):
            raise ValueError(f"{token} has no spelled-out form")
        else:
            out.append(token)
    return "".join(out)


class ByteCodec:
    def __init__(self, ranks: dict[bytes, int], pattern: str, plain: str | None = None):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks a byte")
        self.ranks = {token.decode("latin-1"): i for token, i in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.base = max(ranks.values()) + 1
        self.names, self.sizes, self.shorter = [""] * self.base, [0] * self.base, [-1] * self.base
        self.found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for t, i in self.ranks.items():
            self.names[i], self.sizes[i] = t, len(t)
            # the longest token that a token begins with, apart from itself; -1: none
            self.shorter[i] = next((self.ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ranks), -1)
            self.found.add_word(t, i)
        self.found.make_automaton()
        self.compatible = Remembered(self.remerges, PAIRS_KEPT)
        self.stands = Remembered(lambda i: self.merged(self.names[i]) == [i], len(ranks))
        self.matches = Remembered(lambda match: array("i", self.encode_match(match)).tobytes(), MATCHES_KEPT, LONGEST)
        # texts of the basic plane only are cut by the spelled-out pattern
        self.plain = self.pieces if plain is None else re.compile(plain).findall
        self.beyond = re.compile("[\U00010000-\U0010ffff]").search

    def merged(self, match: str) -> list[int]:
        """The tokens by merging itself: least rank first, the leftmost of equals. Serves pairs, and matches that backtracking can't divide."""
        if len(match) <= SHORT:
            return self.merged_short(match)
        parts: list[str | None] = [*match]
        after, before, rank = [*range(1, len(parts) + 1)], [*range(-1, len(parts) - 1)], self.ranks.get
        heap = [(r, i, x + y) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if (r := rank(x + y, NONE)) < NONE]
        heapq.heapify(heap)
        while heap:
            _, i, token = heapq.heappop(heap)
            if parts[i] is None or (j := after[i]) >= len(parts) or parts[i] + parts[j] != token:
                continue
            parts[i], parts[j] = token, None
            after[i] = k = after[j]
            if k < len(parts):
                before[k] = i
                if (r := rank(token + parts[k], NONE)) < NONE:
                    heapq.heappush(heap, (r, i, token + parts[k]))
            if (h := before[i]) >= 0 and (r := rank(parts[h] + token, NONE)) < NONE:
                heapq.heappush(heap, (r, h, parts[h] + token))
        return [self.ranks[x] for x in parts if x is not None]

    def merged_short(self, match: str) -> list[int]:
        parts, rank = [*match], self.ranks.get
        costs = [rank(x + y, NONE) for x, y in zip(parts, parts[1:], strict=False)]
        while costs and (least := min(costs)) < NONE:
            i = costs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i < len(costs):
                costs[i] = rank(parts[i] + parts[i + 1], NONE)
            if i:
                costs[i - 1] = rank(parts[i - 1] + parts[i], NONE)
        return [self.ranks[x] for x in parts]

    def remerges(self, pair: int) -> bool:
        """Whether merging the bytes of two adjacent tokens anew gives just these two."""
        a, b = divmod(pair, self.base)
        return self.merged(self.names[a] + self.names[b]) == [a, b]

    def divided(self, match: str) -> list[int] | None:
        """The tokens of a match by backtracking; None where no division has compatible neighbours only."""
        size, sizes, shorter, compatible, base = len(match), self.sizes, self.shorter, self.compatible, self.base
        longest, failed = [-1] * size, bytearray(size + 1)
        for end, i in self.found.iter(match):
            longest[end + 1 - sizes[i]] = i  # of the tokens at a place the longest ends last
        tokens: list[int] = []
        at, token, last = 0, longest[0], -1
        while True:
            end = at + sizes[token]
            if not failed[end] and (compatible[last * base + token] if last >= 0 else self.stands[token]):
                tokens.append(token)
                if end == size:
                    return tokens
                at, last, token = end, token, longest[end]
                continue
            token = shorter[token]
            while token < 0:
                if not tokens:
                    return None
                failed[at] = 1
                gone = tokens.pop()
                at -= sizes[gone]
                token, last = shorter[gone], tokens[-1] if tokens else -1

    def encode_match(self, match: str) -> list[int]:
        raw = match if match.isascii() else match.encode().decode("latin-1")
        if (whole := self.ranks.get(raw)) is not None:
            return [whole]
        found = self.divided(raw)
        return self.merged(raw) if found is None else found

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        self.matches.trim()
        self.compatible.trim()
        cut = self.pieces if self.beyond(text) else self.plain
        return np.frombuffer(b"".join(map(self.matches.__getitem__, cut(text))), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


_codecs: dict[str, ByteCodec] = {}


def _codec(shared) -> ByteCodec:
    ranks, pattern, plain, key = shared.value
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = ByteCodec(ranks, pattern, plain)
    return _codecs[key]


def _shared(df: DataFrame, ranks_file: str, pattern: str):
    ranks = read_ranks(ranks_file)
    try:
        plain = plain_pattern(pattern)
    except ValueError:
        plain = None
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    return df.sparkSession.sparkContext.broadcast((ranks, pattern, plain, key))


def encode_bytes(df: DataFrame, ranks_file: str, pattern: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None, keep_text: bool = True) -> DataFrame:
    """df with ids_col array<int>, the ids that merging by rank gives for each match of the pattern in text_col.

    With decoded_col also the bytes that the ids decode to, from the same pass; without keep_text the text itself
    doesn't come back from the Python workers.
    """
    made = {ids_col: "array<int>"} | ({decoded_col: "binary"} if decoded_col else {})
    shared, at = _shared(df, ranks_file, pattern), [c for c in df.columns if c not in made].index(text_col)

    def fill(batch):
        codec = _codec(shared)
        ids = [codec.encode(x.as_py()) for x in batch.column(at)]
        return [_id_lists(ids), *([pa.array([codec.decode(x) for x in ids], pa.binary())] if decoded_col else [])]

    return _mapped(df, made, fill, "" if keep_text else text_col)


def decode_bytes(df: DataFrame, ranks_file: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded", text_col: str | None = None) -> DataFrame:
    """df with bytes_col, the bytes of ids_col (null ids: none), and with text_col also the text they form."""
    made = {bytes_col: "binary"} | ({text_col: "string"} if text_col else {})
    shared, at = _shared(df, ranks_file, pattern), [c for c in df.columns if c not in made].index(ids_col)

    def fill(batch):
        codec = _codec(shared)
        column = batch.column(at)
        flat, ends, valid = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy(), column.is_valid().to_pylist()
        raw = [codec.decode(flat[ends[i] : ends[i + 1]]) if ok else b"" for i, ok in enumerate(valid)]
        return [pa.array(raw, pa.binary()), *([pa.array([x.decode(errors="replace") for x in raw], pa.string())] if text_col else [])]

    return _mapped(df, made, fill)


def token_digests(docs: DataFrame, ranks_file: str, pattern: str, text_col: str = "text") -> DataFrame:
    """docs with n_tokens, ids_sha256 and decoded_sha256 in place of the text."""
    coded = encode_bytes(docs, ranks_file, pattern, text_col, "ids", "decoded", keep_text=False)
    ids = F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256)
    return coded.withColumns({"n_tokens": F.size("ids").cast("long"), "ids_sha256": ids, "decoded_sha256": F.sha2("decoded", 256)}).drop("ids", "decoded")


def op12_byte_bpe(spark, sf_dir):
    import public_tokenizers

    return token_digests(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES = {"op12_byte_bpe": op12_byte_bpe}
ORACLES = {}
