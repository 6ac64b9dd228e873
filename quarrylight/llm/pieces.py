"""SentencePiece merge-type (BPE) encoding by backtracking, and decoding.

The vocabulary is read once on the driver and broadcast (its size is that of the model file, whatever the corpus).
Encoding never runs merges over a text. The text is cut where no piece can reach across: before a run of the
blank mark that follows another character, around newlines, and at characters outside the vocabulary, which
become byte pieces. Each distinct part is then encoded by backtracking: an Aho-Corasick automaton finds the pieces
at every position; the longest is taken whose end isn't marked as failed and which is compatible with the piece
before it, that is, merging the two pieces' characters anew gives just these two; if none fits, the position is
marked in the field of failed positions and the last piece gives way to its next shorter one. Each mark is set once,
so the work is linear. A part without such a division (runs of blanks whose merges tie) is merged directly.

Cases: a null or empty text has no ids and decodes to the empty text; very long parts take memory in proportion to
their length; repeated rows give equal results; an empty table gives an empty one. Other columns pass through.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, documents

MARK = "▁"
PART = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
PARTS_KEPT, PAIRS_KEPT, PART_CHARS = 150_000, 300_000, 64  # what a Python worker remembers at most, and how long a part it remembers: about 100 MB
SHORT = 48  # characters up to which a plain search for the best merge beats a heap


def read_vocabulary(model_file: str) -> list[tuple[str, float, str]]:
    """(piece, score, kind) by id; kind is one of normal, byte, control, unknown."""
    p = sentencepiece.SentencePieceProcessor(model_file=model_file)
    kinds = lambda i: "byte" if p.is_byte(i) else "control" if p.is_control(i) else "unknown" if p.is_unknown(i) else "normal"
    return [(p.id_to_piece(i), p.get_score(i), kinds(i)) for i in range(p.vocab_size())]


class Codec:
    def __init__(self, vocabulary: list[tuple[str, float, str]]):
        self.ids = {p: i for i, (p, _, kind) in enumerate(vocabulary) if kind == "normal"}
        self.scores = {p: s for p, s, kind in vocabulary if kind == "normal"}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(vocabulary) if kind == "byte"}
        self.unknown = next((i for i, x in enumerate(vocabulary) if x[2] == "unknown"), 0)
        surface = {"byte": lambda p: bytes([int(p[3:5], 16)]), "control": lambda p: b"", "unknown": lambda p: " ⁇ ".encode(), "normal": lambda p: p.replace(MARK, " ").encode()}
        self.surface = [surface[kind](p) for p, _, kind in vocabulary]
        self.is_byte = np.array([kind == "byte" for *_, kind in vocabulary])
        self.is_normal = np.array([kind == "normal" for *_, kind in vocabulary])
        self.controls = {i for i, x in enumerate(vocabulary) if x[2] == "control"}
        self.names, self.size = [p for p, *_ in vocabulary], [len(p) for p, *_ in vocabulary]
        self.found = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.found.add_word(p, (i, len(p) - 1))
        self.found.make_automaton()
        # the longest piece that a piece begins with, apart from itself; -1: none
        self.shorter = [-1] * len(vocabulary)
        for p, i in self.ids.items():
            self.shorter[i] = next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.ids), -1)
        self.alphabet = {p for p in self.ids if len(p) == 1}
        # a pair is one number, which takes less memory than a tuple
        self.compatible = Remembered(self.remerges, PAIRS_KEPT)
        self.stands = Remembered(lambda i: self.merged(self.names[i]) == [self.names[i]], len(vocabulary))
        self.parts = Remembered(lambda part: array("i", self.encode_part(part)).tobytes(), PARTS_KEPT, PART_CHARS)

    def merged(self, text: str) -> list[str]:
        """The pieces by merging itself: best score first, the leftmost of equals. Serves pairs and ties."""
        if len(text) <= SHORT:
            return self.merged_short(text)
        part: list[str | None] = [*text]
        after, before, scores = [*range(1, len(part) + 1)], [*range(-1, len(part) - 1)], self.scores
        heap = [(-scores[x + y], i, x + y) for i, (x, y) in enumerate(zip(part, part[1:], strict=False)) if x + y in scores]
        heapq.heapify(heap)
        while heap:
            _, i, piece = heapq.heappop(heap)
            j = after[i] if part[i] is not None else len(part)
            if j >= len(part) or part[i] + part[j] != piece:
                continue
            part[i], part[j] = piece, None
            after[i] = k = after[j]
            if k < len(part):
                before[k] = i
                if (made := piece + part[k]) in scores:
                    heapq.heappush(heap, (-scores[made], i, made))
            if (h := before[i]) >= 0 and (made := part[h] + piece) in scores:
                heapq.heappush(heap, (-scores[made], h, made))
        return [x for x in part if x is not None]

    def merged_short(self, text: str) -> list[str]:
        part, score, none = [*text], self.scores.get, -math.inf
        scores = [score(x + y, none) for x, y in zip(part, part[1:], strict=False)]
        while scores and (best := max(scores)) > none:
            i = scores.index(best)
            part[i : i + 2] = [part[i] + part[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = score(part[i] + part[i + 1], none)
            if i:
                scores[i - 1] = score(part[i - 1] + part[i], none)
        return part

    def remerges(self, pair: int) -> bool:
        """Whether merging the characters of two adjacent pieces anew gives just these two."""
        a, b = map(self.names.__getitem__, divmod(pair, len(self.names)))
        return self.merged(a + b) == [a, b]

    def divided(self, part: str) -> list[int] | None:
        """The ids of a part whose characters are all in the vocabulary, by backtracking."""
        end_of, lengths, n = len(part), self.size, len(self.names)
        longest, failed = [-1] * end_of, bytearray(end_of + 1)
        for end, (i, before) in self.found.iter(part):
            longest[end - before] = i
        compatible, shorter = self.compatible, self.shorter
        pieces: list[int] = []
        pos, last, piece = 0, -1, longest[0]
        while True:
            end = pos + lengths[piece]
            if not failed[end] and (compatible[last * n + piece] if last >= 0 else self.stands[piece]):
                pieces.append(piece)
                if end == end_of:
                    return pieces
                pos, last, piece = end, piece, longest[end]
                continue
            piece = shorter[piece]
            while piece < 0:
                if not pieces:
                    return None
                failed[pos] = 1
                gone = pieces.pop()
                pos -= lengths[gone]
                last, piece = pieces[-1] if pieces else -1, shorter[gone]

    def encode_known(self, part: str) -> list[int]:
        found = self.divided(part)
        return [self.ids[p] for p in self.merged(part)] if found is None else found

    def encode_part(self, part: str) -> list[int]:
        if self.alphabet.issuperset(part):
            return self.encode_known(part)
        start = 0
        out: list[int] = []
        for i in [*(i for i, c in enumerate(part) if c not in self.alphabet), len(part)]:
            if i > start:
                out += self.encode_known(part[start:i])
            if i < len(part):
                out += [self.byte_ids.get(b, self.unknown) for b in part[i].encode()] if self.byte_ids else [self.unknown]
            start = i + 1
        return out

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        self.parts.trim()
        self.compatible.trim()
        marked = MARK + text.replace(" ", MARK)
        return np.frombuffer(b"".join(map(self.parts.__getitem__, PART.findall(marked))), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        out = b"".join(map(self.surface.__getitem__, ids.tolist()))
        first = next((i for i in ids.tolist() if i not in self.controls), self.unknown)
        lead = bool(self.is_normal[first]) and out[:1] == b" "  # the blank that encoding put in front
        try:
            if not self.controls.intersection(ids.tolist()):  # which part the bytes around them
                return out[lead:].decode()
        except UnicodeDecodeError:
            pass
        text, kept = "", []
        for i in [*ids.tolist(), None]:
            if i is not None and self.is_byte[i]:
                kept.append(self.surface[i])
                continue
            text += _text_of(b"".join(kept))
            kept = []
            text += self.surface[i].decode() if i is not None else ""
        return text[lead:]


def _text_of(raw: bytes) -> str:
    """Bytes that form no character become U+FFFD one by one."""
    text = ""
    while raw:
        for n in (1, 2, 3, 4):
            try:
                text += raw[:n].decode()
                break
            except UnicodeDecodeError:
                continue
        else:
            text, n = text + "�", 1
        raw = raw[n:]
    return text


_codecs: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    key = hash(tuple(shared.value))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(shared.value)
    return _codecs[key]


def _mapped(df: DataFrame, made: dict[str, str], fill, without: str = "") -> DataFrame:
    """df with more columns (name to type), which fill makes from a slice of a record batch; one column may stay behind."""
    fields = [f for f in df.schema.fields if f.name not in made]
    df = df.select(*[F.col(f"`{f.name}`") for f in fields])
    back = [i for i, f in enumerate(fields) if f.name != without]
    names = [*(fields[j].name for j in back), *made]

    def work(batches):
        for whole in batches:
            for i in range(0, max(1, whole.num_rows), 512):
                batch = whole.slice(i, 512)
                yield pa.RecordBatch.from_arrays([*(batch.column(j) for j in back), *fill(batch)], names)

    return df.mapInArrow(work, ", ".join([*(f"`{fields[j].name}` {fields[j].dataType.simpleString()}" for j in back), *(f"`{k}` {v}" for k, v in made.items())]))


def _id_lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) for x in ids], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))


def encode_pieces(df: DataFrame, model_file: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None, keep_text: bool = True) -> DataFrame:
    """df with ids_col array<int>, exactly the ids that the library gives for text_col, without begin or end ids.

    With decoded_col also the text that the ids decode to, from the same pass; without keep_text the text itself
    doesn't come back from the Python workers.
    """
    made = {ids_col: "array<int>"} | ({decoded_col: "string"} if decoded_col else {})
    shared, at = df.sparkSession.sparkContext.broadcast(read_vocabulary(model_file)), [c for c in df.columns if c not in made].index(text_col)

    def fill(batch):
        codec = _codec(shared)
        ids = [codec.encode(x.as_py()) for x in batch.column(at)]
        return [_id_lists(ids), *([pa.array([codec.decode(x) for x in ids], pa.string())] if decoded_col else [])]

    return _mapped(df, made, fill, "" if keep_text else text_col)


def decode_pieces(df: DataFrame, model_file: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """df with text_col, the text of ids_col (null ids: the empty text)."""
    shared, at = df.sparkSession.sparkContext.broadcast(read_vocabulary(model_file)), [c for c in df.columns if c != text_col].index(ids_col)

    def fill(batch):
        codec = _codec(shared)
        column = batch.column(at)
        flat, ends, valid = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy(), column.is_valid().to_pylist()
        return [pa.array([codec.decode(flat[ends[i] : ends[i + 1]]) if ok else "" for i, ok in enumerate(valid)], pa.string())]

    return _mapped(df, {text_col: "string"}, fill)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def piece_digests(docs: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """docs with n_tokens, ids_sha256 and decoded_sha256 in place of the text."""
    # one pass for both: a second Python worker per task would double what the vocabulary and caches take
    coded = encode_pieces(docs, model_file, text_col, "ids", "decoded", keep_text=False)
    ids = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)
    return coded.withColumns({"n_tokens": F.size("ids").cast("long"), "ids_sha256": ids, "decoded_sha256": F.sha2("decoded", 256)}).drop("ids", "decoded")


def op2_sentencepiece(spark, sf_dir):
    return piece_digests(documents(spark, sf_dir).select("doc_id", "text"), model_path())


QUERIES = {"op2_sentencepiece": op2_sentencepiece}
ORACLES = {}
