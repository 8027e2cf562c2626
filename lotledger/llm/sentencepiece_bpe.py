"""Exact SentencePiece BPE encoding by backtracking, and decoding.

A segmentation is the one that merging would give exactly if every two adjacent tokens are
compatible: merging their joined text again gives the same two tokens. The encoder takes the
longest vocabulary match at a position (Aho-Corasick finds the matches), steps back to shorter
matches where two neighbours are not compatible, and marks positions from which no way leads
on in a bitfield, so that each is tried once.

No piece of such a vocabulary spans a space that follows other text, nor a character that
occurs in no longer piece, so a text falls into short segments that are encoded apart. Both
facts are read from the vocabulary when it is loaded. Frequent segments are remembered in a
table of bounded size.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from lotledger.llm.common import python_tasks

SPACE = "▁"  # fixed value: how the models write a space
CACHE_ENTRIES = 600_000

# Kinds of pieces in a model file, fixed values.
NORMAL, CONTROL, USER_DEFINED, BYTE = 1, 3, 4, 6


class Vocabulary:
    """Pieces, merge order and segment pattern of a BPE model with byte fallback."""

    def __init__(self, model: bytes):
        spec = model_pb2.ModelProto()
        spec.ParseFromString(model)
        kinds = {p.type for p in spec.pieces}
        norm, trainer = spec.normalizer_spec, spec.trainer_spec
        if trainer.model_type != model_pb2.TrainerSpec.BPE or USER_DEFINED in kinds or not trainer.byte_fallback:
            raise ValueError("needs a BPE model with byte fallback and without user-defined pieces")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("needs a model that leaves texts as they are")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.end_id = trainer.eos_id
        self.scores, self.ids, self.surface, byte_ids = {}, {}, [b""] * len(spec.pieces), {}
        for i, piece in enumerate(spec.pieces):
            if piece.type == BYTE:
                byte_ids[int(piece.piece[1:-1], 16)] = i
                self.surface[i] = bytes([int(piece.piece[1:-1], 16)])
            elif piece.type == NORMAL:
                self.ids[piece.piece], self.scores[piece.piece] = i, piece.score
                self.surface[i] = piece.piece.replace(SPACE, " ").encode()
        self.byte_ids = byte_ids
        longer = [p for p in self.ids if len(p) > 1]
        inner = {c for p in longer for c in p} - {SPACE}
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            raise ValueError("a piece spans a space after other text")
        members = "".join(map(re.escape, sorted(inner)))
        self.segments = re.compile(f"{SPACE}+[{members}]*|[{members}]+|[^{members}{SPACE}]")
        # Single characters are always tokens; those without a piece end as bytes.
        tokens = sorted({*self.ids, *inner, SPACE})
        self.number = {token: i for i, token in enumerate(tokens)}
        self.matcher = ahocorasick.Automaton()
        for token, i in self.number.items():
            self.matcher.add_word(token, (i, len(token)))
        self.matcher.make_automaton()
        self.packed = [array("i", self.token_ids(token)).tobytes() for token in tokens]
        self.tokens, self.reachable = tokens, bytearray(len(tokens))  # 0 unknown, 1 yes, 2 no

    def merged(self, text: str) -> list[str]:
        """The tokens that merging gives: the best pair first, the leftmost of equals."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str, str]] = []

        def offer(i: int, j: int) -> None:
            if (score := self.scores.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-score, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= len(parts) or parts[j] != right:
                continue
            parts[i], parts[j], after[i] = left + right, None, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p is not None]

    def is_reachable(self, i: int) -> bool:
        """Whether merging the token's own text gives it; no text is encoded with others."""
        if not self.reachable[i]:
            self.reachable[i] = 1 if self.merged(self.tokens[i]) == [self.tokens[i]] else 2
        return self.reachable[i] == 1

    def token_ids(self, token: str) -> list[int]:
        known = self.ids.get(token)
        return [known] if known is not None else [self.byte_ids[b] for b in token.encode("utf-8", "replace")]


class Encoder(dict):
    """Segment to its ids as packed 32-bit integers, worked out when first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.pairs = vocabulary, {}

    def compatible(self, left: int, right: int) -> bool:
        if (known := self.pairs.get(left << 32 | right)) is None:
            texts = [self.vocabulary.tokens[left], self.vocabulary.tokens[right]]
            known = self.pairs[left << 32 | right] = self.vocabulary.merged("".join(texts)) == texts
        return known

    def tokens(self, segment: str) -> list[int]:
        """Numbers of the segment's tokens."""
        vocabulary, n = self.vocabulary, len(segment)
        matches: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for last, (token, length) in vocabulary.matcher.iter(segment):
            if vocabulary.reachable[token] == 1 or vocabulary.is_reachable(token):
                matches[last - length + 1].append((last + 1, token))  # longer ones later
        known, compatible = self.pairs.get, self.compatible
        open_at, chosen = bytearray(b"\1") * (n + 1), []  # chosen: (start, place among the matches, token)
        at, place, before = 0, len(matches[0]) - 1, -1
        while at < n:
            while place >= 0:
                end, token = matches[at][place]
                if open_at[end] and (
                    before < 0 or (fits := known(before << 32 | token)) or (fits is None and compatible(before, token))
                ):
                    break
                place -= 1
            if place >= 0:
                chosen.append((at, place, token))
                at, place, before = end, len(matches[end]) - 1 if end < n else -1, token
            else:
                open_at[at] = 0
                if not chosen:
                    raise ValueError(f"no segmentation of {segment!r}")
                at, place, _ = chosen.pop()
                before = chosen[-1][2] if chosen else -1
                place -= 1
        return [token for _, _, token in chosen]

    def __missing__(self, segment: str) -> bytes:
        vocabulary = self.vocabulary
        if len(segment) == 1:
            packed = array("i", vocabulary.token_ids(segment)).tobytes()
        else:
            packed = b"".join([vocabulary.packed[i] for i in self.tokens(segment)])
        self[segment] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a whole text with the end id; a missing or empty text has that id alone."""
        end = array("i", [self.vocabulary.end_id]).tobytes()
        if not text:
            return end
        marked = self.vocabulary.prefix + text.replace(" ", SPACE)
        return b"".join(map(self.__getitem__, self.vocabulary.segments.findall(marked))) + end

    def decode(self, ids) -> str:
        """Text of ids: control pieces vanish, bytes join, the added space goes."""
        whole = b"".join(map(self.vocabulary.surface.__getitem__, ids))
        return whole.removeprefix(b" " if self.vocabulary.prefix else b"").decode("utf-8", "replace")

    def trim(self) -> None:
        for cache in (self, self.pairs):
            if len(cache) > CACHE_ENTRIES:
                cache.clear()


_ENCODERS: dict[bytes, Encoder] = {}  # one per model in a worker process, kept from task to task


def encoder_of(model: bytes) -> Encoder:
    key = hashlib.sha256(model).digest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Vocabulary(model))
    return _ENCODERS[key]


def encode_decode(
    df: DataFrame, model_file: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``df`` without its text, with the ids of each text and the text decoded from them.

    Null and empty texts get the end id alone and decode to an empty text. Other columns stay
    as they are; columns named like the results are replaced. The model file is read on the
    driver and sent to the tasks, its size being that of a vocabulary.
    """
    python_tasks(df.sparkSession)
    with open(model_file, "rb") as file:
        model = df.sparkSession.sparkContext.broadcast(file.read())
    rest = [f for f in df.schema.fields if f.name not in (text, ids, decoded)]
    names, string = [f.name for f in rest], T.StringType()
    schema = T.StructType(rest).add(ids, T.ArrayType(T.IntegerType())).add(decoded, string)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model.value)
        for batch in batches:
            packed = [encoder.encode(value) for value in batch.column(text).to_pylist()]
            lengths = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
            flat = np.frombuffer(b"".join(packed), np.int32)
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            texts = [encoder.decode(flat[a:b].tolist()) for a, b in zip(bounds, bounds[1:], strict=False)]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), lists, pa.array(texts, pa.string())], names=[*names, ids, decoded]
            )
            encoder.trim()

    return df.withColumn(text, df[text].cast(string)).select(*names, text).mapInArrow(run, schema)


def library_ids(model_file: str, texts: list[str]) -> list[list[int]]:
    """What the library gives, for tests and comparisons."""
    return sentencepiece.SentencePieceProcessor(model_file=model_file).encode(texts, add_eos=True, num_threads=1)
