"""Operator 2: SentencePiece encoding and decoding for merge-type vocabularies.

A chunk of text starts as single characters.  An agenda holds every adjacent pair whose concatenation is a piece, ordered
by the piece's score and then from the left; the best pair is merged, its new neighbours join the agenda, and pairs made
stale by a merge are skipped.  Characters without a piece fall back to their bytes.

No piece holds a space mark behind another character, and none holds a line break, so a text falls apart at those places
and each distinct chunk is segmented once per worker.  All chunks a batch meets for the first time are checked, many to
a call, against the sentencepiece library; a difference raises an error.  Ids become text again by the library's decode(ids).
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
#: Chunks a worker remembers; beyond it the memory starts anew, which costs time and changes nothing.
MEMORY = 400_000
#: Symbols of a chunk whose agenda is a list.
SHORT = 40
NEVER = 1 << 60
#: Chunks that the library gets together; it holds a multiple of their bytes.
CHECKED = 4000
#: Texts of one output batch, in characters.
BATCH_CHARS = 1_000_000


class PieceAgenda:
    """Pieces and scores of a merge-type model, and the agenda that segments a chunk."""

    def __init__(self, model_path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.ids, self.scores, self.byte_ids = {}, {}, {}
        lib = self.library
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.ids[piece] = i
                self.scores[piece] = lib.get_score(i)
        places = {score: k for k, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        self.ranks = {piece: places[score] for piece, score in self.scores.items()}
        if any(re.search(f"[^{SPACE}]{SPACE}|.\n|\n.", p, re.S) for p in self.ids):
            raise ValueError("the model has pieces that cross a word's start; chunks would not be independent")
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte fallback")

    def merged(self, chunk: str) -> list[str]:
        """The symbols left when no adjacent pair is a piece.

        A pair's key is its rank by score; equal ranks go from the left.  A short chunk keeps its agenda as a list beside
        the symbols, a long one as a heap over linked symbols; both take the same pairs in the same order.
        """
        symbols, rank = list(chunk), self.ranks.get
        n = len(symbols)
        if n <= SHORT:
            agenda = [rank(symbols[a] + symbols[a + 1], NEVER) for a in range(n - 1)]
            while agenda and (best := min(agenda)) != NEVER:
                a = agenda.index(best)
                symbols[a] += symbols.pop(a + 1)
                del agenda[a]
                if a:
                    agenda[a - 1] = rank(symbols[a - 1] + symbols[a], NEVER)
                if a < len(agenda):
                    agenda[a] = rank(symbols[a] + symbols[a + 1], NEVER)
            return symbols
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, a) for a in range(n - 1) if (r := rank(symbols[a] + symbols[a + 1], NEVER)) != NEVER]
        heapq.heapify(heap)
        while heap:
            r, a = heapq.heappop(heap)
            b = right[a]
            if not symbols[a] or b >= n or rank(symbols[a] + symbols[b]) != r:
                continue  # stale
            symbols[a] += symbols[b]
            symbols[b] = ""
            right[a] = c = right[b]
            if c < n:
                left[c] = a
            for x, y in ((a, c), (left[a], a)):
                if x >= 0 and y < n and (r := rank(symbols[x] + symbols[y], NEVER)) != NEVER:
                    heapq.heappush(heap, (r, x))
        return [s for s in symbols if s]

    def segment(self, chunk: str) -> list[int]:
        """Ids of one chunk, in which spaces are already marks."""
        out: list[int] = []
        for s in self.merged(chunk):
            known = self.ids.get(s)
            if known is not None:
                out.append(known)
            else:
                out.extend(self.byte_ids[x] for x in s.encode())
        return out


class _Memory(dict):
    """Packed ids by chunk; an unseen chunk is segmented and noted for the next check."""

    def __init__(self, agenda: PieceAgenda, mark: str):
        super().__init__()
        self.agenda, self.mark, self.fresh = agenda, mark, []

    def __missing__(self, chunk: str) -> bytes:
        packed = np.array(self.agenda.segment(self.mark + chunk), np.int32).tobytes()
        self.fresh.append(chunk)
        self[chunk] = packed
        return packed


class PieceCodec:
    """Encodes whole texts, remembering chunks, and decodes ids."""

    def __init__(self, model_path: str, memory: int = MEMORY):
        self.agenda = PieceAgenda(model_path)
        self.spaced, self.bare = _Memory(self.agenda, SPACE), _Memory(self.agenda, "")
        self.limit = memory
        self.line_break = np.array(self.agenda.segment("\n"), np.int32).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text, without begin or end ids; none for a null or empty text."""
        if not text:
            return np.zeros(0, np.int32)
        out: list[bytes] = []
        spaced, bare = self.spaced, self.bare
        for k, line in enumerate(text.replace(SPACE, " ").split("\n")):
            if k:
                out.append(self.line_break)
            words = (line if k else " " + line).split(" ")
            if words[0]:
                out.append(bare[words[0]])
            if "" in words[1:]:  # runs of spaces belong to the word behind them
                for gap, word in re.findall("( +)([^ ]*)", line if k else " " + line):
                    out.append(spaced[gap[1:].replace(" ", SPACE) + word])
            else:
                out.extend(map(spaced.__getitem__, words[1:]))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return self.agenda.library.decode(ids.tolist())

    def check(self) -> None:
        """Compares the chunks met since the last check with the library, then bounds the memory."""
        library = self.agenda.library
        for memory, separator, prefix in ((self.spaced, " ", []), (self.bare, "\n", library.encode("\n"))):
            for odd in [c for c in memory.fresh if c.endswith(SPACE)]:  # spaces at the end of a line
                memory.fresh.remove(odd)
                if self.agenda.segment(SPACE + odd) != library.encode(odd.replace(SPACE, " ")):
                    raise ValueError("segmentation differs from the sentencepiece library")
            memory.fresh = [c for c in memory.fresh if c]
            for k in range(0, len(memory.fresh), CHECKED):
                fresh = memory.fresh[k : k + CHECKED]
                ours = [np.frombuffer(memory[c], np.int32) for c in fresh]
                if memory is self.bare:
                    ours = [x for y in ours for x in (np.frombuffer(self.line_break, np.int32), y)]
                    ours[0] = np.array(prefix, np.int32)
                texts = separator.join(c.replace(SPACE, " ") for c in fresh)
                theirs = library.encode("\n" + texts if memory is self.bare else texts)
                if np.concatenate(ours).tolist() != theirs:
                    raise ValueError("segmentation differs from the sentencepiece library")
            memory.fresh.clear()
            if len(memory) > self.limit:
                memory.clear()


@lru_cache(maxsize=2)
def codec(model_path: str) -> PieceCodec:
    """One codec per worker process and model."""
    return PieceCodec(model_path)


def _parts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= BATCH_CHARS:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def encode_texts(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the ids of every whole text and the text they decode to, replacing columns of those names.

    Null and empty texts give no ids and an empty decoded text; repeated rows stay; an empty table gives an empty one;
    very long texts are segmented whole, chunk by chunk.
    """
    out = docs.drop(ids, decoded)
    schema = T.StructType([*out.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text)).to_pylist()
            for first, last in _parts(column):
                coded = [c.encode(t) for t in column[first:last]]
                c.check()
                ends = np.cumsum([0, *map(len, coded)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(coded) if coded else np.zeros(0, np.int32)))
                part = batch.slice(first, last - first)
                arrays = [*part.columns, lists, pa.array(list(map(c.decode, coded)), pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, ids, decoded])

    return out.mapInArrow(run, schema)


def piece_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document the number of ids and the digests of ids and decoded text."""
    return encode_texts(docs.select("doc_id", "text"), model_path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
