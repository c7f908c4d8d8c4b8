"""Packing documents into sequences of equal length, balanced by their attention cost.

A document is tokenised, cut into full sequences and a rest, and the rests are dealt in descending order: each
goes to the sequence of lowest estimated cost that still has room for it. The cost of a piece of n tokens is
linear + quadratic, n + n * n / context (attention stays inside a piece). A rest that fits nowhere is cut
along the sequences with the most room. Tokens are packed in blocks of bounded size inside the tasks that
read the documents, so nothing is shuffled and each block leaves less than one sequence of padding.

Defined results: a null text counts as empty, which is one piece with the end token alone; rows that repeat
are packed each; an empty table gives no rows; other columns are ignored; a text of any length is cut into as
many sequences as it needs.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.batches import TwoGenerations, blocks_of, map_rows, ragged
from millrace.llm.tokens import byte_letters

# How the vocabulary splits lower-case text, here for printable ASCII and the letters of Latin-1,
# which neither normal form nor case mapping changes in any other way.
PLAIN_WORD = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
SPECIAL_START = "<|"

BLOCK_TOKENS = 1 << 21  # 512 sequences of 4096
CACHED_WORDS = 300_000
CACHED_PIECES = 150_000
BLOCK_BYTES = 4 << 20
LONGEST_CACHED = 64


class WordTokenizer:
    """Token ids of whole texts from a vocabulary that never joins text across white space.

    Each word between ASCII white space is encoded by the library and remembered; the ids of a text are those
    of its words in order. Special strings hold no white space, so they stay inside one word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.letters = byte_letters()
        self.words = TwoGenerations(self._encode, CACHED_WORDS, LONGEST_CACHED)
        self.pieces = TwoGenerations(self._encode_piece, CACHED_PIECES, LONGEST_CACHED)

    def _encode(self, word: str) -> bytes:
        """Ids as little-endian 32-bit numbers. Plain words go straight to the library's merge model, piece by piece."""
        if PLAIN_WORD.fullmatch(word) and SPECIAL_START not in word:
            return b"".join([self.pieces[p] for p in PIECES.findall(word.lower())])
        encoded = self.library.encode_batch_fast([word], add_special_tokens=False)[0]
        return np.array(encoded.ids, dtype="<u4").tobytes()

    def _encode_piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        ids = [token.id for token in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Token ids of each text. Equal words of the texts are looked up once."""
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = words.values.dictionary_encode()  # a text that starts or ends with white space has empty words there
        code = coded.indices.to_numpy()
        known = [self.words[w] for w in coded.dictionary.to_pylist()]
        values = np.frombuffer(b"".join(known), "<u4")
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        sizes = size[code]
        ids = values[ragged((np.cumsum(size) - size)[code], sizes)]
        cuts = np.concatenate([[0], np.cumsum(sizes)])[words.offsets.to_numpy()]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def cost(length: int, context: int) -> float:
    """Estimated work of one piece: linear layers plus attention within the piece."""
    return length + length * length / context


def assign(lengths: Sequence[int], context: int) -> list[tuple[int, int, int, int]]:
    """Pieces (item, start, length, sequence) for items of the given token counts.

    Ties are settled by the item's position and the sequence's number, so the result depends on the input alone.
    """
    pieces, rests, sequence = [], [], 0
    for item, length in enumerate(lengths):
        for start in range(0, length - length % context, context):
            pieces.append((item, start, context, sequence))
            sequence += 1
        if length % context:
            rests.append((length % context, item, length - length % context))
    rests.sort(key=lambda r: (-r[0], r[1]))
    total = sum(r[0] for r in rests)
    open_sequences = [(0.0, sequence + i, context) for i in range(-(-total // context))]
    heapq.heapify(open_sequences)
    # Rests only get shorter, but a sequence that is passed over now may fit a later one: it waits by its room.
    waiting: dict[int, list[tuple[float, int]]] = {}
    for length, item, start in rests:
        while open_sequences and open_sequences[0][2] < length:
            had, number, room = heapq.heappop(open_sequences)
            heapq.heappush(waiting.setdefault(room, []), (had, number))
        if waiting and (fits := [r for r in waiting if r >= length]):
            # What waited has room again, as rests are shorter now.
            for room in fits:
                for had, number in waiting.pop(room):
                    heapq.heappush(open_sequences, (had, number, room))
        if open_sequences:
            while open_sequences[0][2] < length:
                had, number, room = heapq.heappop(open_sequences)
                heapq.heappush(waiting.setdefault(room, []), (had, number))
                if not open_sequences:
                    break
        if open_sequences:
            had, number, room = heapq.heappop(open_sequences)
            pieces.append((item, start, length, number))
            if room > length:
                heapq.heappush(open_sequences, (had + cost(length, context), number, room - length))
            continue
        while length:  # it fits nowhere whole
            room = max(waiting)
            had, number = heapq.heappop(waiting[room])
            if not waiting[room]:
                del waiting[room]
            part = min(room, length)
            pieces.append((item, start, part, number))
            if room > part:
                heapq.heappush(waiting.setdefault(room - part, []), (had + cost(part, context), number))
            start, length = start + part, length - part
    return pieces


def pack(df: DataFrame, vocabulary: str, context: int = 4096, end_token: int = 2, block_tokens: int = BLOCK_TOKENS,
         id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset), and its ids if asked for.

    ``sequence_id`` is the task's number and the sequence's number within the task. Sequences are filled from
    offset 0 without gaps; what is left of ``context`` is padding.
    """

    def packed(block: list[tuple], first: int, task: int) -> Iterator[tuple]:
        used: dict[int, int] = {}
        for item, start, length, number in assign([len(ids) for _, ids in block], context):
            key, ids = block[item]
            part = ids[start:start + length]
            offset = used.get(number, 0)
            used[number] = offset + length
            row = (key, start, length, zlib.crc32(part), len(ids), (task << 32) + first + number, offset)
            yield (*row, part) if with_ids else row

    def pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
        own, task, last = tokenizer(vocabulary), TaskContext.get().partitionId(), np.array([end_token], "<u4")
        block, held, first = [], 0, 0
        for texts in blocks_of(((key, text or "") for key, text in rows), lambda row: len(row[1]), BLOCK_BYTES):
            for (key, _), ids in zip(texts, own.ids([text for _, text in texts])):
                block.append((key, np.append(ids, last)))
                held += len(ids) + 1
                if held >= block_tokens:
                    yield from packed(block, first, task)
                    first += held // context + 1
                    block, held = [], 0
        yield from packed(block, first, task)

    key = df.schema[id_column].dataType.simpleString()
    schema = (f"`{id_column}` {key}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
              "offset bigint" + (", ids array<bigint>" if with_ids else ""))
    return map_rows(df, [F.col(id_column), F.col(text_column)], schema, pieces)
