"""Exact token counts at every prefix of a text, by dynamic programming over byte-level BPE.

The last token of each prefix is stored. A token t that ends at position i is the last token of that prefix
exactly if the pair (last token of the prefix before t, t) is left alone by the merges; then
count[i] = count[i - len(t)] + 1. One pass gives the counts of all prefixes, and truncation and budget
questions are answered from them without encoding again. Splitting by the vocabulary's pattern is done first;
prefixes that cut a run of white space, a contraction or a special string are counted as the library would
count that prefix.

Defined results: a null text counts as empty (no prefix but the empty one, 0 tokens); rows that repeat, with
any id, give a row each; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from millrace.llm.batches import TwoGenerations, blocks_of, map_rows

# The pattern that splits text before the merges, its contractions, and white space in Unicode.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ASCII_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"""
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

CACHED_UNITS = 500_000
CACHED_PIECES = 200_000
CACHED_PAIRS = 400_000
CACHED_HEADS = 200_000
HEADS = (8, 5)
LONGEST_CACHED = 64
BLOCK_CHARS = 1 << 20


def byte_letters() -> list[str]:
    """The letter of each byte in a byte-level vocabulary: printable ones stand for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class PrefixCounter:
    """Token counts at every prefix for the byte-level BPE file at ``path``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        self.letters = byte_letters()
        number = {letter: i for i, letter in enumerate(self.letters)}
        self.left, self.right = list(range(256)), list(range(256))
        self.joined: dict[int, int] = {}
        for merge in data["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            token = number.setdefault(left + right, len(number))
            self.joined[number[left] << 32 | number[right]] = token
            if token == len(self.left):
                self.left.append(number[left])
                self.right.append(number[right])
        # Every end of a token, with the token's number where the end is itself a token. A byte is the character of its
        # number here, so that plain text needs no translation.
        plain = str.maketrans({letter: chr(b) for b, letter in enumerate(self.letters)})
        number = {token.translate(plain): i for token, i in number.items()}
        self.ends = {token[i:]: -1 for token in number for i in range(len(token))} | number
        special = [t["content"] for t in data["added_tokens"]]
        self.special = regex.compile("|".join(regex.escape(s) for s in special)) if special else None
        self.pattern = regex.compile(PATTERN)
        self.printable = re.compile("[ -~]+")
        self.ascii_pattern = re.compile(ASCII_PATTERN)
        self.unit = re.compile(f"[{SPACE}]*+[^{SPACE}]++|[{SPACE}]++")
        self.word = re.compile(r"( ?[A-Za-z]+)([!-&(-/:;=>?@\[-`{}~]*)")
        self.leading = re.compile(f"[{SPACE}]*+")
        self.heads: dict[str, tuple[array, array]] = {}
        self.stays = TwoGenerations(self._stays, CACHED_PAIRS)
        self.pieces = TwoGenerations(self._piece_counts, CACHED_PIECES, LONGEST_CACHED)
        self.units = TwoGenerations(self._unit_counts, CACHED_UNITS, LONGEST_CACHED)

    def _stays(self, pair: int) -> bool:
        """Whether the merges leave two neighbouring tokens (numbered in order of their merges) as they are.

        The halves that face each other are taken apart, the later merge first. The pair is broken if two facing
        parts would have been joined before the merge that swallowed one of them.
        """
        a, b, before = pair >> 32, pair & 0xFFFFFFFF, len(self.left)
        while True:
            joined = self.joined.get(a << 32 | b)
            if joined is not None and joined < before:
                return False
            if a < 256 and b < 256:
                return True
            if a > b:
                before, a = a, self.right[a]
            else:
                before, b = b + 1, self.left[b]

    def _byte_counts(self, piece: str) -> list[int]:
        """Counts at every byte prefix of one piece of the pattern, each byte a character.

        The table of a prefix does not depend on what follows, so pieces with the same head share its rows.
        """
        ends, stays, heads = self.ends, self.stays, self.heads
        last, count = [-1], [0]
        for size in HEADS:
            if len(piece) > size and (known := heads.get(piece[:size])):
                last, count = known[0].tolist(), known[1].tolist()
                break
        end = len(last) - 1
        while end < len(piece):
            if end in HEADS and len(heads) < CACHED_HEADS:
                heads[piece[:end]] = (array("i", last), array("I", count))
            start, end = end, end + 1
            token = ends[piece[start:end]]
            while start and (token < 0 or not stays[last[start] << 32 | token]):
                start -= 1
                token = ends[piece[start:end]]
            last.append(token)
            count.append(count[start] + 1)
        return count

    def _piece_counts(self, piece: str) -> array:
        """Counts at the code point prefixes 1, 2, ... of one piece. Arrays, as the collector need not look into them."""
        if piece.isascii():
            return array("I", self._byte_counts(piece)[1:])
        raw = piece.encode()
        count = self._byte_counts(raw.decode("latin-1"))
        return array("I", [count[i] for i in range(1, len(raw) + 1) if i == len(raw) or raw[i] & 0xC0 != 0x80])

    def _plain_counts(self, text: str) -> list[int]:
        """Counts for white space followed by other characters, without special strings."""
        if not text:
            return []
        found, base = [], 0
        pattern = self.ascii_pattern if self.printable.fullmatch(text) else self.pattern
        for piece in pattern.findall(text):
            counts = self.pieces[piece]
            found.extend([base + c for c in counts] if base else counts)
            if piece in LONG_CONTRACTIONS:  # cut short, the quote and the letter are two pieces
                found[-2] = found[-3] + 1
            base = found[-1]
        space = self.leading.match(text).end()
        if 1 < space < len(text):  # a prefix that ends in white space keeps it in one piece
            found[:space] = self.pieces[text[:space]]
        return found

    def _unit_counts(self, unit: str) -> array:
        if word := self.word.fullmatch(unit):  # one or two pieces, none of them white space or a special string
            counts = self.pieces[word[1]]
            if not word[2]:
                return counts
            base = counts[-1]
            return counts + array("I", [base + c for c in self.pieces[word[2]]])
        if self.special is None or not self.special.search(unit):
            return array("I", self._plain_counts(unit))
        found, base, at = [], 0, 0
        for match in [*self.special.finditer(unit), None]:
            end = match.end() if match else len(unit)
            counts = [base + c for c in self._plain_counts(unit[at:end])]
            if match:
                inside = match.start() - at
                counts[-1] = (counts[inside - 1] if inside else base) + 1
                if inside and unit[at:match.start()].isspace() and inside > 1:
                    counts[-1] = base + self.pieces[unit[at:match.start()]][-1] + 1
                base = counts[-1]
            found.extend(counts)
            at = end
        return array("I", found)

    def two_levels(self, texts: Sequence[str]) -> TwoLevels:
        """Counts at every prefix of the texts: inside each distinct unit, and before each unit of a text.

        Equal units of the texts are looked up once.
        """
        parts = [self.unit.findall(t) for t in texts]
        coded = pa.array(chain.from_iterable(parts), pa.large_string()).dictionary_encode()
        code = coded.indices.to_numpy()
        known = [self.units[u] for u in coded.dictionary.to_pylist()]
        total = np.fromiter((k[-1] for k in known), np.int64, len(known))[code]
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
        sums = np.concatenate([[0], np.cumsum(total)])
        return TwoLevels(known, code, bounds, sums)

    def counts(self, texts: Sequence[str]) -> list[np.ndarray]:
        """For each text, counts[i] is the number of tokens of text[:i]; counts[0] is 0."""
        levels = self.two_levels(texts)
        return [levels.flat(i) for i in range(len(texts))]


@dataclass
class TwoLevels:
    """The counts of some texts at every prefix, without an entry per character.

    ``known`` holds the counts at the prefixes of each distinct unit, ``code`` the units of all texts one after the
    other, ``bounds`` where each text's units begin, ``sums`` the tokens before each unit since the first text.
    """

    known: list[array]
    code: np.ndarray
    bounds: np.ndarray
    sums: np.ndarray

    def total(self, text: int) -> int:
        return int(self.sums[self.bounds[text + 1]] - self.sums[self.bounds[text]])

    def flat(self, text: int) -> np.ndarray:
        """counts[i] is the number of tokens of the text's first i code points."""
        first, last = self.bounds[text], self.bounds[text + 1]
        parts = [self.known[c] for c in self.code[first:last]]
        before = np.repeat(self.sums[first:last] - self.sums[first], np.fromiter(map(len, parts), np.int64, len(parts)))
        return np.concatenate([[0], np.concatenate(parts) + before]) if parts else np.zeros(1, np.int64)

    def longest_within(self, text: int, budget: int) -> int:
        """Code points of the longest prefix with at most ``budget`` tokens.

        Counts may fall when a prefix grows inside a unit, but not from unit to unit: the last unit that holds such a
        prefix is found from the sums and each unit's least count, the prefix itself in that unit's counts.
        """
        first, last = self.bounds[text], self.bounds[text + 1]
        before = self.sums[first:last] - self.sums[first]
        # No prefix of a unit has fewer tokens than one, so units that begin at the budget hold none.
        for at in range(int(np.searchsorted(before, budget, "left")) - 1, -1, -1):
            fitting = np.flatnonzero(np.asarray(self.known[self.code[first + at]]) <= budget - before[at])
            if len(fitting):
                return sum(len(self.known[c]) for c in self.code[first:first + at]) + int(fitting[-1]) + 1
        return 0


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """One counter per Python worker, with what it has learned so far."""
    return PrefixCounter(path)


def _counted(rows: Iterator[tuple], vocabulary: str) -> Iterator[tuple]:
    """(key, bytes, code points, counts of a block in two levels, number of the text in it)."""
    own = counter(vocabulary)
    for block in blocks_of(((key, text or "") for key, text in rows), lambda row: len(row[1]), BLOCK_CHARS):
        levels = own.two_levels([text for _, text in block])
        for at, (key, text) in enumerate(block):
            yield key, len(text.encode()), len(text), levels, at


def prefix_counts(df: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, counts): counts[i] is the token count of the first i code points, counts[0] = 0."""
    key = df.schema[id_column].dataType.simpleString()
    return map_rows(df, [F.col(id_column), F.col(text_column)],
                    f"`{id_column}` {key}, n_bytes bigint, counts array<int>",
                    lambda rows: ((k, n, levels.flat(at)) for k, n, _, levels, at in _counted(rows, vocabulary)), spread=True)


def token_budget(df: DataFrame, vocabulary: str, budget: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, chars_within_limit), read off the counts of every prefix.

    ``chars_within_limit`` is where to truncate: the longest prefix that has at most ``budget`` tokens.
    """

    def rows(texts: Iterator[tuple]) -> Iterator[tuple]:
        for key, n_bytes, length, levels, at in _counted(texts, vocabulary):
            total = levels.total(at)
            yield key, n_bytes, total, total > budget, length if total <= budget else levels.longest_within(at, max(budget, 0))

    key = df.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {key}, n_bytes bigint, n_tokens bigint, over_limit boolean, chars_within_limit bigint"
    return map_rows(df, [F.col(id_column), F.col(text_column)], schema, rows, spread=True)
