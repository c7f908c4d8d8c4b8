"""Benchmark decontamination by Wu-Manber search for many word patterns.

A pattern is a window of 13 consecutive words of a benchmark item, or the whole item if it has fewer. Patterns
of one length share a searcher: a shift table over blocks of two words says how far the search may move on, a
bucket per final block lists the patterns that can end there, and direct comparison confirms an occurrence.
Most positions of a clean document are never looked at.

The benchmark comes in blocks of bounded text size; each is turned into tables once per task and all documents
are searched for it before the next block is taken, so a large benchmark costs scans, not memory.

Defined results: a null or wordless text has no words, no hits and is not contaminated; a benchmark item without
words occurs nowhere; items that repeat an id count once; documents that repeat give a row each; empty tables
give no hits or no rows; other columns are kept by ``mark`` (its own are named by the caller's prefix).
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.batches import map_rows, utf8
from millrace.plans.durable import staged

WINDOW = 13
BLOCK_BYTES = 4 << 20  # of benchmark text held by a task at a time

# Lower-cases A-Z and turns every other byte of the contract's separators into a blank.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a text after lower-casing A-Z."""
    return text.translate(_FOLD).split() if text else []


class Searcher:
    """Wu-Manber over word sequences of one length."""

    def __init__(self, patterns: dict[tuple, set]):
        self.patterns = patterns
        self.length = len(next(iter(patterns)))
        self.block = min(2, self.length)
        self.furthest = self.length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(list)
        for pattern in patterns:
            for end in range(self.block, self.length + 1):
                key = self._key(pattern, end)
                self.shift[key] = min(self.shift.get(key, self.furthest), self.length - end)
            self.buckets[self._key(pattern, self.length)].append(pattern)
        # Within a bucket the first word tells most patterns apart.
        self.by_first = {key: _grouped(found) for key, found in self.buckets.items()}

    def _key(self, text: Sequence[bytes], end: int):
        return text[end - 1] if self.block == 1 else (text[end - 2], text[end - 1])

    def occurrences(self, text: list[bytes]) -> Iterator[tuple[int, set]]:
        """(start, items) of every window of ``text`` that is a pattern."""
        end, size, furthest = self.length, len(text), self.furthest
        shift, key, length, by_first = self.shift.get, self._key, self.length, self.by_first
        while end <= size:
            here = key(text, end)
            step = shift(here, furthest)
            if step:
                end += step
                continue
            start = end - length
            for pattern in by_first[here].get(text[start], ()):
                if tuple(text[start:end]) == pattern:
                    yield start, self.patterns[pattern]
                    break
            end += 1


def _grouped(patterns: list[tuple]) -> dict[bytes, list[tuple]]:
    found: dict[bytes, list[tuple]] = defaultdict(list)
    for pattern in patterns:
        found[pattern[0]].append(pattern)
    return found


def searchers(items: Sequence[tuple], window: int) -> list[Searcher]:
    """One searcher per pattern length for (item, text) rows."""
    by_length: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        found = words(text)
        size = min(window, len(found))
        for start in range(len(found) - size + 1 if size else 0):
            by_length[size][tuple(found[start:start + size])].add(item)
    return [Searcher(patterns) for patterns in by_length.values()]


def search(own: Sequence[Searcher], text: list[bytes]) -> tuple[list[tuple[int, int]], set]:
    """Hit stretches of words as (start, end), merged and in order, and the items that occur."""
    hits, items = [], set()
    for searcher in own:
        for start, found in searcher.occurrences(text):
            hits.append((start, start + searcher.length))
            items |= found
    return merged(hits), items


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(stretches):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def benchmark_blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """(item, text) rows in blocks of about ``limit`` bytes. One block is on the driver at a time."""
    held, size = [], 0
    for row in benchmark.toLocalIterator():
        text = bytes(row[1]) if row[1] is not None else b""
        held.append((row[0], text))
        size += len(text) + 64
        if size >= limit:
            yield held
            held, size = [], 0
    yield held


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_column: str = "text",
         item_column: str = "item_id", item_text: str = "text", keep: Sequence[str] | None = None,
         prefix: str = "", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Columns ``keep`` (default all) of ``docs`` with n_words, hits (array of start, end in words) and items."""
    kept = list(docs.columns if keep is None else keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema.fields)
    own = [f"{prefix}{n}" for n in ("n_words", "hits", "items")]
    if clash := set(own) & set(kept):
        raise ValueError(f"columns {sorted(clash)} are there already; give a prefix")
    shape = f"`{own[0]}` bigint, `{own[1]}` array<struct<start:bigint,end:bigint>>, `{own[2]}` array<string>"
    context = docs.sparkSession.sparkContext
    result, first = docs, True
    blocks = benchmark_blocks(benchmark.select(F.col(item_column).cast("string"), utf8(item_text)), block_bytes)
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        sent = context.broadcast(block)
        earlier: list[Column] = [] if first else [F.col(own[1]), F.col(own[2])]

        def rows(texts: Iterator[tuple], sent=sent, first=first) -> Iterator[tuple]:
            tables = searchers(sent.value, window)
            for row in texts:
                found = words(row[0])
                hits, items = search(tables, found)
                if not first:
                    hits, items = merged(hits + [(h["start"], h["end"]) for h in row[1]]), items | set(row[2])
                rest = row[1:] if first else row[3:]
                yield *rest, len(found), [{"start": a, "end": b} for a, b in hits], sorted(items)

        more = [] if following is None or text_column in kept else [text_column]
        if following is None:
            wanted, schema = kept, fields
        else:  # the text is needed again
            wanted = kept + more
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*wanted).schema.fields)
        result = map_rows(result, [utf8(text_column), *earlier, *[F.col(c) for c in wanted]], f"{schema}, {shape}", rows, spread=first)
        if following is not None:
            result = staged(result, "decontaminate")
        block, first = following, False
    return result


def hit_words(hits: str = "hits") -> Column:
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda total, h: total + h["end"] - h["start"])


def contaminated(n_words: str = "n_words", hits: str = "hits") -> Column:
    """At least one word in twenty lies inside an occurrence of a window."""
    return (hit_words(hits) > 0) & (20 * hit_words(hits) >= F.col(n_words))


def digest(items: str = "items") -> Column:
    """Of the item ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()
