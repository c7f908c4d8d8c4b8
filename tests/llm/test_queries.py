"""The registered queries against brute force, over whole tables."""

import hashlib
import re
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.compare import difference, normal_rows, sql_rows
from millrace.llm.queries import QUERIES, SQL
from millrace.llm.sql import SHARD_LIMIT
from millrace.sources.tables import table

from tests.llm import brute


@pytest.fixture(scope="module")
def docs(spark, small):
    return [tuple(r) for r in table(spark, small, "documents").select("doc_id", "text").collect()]


def result(spark, small, number):
    name = next(n for n in QUERIES if n.startswith(f"op{number}_"))
    return QUERIES[name](spark, small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, small, name):
    df = QUERIES[name](spark, small)
    assert difference(normal_rows(df.columns, df.collect()), sql_rows(small, SQL[name])) is None


def test_token_counts(spark, small, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = {r.doc_id: r for r in result(spark, small, 1).collect()}
    assert len(rows) == len(docs)
    for key, text in docs:
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (rows[key].n_bytes, rows[key].n_tokens, rows[key].over_limit) == (len(text.encode()), n, n > 1024)
        cut = rows[key].chars_within_limit
        assert len(library.encode(text[:cut], add_special_tokens=False).ids) <= 1024
        assert cut == len(text) or len(library.encode(text[:cut + 1], add_special_tokens=False).ids) > 1024


def test_toxicity_of_labelled_documents(spark, small):
    rows = {r.doc_id: r for r in result(spark, small, 2).collect()}
    assert len(rows) == table(spark, small, "documents").count()
    labels = [(rows[r.doc_id].toxic, r.toxic) for r in table(spark, small, "labels").collect()]
    assert sum(bool(a) == bool(b) for a, b in labels) >= 0.9 * len(labels)


def test_sharding(spark, small, docs):
    rows = {r.doc_id: (r.shard, r.local_depth, r.shard_bytes) for r in result(spark, small, 3).collect()}
    assert rows == brute.shards([(k, len(t.encode())) for k, t in docs], SHARD_LIMIT)
    assert len({shard for shard, _, _ in rows.values()}) > 1


def test_near_duplicates(spark, small, docs):
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in result(spark, small, 4).collect()}
    assert rows == brute.near_duplicates(docs, 4, 80)


def test_contamination(spark, small, docs):
    items = [tuple(r) for r in table(spark, small, "benchmark").select("item_id", "text").collect()]
    rows = {r.doc_id: tuple(r)[1:] for r in result(spark, small, 5).collect()}
    assert rows == brute.contamination(docs, items)
    assert any(r[-1] for r in rows.values())


def test_personal_data(spark, small, docs):
    rows = {r.doc_id: r for r in result(spark, small, 6).collect()}
    for key, text in docs:
        found = brute.personal(text)
        r = rows[key]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in found) for kind in ("email", "ip", "card", "phone")]
        written = [":".join(map(str, f)) for f in found]
        assert r.base_sha256 == brute.digest(",".join(written))
        assert set(written) <= set(r.spans.split(","))


def test_quality(spark, small, docs):
    rows = {r.doc_id: r for r in result(spark, small, 7).collect()}
    for key, text in docs:
        assert tuple(rows[key])[1:7] == brute.quality(text)
        assert not (rows[key].base_failed and rows[key].kept)


def test_chat(spark, small):
    turns = defaultdict(list)
    for r in table(spark, small, "conversations").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    said = "</s>[INST] ok [/INST]"
    turns[-7] = [(0, "user", said), (1, "assistant", said)]
    rows = {r.conv_id: r for r in result(spark, small, 8).collect()}
    assert rows.keys() == turns.keys()
    for key, own in turns.items():
        own.sort()
        loss = "".join(t for _, role, t in own if role == "assistant")
        r = rows[key]
        assert (r.n_turns, r.turns_sha256) == (len(own), brute.digest("".join(f"{role}\n{t}\n" for _, role, t in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), brute.digest(loss))


def check_pieces(rows, docs):
    """All ids of each document lie in pieces once; sequences are filled without gaps."""
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == {k for k, _ in docs}
    for key, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            part = ids[at:at + r.length]
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
            at += r.length
        assert at == len(ids)
    used = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
        used += at
    return 1 - used / (4096 * len(sequences))


def test_packing(spark, small, docs):
    assert check_pieces(result(spark, small, 9).collect(), docs) < 0.1


def test_html(spark, small):
    import html

    rows = {r.page_id: r for r in result(spark, small, 10).collect()}
    pages = table(spark, small, "pages").collect()
    assert len(rows) == len(pages)
    for page in pages:
        article = re.search("<article>(.*?)</article>", page.html, re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", article)]
        text = " ".join(b for b in blocks if b)
        assert (rows[page.page_id].text, rows[page.page_id].n_chars) == (text, len(text))


def test_pipeline(spark, small, docs):
    """Every stage against brute force on what its predecessor kept."""
    kept = [r for r in table(spark, small, "documents").collect()]
    verdict = {r.doc_id: r.kept for r in result(spark, small, 7).collect()}
    kept = [(r.doc_id, r.text) for r in kept if verdict[r.doc_id]]
    classes = brute.near_duplicates(kept, 5, 80)
    kept = [(k, t) for k, t in kept if classes[k][1] == k]
    items = [tuple(r) for r in table(spark, small, "benchmark").select("item_id", "text").collect()]
    dirty = brute.contamination(kept, items)
    kept = [(k, t) for k, t in kept if not dirty[k][-1]]
    from millrace.llm import pii

    kept = [(k, pii.masked(t, pii.spans(t))) for k, t in kept]
    assert not any(brute.personal(t) for _, t in kept)
    assert 0 < len(kept) < len(docs)
    check_pieces(corpus_pipeline.run(spark, small).collect(), kept)
