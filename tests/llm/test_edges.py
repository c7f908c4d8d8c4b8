"""Nulls, empty and long texts, repeats, empty tables, clashing names, limits and hot groups on small tables."""

import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import chat, decontaminate, html_text, near_dup, packing, pii, quality, sharding, tokens, toxicity
from tests.llm import brute

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_words string"
LONG = "lorem ipsum " * 20_000
ROWS = [(1, None, "en", None, "x"), (2, "", None, "a", None), (2, "", None, "a", None), (None, "a b c", "en", "a", "y"), (3, LONG, "en", "a", None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_token_counts(odd, none):
    rows = sorted(((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in tokens.token_budget(odd, BYTES, 10).collect()))
    assert rows[:4] == [(0, 5, 3), (1, 0, 0), (2, 0, 0), (2, 0, 0)] and rows[4][1] == len(LONG)
    assert tokens.token_budget(none, BYTES, 10).count() == 0
    assert tokens.prefix_counts(odd.where("doc_id is null"), BYTES).first().counts == [0, 1, 2, 2, 3, 3]


def test_every_prefix_counts_as_the_library_says():
    library, own = Tokenizer.from_file(BYTES), tokens.PrefixCounter(BYTES)
    texts = ["a  b\n\n c<|endoftext|>d  <|endoftext|> don't we're  they'll 'r 're　x\x1cq 日本語テキスト é́ 😀👩‍👩‍👧 \t\n  ", "   ", "'re'ves", "123456 $$$ !!'ll", ""]
    for text, counts in zip(texts, own.counts(texts)):
        assert list(counts) == [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]


def test_toxicity(spark, odd, none):
    docs = spark.createDataFrame([(i, f"word{i % 7} idiot" if i % 3 == 0 else f"word{i % 7} fine") for i in range(300)], "doc_id bigint, text string")
    labels = docs.select("doc_id", F.when(F.col("doc_id") != 5, (F.col("doc_id") % 3 == 0).cast("int")).alias("toxic"), F.lit(0).alias("rude"))
    links = toxicity.fit_chain(docs, labels, ["rude", "toxic"])
    rows = toxicity.score(docs, links, ["rude", "toxic"]).collect()
    assert all((r.p_toxic > 0.5) == (r.doc_id % 3 == 0) and r.p_rude == 0.0 for r in rows)
    assert toxicity.score(odd, links, ["rude", "toxic"]).count() == 5
    unfitted = toxicity.fit_chain(none, labels.limit(0), ["rude", "toxic"])
    assert {r.p_toxic for r in toxicity.score(odd, unfitted, ["rude", "toxic"]).collect()} == {0.0}


def test_sharding(spark, odd, none):
    draw = random.Random(4)
    rows = [(i, "x" * draw.randrange(40)) for i in range(400)]
    got = {r.doc_id: (r.shard, r.local_depth, r.shard_bytes) for r in sharding.assign(spark.createDataFrame(rows, "doc_id bigint, text string"), 90).collect()}
    assert got == brute.shards([(k, len(t)) for k, t in rows], 90)
    same = spark.createDataFrame([(7, "x" * n) for n in [10] * 30 + [60, 95, 300]], "doc_id bigint, text string")
    pages = sharding.assign(same, 100)
    assert {r.shard_bytes for r in pages.where(~F.col("fits")).collect()} == {300}
    assert pages.groupBy("shard").agg(F.sum("n_bytes").alias("n"), F.max("shard_bytes").alias("m")).where("n <> m").isEmpty()
    assert sharding.assign(odd).count() == 5 and sharding.assign(none).count() == 0


def test_near_duplicates(spark, odd, none):
    rows = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.components(odd).collect()}
    assert {r for r in rows if r[0] != 3} == {(1, 0, 1, True), (2, 0, 2, True), (None, 1, None, True)}
    assert near_dup.components(none).count() == 0 and near_dup.deduplicate(none).count() == 0
    assert near_dup.deduplicate(odd).count() == 4


def test_near_duplicates_of_a_hot_group(spark):
    """A chain, copies, and many variants of one text, some too far from all others."""
    draw = random.Random(11)
    base = [f"w{draw.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(260):
        own = list(base)
        for _ in range(draw.randrange(9)):
            own[draw.randrange(len(own))] = f"e{draw.randrange(10_000)}"
        rows.append((i, " ".join(own)))
    rows += [(300 + i, " ".join(base)) for i in range(80)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.components(spark.createDataFrame(rows, "doc_id bigint, text string"), width=4).collect()}
    assert got == brute.near_duplicates(rows, 4, 80)


def test_decontamination_in_blocks(spark, odd, none):
    draw = random.Random(3)
    word = lambda: f"w{draw.randrange(60)}"
    items = [(i, " ".join(word() for _ in range(draw.choice([1, 3, 13, 20])))) for i in range(8)] + [(8, None), (9, "...")]
    docs = [(i, " ".join([word() for _ in range(30)] + items[i % 8][1].split() + ["tail"])) for i in range(30)] + [(98, None), (99, "")]
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    for size in (1 << 20, 200):
        marked = decontaminate.mark(d, b, keep=["doc_id"], block_bytes=size)
        rows = marked.select("doc_id", "n_words", decontaminate.hit_words(), F.size("items"), decontaminate.digest(), decontaminate.contaminated()).collect()
        assert {r[0]: tuple(r)[1:] for r in rows} == brute.contamination(docs, [i for i in items if i[1]])
    with pytest.raises(ValueError):
        decontaminate.mark(odd, b)
    assert decontaminate.mark(none, b, prefix="_").count() == 0
    assert decontaminate.mark(odd, b.limit(0), prefix="_").where("size(_hits) > 0").isEmpty()


def test_personal_data(odd, none):
    text = "a@b.com@c.org x.y@z 1.2.3.4.5 ip 300.1.1.1 card 4111 1111 1111 1111 +1 (650) 253-0000 +12 GB82 WEST 1234 5698 7654 32 ssn 123-45-6789 " + "9" * 5000
    found = pii.spans(text)
    assert [s[:3] for s in found if s[0] in pii.BASE] == brute.personal(text)
    assert {s[0] for s in found} >= {"email", "ip", "card", "phone", "iban", "national_id"}
    assert not brute.personal(pii.masked(text, found))
    assert pii.mask(odd).where("text is null").first().masked is None and pii.mask(odd).count() == 5
    assert pii.find_spans(none, ["doc_id"]).count() == 0


def test_quality(spark, odd, none):
    plain = odd.drop("n_words")
    rows = quality.judge(quality.measure(plain)).select("doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert len(rows) == 5
    assert all(tuple(r)[2:] == brute.quality(r.text) for r in rows)
    assert quality.judge(quality.measure(none.drop("n_words"))).count() == 0
    with pytest.raises(ValueError):
        quality.measure(odd)
    texts = ["a b c a b c a b", "x\n\nx\n x\nx ", "# $% <a|b> & *", "a a a a", " ", "one"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r.text: tuple(r)[1:6] for r in quality.measure(df).select("text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()} == {t: brute.quality(t)[:5] for t in texts}


def test_sketch_buckets(spark):
    df = spark.range(0, 5000).select("id", quality.bucket(F.col("id")).alias("b"))
    assert df.where("b > id or (id < 64 and b <> id) or 32 * (id - b) > id").isEmpty()


def test_chat_parts_and_escapes(spark):
    signs = f"{chat.SIGN}n<|im_end|>\n</s>[INST]{chat.SIGN}{chat.SIGN}<|image|>"
    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    turns = [(1, 0, "user\nx", [part("text", signs), part("image", ref="i", w=56, h=29), None, part("audio", ref="a", s=1.5)]),
             (1, 1, "assistant", [part("text", signs)]), (1, 1, "assistant", [part("text", signs)]), (1, None, None, None),
             (None, 0, "user", [part("other", ref="o")])]
    df = spark.createDataFrame(turns, f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}")
    rows = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert [(a.kind, a.ref, a.tokens) for a in rows[1].attachments] == [("image", "i", 4), ("audio", "a", 38)]
    assert all(rows[1].formatted[a["at"]:].startswith(chat.PLACEHOLDERS[a["kind"]]) for a in rows[1].attachments)
    read = chat.read_turns(rows[1].formatted)
    assert read == [("", ""), ("user\nx", signs + "<|image|><|audio|>"), ("assistant", signs), ("assistant", signs)]
    assert [chat.unescaped(rows[1].formatted[s.start:s.end]) for s in rows[1].loss_spans] == [signs, signs]
    assert rows[None].expanded_tokens == 0
    assert chat.format_chats(df.limit(0)).count() == 0


def test_packing(spark, odd, none):
    rows = packing.pack(odd, WORDS, context=64, block_tokens=512).collect()
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in used.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r.length for r in rows if r.doc_id == 3) == next(r.doc_tokens for r in rows if r.doc_id == 3)
    assert sorted(r.doc_tokens for r in rows if r.doc_id in (1, 2)) == [1, 1, 1]
    assert packing.pack(none, WORDS).count() == 0


def test_words_are_encoded_as_the_library_says():
    library, own = Tokenizer.from_file(WORDS), packing.WordTokenizer(WORDS)
    texts = ["don't WE'RE 12a İH̱ ẖ", "<|STARTOFTEXT|>a<|startoftext|>b ͅ", "Å ÷ª×ÿŸ ¿qué?", " \t\n", "", "日本語 é́x\x1cy"]
    assert [list(i) for i in own.ids(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_assignment_balances_and_fills():
    draw = random.Random(1)
    lengths = [draw.randrange(1, 300) for _ in range(200)] + [1000, 64, 128]
    pieces = packing.assign(lengths, 64)
    used, seen = {}, {}
    for item, start, length, number in pieces:
        used[number] = used.get(number, 0) + length
        seen.setdefault(item, []).append((start, length))
    assert max(used.values()) <= 64 and sum(64 - u for u in used.values()) < 64
    for item, own in seen.items():
        at = 0
        for start, length in sorted(own):
            assert start == at
            at += length
        assert at == lengths[item]


def test_html(spark):
    page = ("<header>top</header><nav>menu</nav><aside>side</aside><div class='cookie-notice'>cookies</div><main><article><header><h1>Title</h1></header>"
            "<p>First &lt;one&gt;&nbsp; para<b>graph</b> with enough words to count as text.<p>Second, short.<form>send</form>"
            "<div id=comments><p>A reader says much more than the article does, again and again and again.</p></div></article></main><footer>end</footer>")
    assert html_text.main_text(page) == "Title First <one> paragraph with enough words to count as text. Second, short."
    assert [html_text.main_text(t) for t in (None, "", "<p>", "a < b <!-- c", "<script>x")] == ["", "", "", "a < b", ""]
    df = spark.createDataFrame([(1, None), (1, None), (None, "<p>" * 3000 + "x")], "page_id bigint, html string")
    assert sorted(r.text for r in html_text.extract(df, ["page_id"]).collect()) == ["", "", "x"]
    assert html_text.extract(df.limit(0), ["page_id"]).count() == 0


def test_html_keeps_the_whole_article():
    """Headings, leads, short sections and lists stay, wherever the densest part of the article is."""
    p = lambda n, word="text": f"<p>{(word + ' ') * (n // 5)}</p>"
    body = "".join(p(500) for _ in range(8))
    links = "<ul>" + "".join(f"<li><a href=x>other story {i}</a></li>" for i in range(9)) + "</ul>"
    lead = f"<h1>head of it</h1>{p(300, 'lead')}<div>{body}</div>{p(200, 'last')}"
    two = f"<section><h2>one</h2>{body}</section><section><h2>two</h2>{p(300, 'more')}{p(300, 'also')}<ul><li>item</li></ul></section>"
    plain = lambda source: " ".join(re.sub("<[^>]+>", " ", source).split())
    assert html_text.main_text(f"<body>{links}<article>{lead}</article>{links}</body>") == plain(lead)
    assert html_text.main_text(f"<body><article>{two}</article>{links}</body>") == plain(two)
    assert html_text.main_text(f"<body><div><div>{links}<div>{lead}</div></div></div>{links}</body>") == plain(lead)
    assert html_text.main_text(f"<main>bare lead<h1>title</h1><p>short</p><article>{two}</article>{links}</main>") == plain(f"bare lead title short {two}")
    assert html_text.main_text(f"<div class=entry-content><div>{body}</div>{links}</div>{links}") == plain(body + links)


def test_html_cuts_no_article_by_a_name():
    """Class names, forms and unclosed controls around the article do not remove it; boilerplate of the same names goes."""
    text = "<h1>head</h1>" + "<p>enough words of an article to count as its text</p>" * 6
    plain = lambda source: " ".join(re.sub("<[^>]+>", " ", source).split())
    for opened in ("<div class=has-sidebar>", "<div class='layout-no-sidebar x'>", "<div class=elementor-widget>", "<div class=share-content>",
                   "<section id=related-work>", "<form id=aspnetForm>", "<div class=widget>", "<div role=form>", "<nav>"):
        page = f"<body>{opened}{text}</{opened[1:].split()[0].strip('>')}></body>"
        if opened != "<nav>":
            assert html_text.main_text(page) == plain(text), opened
        else:
            assert html_text.main_text(page) == ""
    parts = "".join(f"<section id={i}><p>{'words of a section ' * 9}</p></section>" for i in ("intro", "related-work", "share-content", "end"))
    assert html_text.main_text(f"<body><div>{parts}</div></body>") == plain(parts)
    for opened in ("<button>", "<select>", "<object>", "<svg>", "<template>", "<nav>"):
        assert html_text.main_text(f"<body>{opened}<article>{text}</article></body>") == plain(text), opened
        closed = f"{opened}label</{opened[1:]}"
        assert html_text.main_text(f"<body><article>{closed}{text}</article>{closed}</body>") == plain(text), opened
    assert html_text.main_text(f"<body><div><button>go{text}</div></body>") == "go " + plain(text)
    assert html_text.main_text(f"<head><title>x</title><body>{text}") == plain(text)
    assert html_text.main_text(f"<article>{text}<p>so <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds</p></article>") == plain(text) + " so E=m holds"
    assert html_text.main_text(f"<article>{text}</article><textarea>{text}") == plain(text)
    junk = ("<div class=left-sidebar><a href=x>one</a> <a href=y>two</a></div><div class=ad-slot>buy</div><div class=ad>buy now</div>"
            "<div class=cookie-banner>we bake</div><div class=related-list><a href=z>other</a></div><ul class=comment-list><li>I say no</li></ul>")
    assert html_text.main_text(f"<body>{junk}<div>{text}{junk}</div>{junk}</body>") == plain(text)
    assert html_text.main_text("<body><div class=ad>an advert of many words</div><article><h1>a</h1><p>short</p></article></body>") == "a short"


def test_ibans_before_words():
    """Upper-case words or another IBAN behind an IBAN do not hide it."""
    one, two = "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"
    found = lambda text: [text[a:b] for kind, a, b, _ in pii.spans(text) if kind == "iban"]
    assert found(f"{one} ON MONDAY") == [one]
    assert found(f"PAY {two} {one} AB12 CD") == [two, one]
    assert found(f"{one}, {two}. {one[:-1]}3 NO") == [one, two]
    assert found(f"AB12 {two} NOW") == [two]


def test_control_strings_over_several_parts():
    """Every split of every control string over two and three parts stays one turn, also across nulls and by placeholders."""
    part = lambda text, kind="text": None if text is None else dict(type=kind, text=text, ref="r", width=None, height=None, seconds=None, pages=None)
    for control in (*chat.CONTROLS, chat.SIGN, chat.SIGN + "n"):
        for i in range(len(control) + 1):
            for j in range(i, len(control) + 1):
                for between in ([], [None], [part("")]):
                    pieces = ["a" + control[:i], control[i:j], control[j:] + "b"]
                    parts = [part(pieces[0]), *between, part(pieces[1]), *between, part(pieces[2])]
                    turns = [{"role": "user", "parts": parts}, {"role": "assistant", "parts": [part("x")]}]
                    text, loss, _ = chat.formatted(turns, chat.Expansion())
                    assert chat.read_turns(text) == [("user", "a" + control + "b"), ("assistant", "x")]
                    assert [text[s["start"]:s["end"]] for s in loss] == ["x"]
            sides = [part(control[:i]), part("", "image"), part(control[i:])]
            text, _, attached = chat.formatted([{"role": "user", "parts": sides}, {"role": "user", "parts": [part("y")]}], chat.Expansion())
            assert len(chat.read_turns(text)) == 2 and text[attached[0]["at"]:].startswith("<|image|>")


def test_near_duplicates_of_an_id_with_two_texts(spark):
    """Each text of a repeated id links on its own, and the id ties both groups together."""
    draw = random.Random(2)
    text = lambda: [f"w{draw.randrange(9000)}" for _ in range(200)]
    a, b = text(), text()
    near = lambda words, at: " ".join(words[:at] + ["changed"] + words[at + 1:])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (10, near(a, 5)), (12, near(a, 190)), (11, near(b, 7)), (13, near(b, 100)), (20, " ".join(text()))]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame([(*r, "g", "h") for r in order], "doc_id bigint, text string, _gone string, _again string")
        assert {r.doc_id: r.component_id for r in near_dup.components(df).collect()} == {1: 1, 10: 1, 11: 1, 12: 1, 13: 1, 20: 20}
        left = near_dup.deduplicate(df)
        assert sorted(r.doc_id for r in left.collect()) == [1, 20] and left.columns == df.columns


def test_no_pair_at_the_limit_is_ruled_out(spark):
    """20,000 pairs of sets at exactly the similarity, small and large: sizes and sketches let all of them through."""
    draw = np.random.default_rng(6)
    rows = []
    for i in range(20_000):
        common = int(draw.choice([4, 40, 400, 1600]))
        each = common // 8
        values = draw.integers(0, 1 << 64, common + 2 * each, dtype=np.uint64)
        rows.append((np.sort(values[:common + each]), np.sort(np.concatenate([values[:common], values[common + each:]]))))
    flat = [s for pair in rows for s in pair]
    sketches = np.concatenate([near_dup.bit_sketch(flat[i:i + 4000]) for i in range(0, len(flat), 4000)])
    pairs = spark.createDataFrame([(i, len(a), len(b), sketches[2 * i].tolist(), sketches[2 * i + 1].tolist()) for i, (a, b) in enumerate(rows)],
                                  "id int, na int, nb int, sa array<bigint>, sb array<bigint>")
    sides = [pairs.select("id", F.col(f"n{x}").alias("n_shingles"), F.col(f"s{x}").alias("sketch")).alias(x) for x in "ab"]
    joined = sides[0].join(sides[1], F.col("a.id") == F.col("b.id"))
    assert joined.where(~near_dup.plausible("a", "b", 80)).count() == 0


def test_poor_groups_still_have_limits(spark):
    """Where many documents of a source repeat lines, one that repeats nothing but lines goes; clean ones stay."""
    draw = random.Random(9)
    line = lambda: " ".join(f"w{draw.randrange(5000)}" for _ in range(9))
    clean = ["\n".join(line() for _ in range(20)) for _ in range(60)]
    poor = ["\n".join([line() for _ in range(11)] + [line()] * 9) for _ in range(40)]
    worst = "\n".join([line()] * 3 + [f"{line()}" for _ in range(2)] + ["the very same words on a line once more"] * 45)
    rows = [(i, t, "en", "a") for i, t in enumerate(clean + poor)] + [(1000, worst, "en", "a")] + [(2000, worst, "de", "b")]
    measured = quality.measure(spark.createDataFrame(rows, "doc_id int, text string, lang string, source string"))
    limits = quality.thresholds(measured)
    assert limits.where("dup_lines_above >= 1000 or repeats_above >= 1000 or symbols_above >= 1000 or upper_above >= 1000").isEmpty()
    kept = {r.doc_id: r.kept for r in quality.judge(measured).collect()}
    assert all(kept[i] for i in range(60)) and not kept[1000]
    for name in ("kept", "base_failed"):
        with pytest.raises(ValueError):
            quality.judge(measured.withColumn(name, F.lit(1)))


def test_group_sizes_do_not_switch_limits(spark):
    """A group of 19 and one of 20 like documents have nearly the same limits: the language's weight fades evenly."""
    rows = [("en", "big", 100, 0)] * 400 + [("en", f"s{n}", 100, 20) for n in (19, 20) for _ in range(n)]
    df = spark.createDataFrame(rows, "lang string, source string, n_lines bigint, n_dup_lines bigint")
    df = df.withColumns({c: F.lit(100).cast("bigint") for c in ("n_words", "word_chars")} | {c: F.lit(0).cast("bigint") for c in ("n_symbols", "n_repeat_words", "n_upper")})
    limit = {r.source: r.dup_lines_above for r in quality.thresholds(df).collect()}
    assert abs(limit["s19"] - limit["s20"]) <= 10 < limit["s19"] - limit["big"]


def _plain(source):
    return " ".join(re.sub("<[^>]+>", " ", source).split())


def test_html_quotes_open_values_only():
    """A quote inside an unquoted value, after a value or alone does not swallow what follows."""
    text = "<h1>Head</h1>" + "<p>it's a paragraph of the article, isn't it</p>" * 9
    for opened in ("<p data-x=it's>", "<p title=\"a\"'>", "<p ' class=x>", "<p a = b\"c>", "<p data-x='a > b'>", "<p x=\"a'b>c\">", "<p x= 'y' z>"):
        assert html_text.main_text(f"<body><article>{opened}lead</p>{text}</article></body>") == "lead " + _plain(text), opened
        assert html_text.main_text(f"<body>{opened}lead</p>{text}</body>") == "lead " + _plain(text), opened


def test_html_cuts_comments_and_teasers_that_are_articles():
    text = "<h1>Head</h1>" + "<p>enough words of an article to count as its text</p>" * 6
    said = "<p>A reader says much more than the author ever did in this article, again and again.</p>" * 3
    body = _plain(text)
    comments = "".join(f"<article class='comment-body' id='comment-{i}'>{said}</article>" for i in range(8))
    teasers = "<section class='related'><article><h3>Another</h3><p>A long teaser of another article of this site</p></article></section>"
    for after in (f"<section class='comments'><h1>8 comments</h1>{comments}</section>", comments, f"<div id=comments-area><h1>All</h1>{said}</div>",
                  f"<ol class='comment-list'>{comments}</ol>", teasers, "<div class='related-posts'><p>Read this as well, a whole sentence of text.</p></div>",
                  "<div class=ad-slot-12>" + "an advert of very many words without a link " * 40 + "</div>"):
        assert html_text.main_text(f"<body><article>{text}</article>{after}</body>") == body, after
        assert html_text.main_text(f"<body><article>{text}{after}</article></body>") == body, after
        assert html_text.main_text(f"<body><main><article>{text}</article>{after}</main></body>") == body, after
        assert html_text.main_text(f"<body><div class=page><div>{text}</div>{after}</div></body>") == body, after
    assert html_text.main_text(f"<body><div class=related>{text}</div></body>") == body


def test_html_threshold_on_the_path():
    """Without article or main, a neighbour half of links stays where it reaches the lowest density on the path."""
    short = "<p>" + "many words of a short paragraph here and there" + "</p>"
    linked = "<p>" + "words and " * 33 + "<a href=x>" + "a long linked title that is part of the text " * 9 + "</a></p>"
    bar = "<div>" + "".join(f"<span><a href=x{i}>go {i}</a></span>" for i in range(20)) + "</div>"
    got = html_text.main_text(f"<body><div><div>{short * 30}</div>{linked}<h2>short</h2></div>{bar}</body>")
    assert got == _plain(f"{short * 30}{linked} short")


def test_html_of_any_depth_in_linear_time():
    """A hundred thousand nested, unclosed or stray tags take seconds."""
    n = 100_000
    for page, text in (("<div>" * n + "</x>" * n, ""), ("<h2>" * n + "x", "x"), ("<div>" * n + "deep" + "</div>" * n, "deep"), ("<p>a<header>" * n, None),
                       ("<a x=" * n, ""), ("<ul><li>" * n + "y", "y")):
        started = time.monotonic()
        got = html_text.main_text(page)
        assert time.monotonic() - started < 20 and (text is None or got == text)


def test_html_column_names(spark):
    df = spark.createDataFrame([(1, "<p>x", "a", 2)], "page_id int, html string, text string, n_chars int")
    for name in ("text", "n_chars"):
        with pytest.raises(ValueError):
            html_text.extract(df, ["page_id", name])
    assert [(r.page_id, r.text, r.n_chars) for r in html_text.extract(df, ["page_id"]).collect()] == [(1, "x", 1)]


def test_near_duplicates_fetch_texts_without_shuffling_the_rest(spark, monkeypatch):
    """Only texts of nodes in a pair leave the scan."""
    draw = random.Random(8)
    words = [f"w{i}" for i in range(5000)]
    rows = [(i, " ".join(draw.choices(words, k=60))) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " more") for i in range(5)] + [(None, rows[0][1]), (200, None), (0, rows[0][1])]
    plans, real = [], near_dup.staged

    def seen(df, label="stage"):
        if label == "texts":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(near_dup, "staged", seen)
    got = near_dup.components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id for r in got if r.kept is False} == {100 + i for i in range(5)}
    assert len(got) == len(rows) and plans and all("BroadcastHashJoin" in p and "SortMergeJoin" not in p for p in plans)


def test_near_duplicates_leave_no_shuffles_and_do_not_shuffle_kept_texts(spark, tmp_path):
    """Steps drop their shuffle files as they end; rows that stay are found without an exchange of the texts."""
    draw = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    rows = [(i, " ".join(draw.choices(words, k=60))) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " more") for i in range(5)] + [(None, rows[0][1]), (200, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = set(manager.getAllFiles().mkString("\n").split())
    left = near_dup.deduplicate(docs)
    files = set(manager.getAllFiles().mkString("\n").split()) - before
    assert not [f for f in files if f.endswith(".data")]
    assert "Exchange hashpartitioning" not in left._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id for r in left.collect()} == {r[0] for r in rows} - {100 + i for i in range(5)}


def test_a_node_has_one_pair_a_pass_however_many_hubs_its_group_has(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(300), rng.randrange(1, 8)):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((i + 1, " ".join(words)))
    passes, similar = [], near_dup.similar
    monkeypatch.setattr(near_dup, "similar", lambda texts, pairs, *a: passes.append(pairs.collect()) or similar(texts, pairs, *a))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.components(spark.createDataFrame(rows, "doc_id bigint, text string"), width=4).collect()}
    assert got == brute.near_duplicates(rows, 4, 80)
    assert len({r["src"] for r in passes[0]}) == len(passes[0]) < len(rows)
