"""SQL of the queries that SQL can express."""

from __future__ import annotations

from millrace.llm import chat, quality

SHARD_LIMIT = 256 << 10  # splits the tables at every scale; no document of theirs is longer
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

SHARDING = f"""
    WITH k AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
        lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT)), 48, '0') AS bits FROM documents),
    p AS (SELECT doc_id, n_bytes, left(bits, CAST(d AS INT)) AS shard, CAST(d AS INT) AS local_depth FROM k, range(0, 49) AS r(d)),
    s AS (SELECT shard, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes FROM p GROUP BY 1),
    f AS (SELECT p.*, shard_bytes, row_number() OVER (PARTITION BY doc_id ORDER BY local_depth) AS n
        FROM p JOIN s USING (shard) WHERE shard_bytes <= {SHARD_LIMIT})
    SELECT doc_id, n_bytes, shard, local_depth, shard_bytes, true AS fits FROM f WHERE n = 1"""

# Checksums byte by byte, from a table of 256 remainders.
RESAMPLING = f"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ITEM_WORD}') AS w FROM documents),
    f AS MATERIALIZED (SELECT doc_id, unnest(w) AS word FROM d),
    g AS MATERIALIZED (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ITEM_WORD}')) AS word FROM benchmark),
    r AS (SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
        FROM range(256) AS x(b)),
    k AS MATERIALIZED (SELECT word, xor(list_reduce(list_transform(range(0, strlen(word)), lambda i: CAST('0x' || substr(hex(word), CAST(2 * i + 1 AS INT), 2) AS BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
        FROM (SELECT word FROM f UNION SELECT word FROM g) AS words, r),
    s AS (SELECT bucket, count(*) AS n FROM f JOIN k USING (word) GROUP BY 1),
    t AS (SELECT bucket, count(*) AS n FROM g JOIN k USING (word) GROUP BY 1),
    a AS (SELECT word, floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM f) + 10000.0::DOUBLE)
            / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM g) + 10000.0::DOUBLE)))) AS gain
        FROM k LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
    w AS (SELECT doc_id, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM f JOIN a USING (word) GROUP BY 1),
    h AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
            coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
        FROM d LEFT JOIN w USING (doc_id)),
    o AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM h WHERE n_features >= 20)
    SELECT h.doc_id, n_features, weight, score, CASE WHEN place <= 10 * (SELECT count(*) FROM o) // 100 THEN place END AS rank FROM h LEFT JOIN o USING (doc_id)"""

TOP_K = f"""
    WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE {USABLE}),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def vector_codes(rounds: int = 4) -> str:
    """Product codes: every round assigns by |x|^2 - 2xc + |c|^2 over all entries and takes floored means."""
    parts = [f"""
    WITH v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE {USABLE}),
    p AS MATERIALIZED (SELECT vec_id, part, v[part * (len(v) // 4) + 1 : (part + 1) * (len(v) // 4)] AS x FROM v, range(4) AS r(part)),
    b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p QUALIFY entry < 256)"""]
    for n in range(rounds + 1):
        parts.append(f"""
    a{n} AS MATERIALIZED (SELECT vec_id, p.part, any_value(p.x) AS x, min(CAST(list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, b.x)
            + list_inner_product(b.x, b.x) AS BIGINT) * 256 + entry) AS best FROM p JOIN b{n} AS b ON p.part = b.part GROUP BY ALL)""")
        if n < rounds:
            parts.append(f"""
    m{n} AS (SELECT part, entry, list(y ORDER BY place) AS x FROM (SELECT part, best % 256 AS entry, place, floor(sum(x[place]) / count(*)) AS y
            FROM a{n}, range(1, (SELECT max(len(x)) FROM p) + 1) AS r(place) GROUP BY ALL) GROUP BY ALL),
    b{n + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{n} AS b LEFT JOIN m{n} AS m ON b.part = m.part AND b.entry = m.entry)""")
    return ",".join(parts) + f""",
    c AS (SELECT vec_id, string_agg(lpad(lower(hex(best % 256)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(best // 256) AS BIGINT) AS error FROM a{rounds} GROUP BY 1),
    h AS (SELECT sha256(string_agg(CAST(CAST(x[place] AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256
        FROM b{rounds}, range(1, (SELECT max(len(x)) FROM p) + 1) AS r(place))
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c JOIN v USING (vec_id), h"""


LOWER_TEXT = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
SPACE = r"[\x20\x09-\x0D]"
SPACED = f"list_filter(string_split_regex({LOWER_TEXT}, '{SPACE}+'), lambda w: w <> '')"

# Pairs through shared shingles, and what they reach.
NEAR_DUP = f"""
    WITH RECURSIVE d AS (SELECT doc_id, {SPACED} AS w FROM documents),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS shingle FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i) WHERE len(w) > 0),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    e AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
    r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
    m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)"""

DECONTAMINATE = f"""
    WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({LOWER_TEXT}, '{ITEM_WORD}') AS w FROM documents),
    b AS (SELECT item_id, w, least(13, len(w)) AS size FROM (SELECT item_id, regexp_extract_all({LOWER_TEXT}, '{ITEM_WORD}') AS w FROM benchmark) AS i WHERE len(w) > 0),
    v AS MATERIALIZED (SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS run FROM b, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)),
    x AS (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS run FROM d, (SELECT DISTINCT size FROM v) AS z, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)),
    f AS MATERIALIZED (SELECT doc_id, item_id, i, x.size FROM x JOIN v ON x.size = v.size AND x.run = v.run),
    h AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM f) AS p GROUP BY 1),
    k AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM f) AS u GROUP BY 1)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)"""


def _quality() -> str:
    """Measures, sketches of six leading bits, quartiles mixed with the language's, fences and the verdict."""
    words = f"list_filter(string_split_regex(coalesce(text, ''), '{SPACE}+'), lambda w: w <> '')"
    lines = rf"list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))"
    shares = ", ".join(f"CAST(floor({part} * {factor} / greatest({whole}, 1)) AS BIGINT) AS s_{rule}" for rule, (part, whole, factor, *_) in quality.RULES.items())
    bucketed = " UNION ALL ".join(f"SELECT lang, source, '{rule}' AS rule, s_{rule} - s_{rule} % CAST(pow(2, greatest(length(bin(s_{rule})) - 6, 0)) AS BIGINT) AS bucket FROM h" for rule in quality.RULES)
    mixed = lambda q, p: f"(n.n * n.{q} + {quality.LANGUAGE_WEIGHT} * m.{p}) / (n.n + {quality.LANGUAGE_WEIGHT})"
    limits, within = [], []
    for rule, (_, _, _, above, below, highest) in quality.RULES.items():
        fence = f"floor(q3 + 3 * (q3 - q1) + {above})"
        limits.append(f"max(CASE WHEN rule = '{rule}' THEN {fence if highest is None else f'least({fence}, {highest})'} END) AS a_{rule}")
        within.append(f"s_{rule} <= a_{rule}")
        if below is not None:
            limits.append(f"max(CASE WHEN rule = '{rule}' THEN ceil(q1 - 3 * (q3 - q1) - {below}) END) AS b_{rule}")
            within.append(f"s_{rule} >= b_{rule}")
    quartiles = lambda name, source, keys: f"""{name} AS (SELECT {keys}, rule, max(every) AS n, min(CASE WHEN 4 * upto >= every THEN bucket END) AS q1,
        min(CASE WHEN 4 * upto >= 3 * every THEN bucket END) AS q3 FROM (SELECT *, sum(n) OVER (PARTITION BY {keys}, rule ORDER BY bucket) AS upto,
        sum(n) OVER (PARTITION BY {keys}, rule) AS every FROM {source}) AS r GROUP BY {keys}, rule)"""
    return f"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, lang, source, {words} AS w, {lines} AS l FROM documents),
    t AS (SELECT id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS run FROM d, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i)),
    c AS (SELECT id, count(DISTINCT spot) AS n_repeat_words FROM (SELECT id, unnest([i, i + 1, i + 2]) AS spot FROM (SELECT *, count(*) OVER (PARTITION BY id, run) AS n FROM t) AS g WHERE n > 1) AS p GROUP BY 1),
    e AS (SELECT d.id, doc_id, lang, source, len(w) AS n_words, CAST(coalesce(length(array_to_string(w, '')), 0) AS BIGINT) AS word_chars,
        len(regexp_extract_all(array_to_string(w, ''), '[#*$%&|<>]')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, len(regexp_extract_all(array_to_string(w, ''), '[A-Z]')) AS n_upper FROM d LEFT JOIN c USING (id)),
    h AS MATERIALIZED (SELECT *, {shares} FROM e),
    k AS MATERIALIZED (SELECT lang, source, rule, bucket, count(*) AS n FROM ({bucketed}) AS u GROUP BY ALL),
    o AS (SELECT lang, rule, bucket, sum(n) AS n FROM k GROUP BY ALL),
    {quartiles('n', 'k', 'lang, source')}, {quartiles('m', 'o', 'lang')},
    q AS (SELECT n.lang, n.source, n.rule, {mixed('q1', 'q1')} AS q1, {mixed('q3', 'q3')} AS q3
        FROM n JOIN m ON n.lang IS NOT DISTINCT FROM m.lang AND n.rule = m.rule),
    z AS (SELECT lang, source, {", ".join(limits)} FROM q GROUP BY ALL),
    y AS (SELECT h.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {" AND ".join(within)} AS inside
        FROM h JOIN z ON h.lang IS NOT DISTINCT FROM z.lang AND h.source IS NOT DISTINCT FROM z.source)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND inside AS kept FROM y"""


def _chat() -> str:
    """Turns and assistant texts as they are, and the length that marks and escapes add up to."""
    special = "|".join([chat.SIGN, *("".join(f"\\{c}" if c in "[]|" else c for c in control) for control in chat.CONTROLS)])
    own = "</s>[INST] ok [/INST]"
    order = "ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST"
    return f"""
    WITH t AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -7, 0, 'user', '{own}' UNION ALL SELECT -7, 1, 'assistant', '{own}'),
    f AS (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS x FROM t),
    g AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' {order})) AS turns_sha256,
        coalesce(string_agg(x, '' {order}) FILTER (r = 'assistant'), '') AS loss,
        sum({len(chat.START) + len(chat.END) + 2} + length(r) + len(regexp_extract_all(r, '{special}')) + length(r) - length(replace(r, chr(10), ''))
            + length(x) + len(regexp_extract_all(x, '{special}'))) AS n FROM f GROUP BY conv_id)
    SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars FROM g"""


SQL: dict[str, str] = {
    "op3_sharding": SHARDING,
    "op4_near_dup": NEAR_DUP,
    "op5_decontaminate": DECONTAMINATE,
    "op7_quality": _quality(),
    "op8_chat": _chat(),
    "op11_importance_resampling": RESAMPLING,
    "op12_top_k": TOP_K,
    "op13_vector_codes": vector_codes(),
}
