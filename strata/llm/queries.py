"""The operators as registered queries on the given tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    chat,
    decontaminate,
    fingerprint,
    grammar,
    lines,
    manifest,
    mixing,
    packing,
    quality,
    repeats,
    resampling,
    simhash,
    warc,
)
from strata.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: One share each, but for the source that would otherwise swamp the mix.
MIX_REST = 1.0
MIX_WEIGHTS = {"src0": 3.0} | {f"src{i}": 1.0 for i in range(1, 20)}



def tokenizer_path() -> str:
    """The public byte-level BPE vocabulary; the operators take any tokenizers file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if oracle is not None:
            ORACLES[run.__name__] = oracle
        return run

    return register


@_query(r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id DESC) AS r
  FROM documents),
n AS (SELECT d.doc_id, d.text, x.text AS next_text, length(d.text) AS n_chars
  FROM d JOIN d x ON x.r = CASE WHEN d.r = (SELECT max(r) FROM d) THEN 1 ELSE d.r + 1 END),
e AS (SELECT *, substr(text, 1, n_chars - n_chars // 2)
    || substr(next_text, 1, n_chars // 2) AS edited FROM n),
t AS (
  SELECT doc_id, k, list_transform(string_split(v, chr(10)), lambda l: md5(l)) AS paragraphs,
    list_transform(string_split(v, chr(10)), lambda l: list_transform(
      regexp_extract_all(l, '[^\n]{1,32}'), lambda p: substr(md5(p), 1, 8))) AS leaves
  FROM (SELECT doc_id, 'own' AS k, text AS v FROM e UNION ALL SELECT doc_id, 'edited', edited
    FROM e UNION ALL SELECT doc_id, 'next', next_text FROM e)),
p AS (
  SELECT *, list_transform(leaves, lambda x: array_to_string(x, ' ')) AS lines FROM t),
s AS (
  SELECT *, array_to_string(list_transform(range(0, len(lines), 8), lambda i: md5(
    array_to_string(list_slice(paragraphs, i + 1, i + 8), ','))), ',') AS sections FROM p),
f AS (
  SELECT doc_id, k, list_distinct(flatten(leaves)) AS leaf_set, sha256(sections) || ';' || sections
    || ';' || array_to_string(paragraphs, ',') || ';' || array_to_string(lines, ',') AS fp FROM s)
SELECT e.doc_id, n_chars, sha256(edited) AS edited_sha256, a.fp AS fingerprint,
  b.fp AS edited_fingerprint,
  CASE WHEN len(a.leaf_set) + len(b.leaf_set) = 0 THEN 1.0::DOUBLE
    ELSE len(list_intersect(a.leaf_set, b.leaf_set))::DOUBLE
      / greatest(len(a.leaf_set), len(b.leaf_set)) END AS near_edited,
  CASE WHEN len(a.leaf_set) + len(c.leaf_set) = 0 THEN 1.0::DOUBLE
    ELSE len(list_intersect(a.leaf_set, c.leaf_set))::DOUBLE
      / greatest(len(a.leaf_set), len(c.leaf_set)) END AS near_next
FROM e JOIN f a ON a.doc_id = e.doc_id AND a.k = 'own'
JOIN f b ON b.doc_id = e.doc_id AND b.k = 'edited'
JOIN f c ON c.doc_id = e.doc_id AND c.k = 'next'""")
def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_likeness(table(spark, sf_dir, "documents"))


@_query(
    "WITH weights(source, w) AS (VALUES "
    + ", ".join(f"('{s}', {w}::DOUBLE)" for s, w in MIX_WEIGHTS.items())
    + r"""),
classed AS (SELECT d.*, w.source AS class, coalesce(w, 1.0) AS w
  FROM documents d LEFT JOIN weights w ON w.source = d.source),
counts AS (SELECT class, w, count(*) AS n FROM classed GROUP BY ALL),
means AS (SELECT coalesce(class, '') AS class, (SELECT count(*) FROM documents) * w / (SELECT sum(w) FROM counts) / n
  AS mean FROM counts),
terms AS (SELECT class, k, exp(-mean + k * ln(mean) - lgamma(k + 1)) AS p
  FROM means, range(0, 60) r(k)),
cdf AS (SELECT class, k, sum(p) OVER (PARTITION BY class ORDER BY k) AS c FROM terms),
u AS (SELECT *, ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '') || ':0'),
  1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u FROM classed),
drawn AS (SELECT u.*, (SELECT count(*) FROM cdf
  WHERE cdf.class = coalesce(u.class, '') AND c <= u.u) AS n FROM u)
SELECT doc_id, text, lang, source, n_chars, i AS copy,
  md5('order42:' || coalesce(doc_id::VARCHAR, '') || ':' || i::VARCHAR) AS shuffle_key
FROM (SELECT *, unnest(range(0, n)) AS i FROM drawn)"""
)
def op7_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(
        table(spark, sf_dir, "documents"),
        MIX_WEIGHTS,
        rest_weight=MIX_REST,
        copy_col="copy",
        order_col="shuffle_key",
    )


@_query(
    rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text, {_WORDS} AS words
  FROM documents),
w AS (SELECT r, i, words[i:i + 4] AS five FROM d, range(1, len(words) - 3) t(i)),
twice AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, five) AS c FROM w)
  WHERE c > 1),
repeats AS (SELECT r, count(DISTINCT i + o) AS n FROM twice, range(0, 5) t(o) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(text, chr(10)),
  lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (SELECT doc_id, text, len(words) AS n_words,
  len(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines,
  coalesce(n, 0) AS n_repeat_words,
  len(regexp_extract_all(text, '\p{{Lu}}')) AS n_upper,
  len(regexp_extract_all(text, '\p{{L}}')) AS n_letters
  FROM d JOIN lines USING (r) LEFT JOIN repeats USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * n_upper > n_letters) AS kept
FROM b"""
)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = ("words", "symbols", "lines", "repeats")
    measured = quality.measure(documents, "text", base)
    few, repeated = (rule.reject(F.col) for rule in quality.BASE_RULES)
    return measured.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (few | repeated).alias("base_failed"),
        quality.verdict(measured, measured=base).isNull().alias("kept"),
    )


@_query(r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (SELECT *, len(role) + len(text) + 8 + 8 + 7
  + len(regexp_extract_all(role, '[<\[]\\*(?:\||/?s>|/?INST\]|/?SYS>>)'))
  + len(regexp_extract_all(text, '[<\[]\\*(?:\||/?s>|/?INST\]|/?SYS>>)')) AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id""")
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    columns = ["conv_id", "turn", "role", "text"]
    rows = table(spark, sf_dir, "conversations").select(*columns).unionByName(extra)
    formatted = chat.format_chat(rows.withColumn("parts", chat.text_part(F.col("text"))))
    return chat.read_back(formatted)


@_query()
def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grammar.through_files(table(spark, sf_dir, "documents"), tokenizer_path())


@_query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path()))


@_query()
def op6_simhash_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.linked_documents(table(spark, sf_dir, "documents"))


@_query(r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, i AS pos, ls[i] AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM d), range(1, len(ls) + 1) r(i)),
w AS (SELECT *, list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS ws FROM l),
f AS (SELECT ws, line, min(struct_pack(d := doc_id, a := pos)) AS o FROM w WHERE len(ws) > 0
  GROUP BY ALL),
df AS (SELECT t, count(*) AS n FROM (SELECT unnest(ws) AS t FROM f) GROUP BY t),
r AS (SELECT o, t, row_number() OVER (PARTITION BY o ORDER BY n, t) AS p, len(ws) AS k, ws
  FROM (SELECT o, ws, unnest(ws) AS t FROM f) JOIN df USING (t)),
p AS (SELECT * FROM r WHERE p <= k - (4 * k + 4) // 5 + 1),
near AS (SELECT DISTINCT a.o FROM p a JOIN p b ON a.t = b.t AND b.o < a.o
  WHERE 9 * len(list_intersect(a.ws, b.ws)) >= 4 * (a.k + b.k)),
j AS (SELECT w.*, len(w.ws) > 0 AND (f.o <> struct_pack(d := doc_id, a := pos)
    OR near.o IS NOT NULL) AS gone
  FROM w LEFT JOIN f ON w.line = f.line LEFT JOIN near ON near.o = f.o)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id""")
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", n_lines.alias("n_lines")
    )
    kept = lines.dedup_lines(documents, removed_col="n_removed")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", "n_lines", "n_removed", digest.alias("kept_sha256"))


@_query(r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
s AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest
  FROM p),
k AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER
  (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS keeper FROM s)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM k""")
def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.through_archives(spark, table(spark, sf_dir, "pages"))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@_query()
def op1_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return rest.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


_PLAIN_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    r" 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


def _crc32(value: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    byte = f"('0x' || substr(hex(encode({value})), 2 * k + 1, 2))::UINTEGER"
    bits = "list_concat([{0}], repeat([256::UINTEGER], 8))".format(byte)
    return f"""xor(list_reduce(list_concat([4294967295::UINTEGER], flatten(list_transform(
      range(0, octet_length(encode({value}))), lambda k: {bits}))), lambda c, b:
      CASE WHEN b < 256 THEN xor(c, b)
        WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UINTEGER) ELSE c >> 1 END),
      4294967295::UINTEGER)"""


@_query(
    f"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, {_PLAIN_WORDS} AS ws FROM documents),
f AS (SELECT r, unnest(ws) AS f FROM w),
g AS (SELECT unnest({_PLAIN_WORDS}) AS f FROM benchmark),
b AS (SELECT f, {_crc32("f")} % 10000 AS bucket FROM (SELECT f FROM f UNION SELECT f FROM g)),
s AS (SELECT bucket, count(*) AS n FROM f JOIN b USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM g JOIN b USING (f) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln(
    ((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + 10000)::DOUBLE)
    / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM g) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT r, sum(gain)::BIGINT AS weight FROM f JOIN b USING (f) JOIN gains USING (bucket)
  GROUP BY r),
scored AS (SELECT doc_id, len(ws) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))
      ::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN weights USING (r)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id)
    AS place, count(*) FILTER (n_features >= 20) OVER () AS eligible FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank
FROM ranked"""
)
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def _field(value: str) -> str:
    text = f"({value})::VARCHAR"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


_LEAF = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "{n_chars}", "text"))


@_query(
    f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, lang, sha256({_LEAF.format(n_chars="n_chars")}) AS leaf,
    sha256({_LEAF.format(n_chars="n_chars + 1")}) AS other,
    {_crc32("doc_id::VARCHAR")} % 7 = 0 AS tampered FROM documents),
placed AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows),
levels AS (
  SELECT tree, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, max(level) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 1) // 2
  FROM levels WHERE n > 1 GROUP BY tree, pos // 2),
subroots AS (SELECT tree, h, level AS height FROM levels WHERE n = 1),
tops AS (
  SELECT 0 AS level, tree AS pos, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT max(level) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 1) // 2
  FROM tops WHERE n > 1 GROUP BY pos // 2),
nodes AS (SELECT tree, level, pos, h FROM levels UNION ALL SELECT -1, level, pos, h FROM tops),
climb AS (
  SELECT doc_id, leaf, tree AS own, tree, 0 AS level, pos,
    CASE WHEN tampered THEN coalesce(other, leaf) ELSE leaf END AS folded, '' AS proof FROM placed
  UNION ALL
  SELECT doc_id, leaf, own, CASE WHEN c.tree >= 0 AND c.level = r.height THEN -1 ELSE c.tree END,
    CASE WHEN c.tree >= 0 AND c.level = r.height THEN 0 ELSE c.level + 1 END,
    CASE WHEN c.tree >= 0 AND c.level = r.height THEN c.tree ELSE c.pos // 2 END,
    CASE WHEN c.tree >= 0 AND c.level = r.height THEN folded
      WHEN x.h IS NULL THEN sha256(folded)
      WHEN c.pos % 2 = 1 THEN sha256(x.h || folded) ELSE sha256(folded || x.h) END,
    CASE WHEN c.tree >= 0 AND c.level = r.height THEN proof ELSE proof || coalesce(x.h, '') END
  FROM climb c JOIN subroots r ON r.tree = c.own
  LEFT JOIN nodes x ON x.tree = c.tree AND x.level = c.level AND x.pos = xor(c.pos, 1)
  WHERE c.tree >= 0 OR c.level < (SELECT max(level) FROM tops))
SELECT doc_id, leaf, r.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256,
  folded AS folded_root, folded = t.h AS verified
FROM climb c JOIN subroots r ON r.tree = c.own
JOIN tops t ON t.n = 1 AND c.tree = -1 AND c.level = t.level"""
)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claimed = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    built = manifest.build(
        table(spark, sf_dir, "documents"),
        ["doc_id", "source", "lang", "n_chars", "text"],
        id_col="doc_id",
        group_col="lang",
        claimed={"n_chars": claimed},
    )
    return manifest.prove(built).withColumnRenamed("id", "doc_id")


@_query(
    f"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, {_PLAIN_WORDS} AS ws FROM documents),
i AS (SELECT item_id, {_PLAIN_WORDS} AS ws FROM benchmark),
p AS (SELECT DISTINCT item_id, array_to_string(list_slice(ws, k, k + 9), ' ') AS phrase,
    least(len(ws), 10) AS size
  FROM i, range(1, greatest(len(ws) - 9, 1) + 1) t(k) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT size FROM p),
runs AS (SELECT r, k, size, array_to_string(list_slice(ws, k, k + size - 1), ' ') AS phrase
  FROM w, sizes, range(1, len(ws) - size + 2) t(k)),
hits AS (SELECT DISTINCT r, k, p.size, item_id FROM runs JOIN p USING (size, phrase)),
covered AS (SELECT r, count(DISTINCT k + o) AS n_hit FROM hits, range(0, size) t(o) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""
)
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
