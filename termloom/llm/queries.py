"""The registered queries of this subpackage and their SQL twins for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import (
    alignment,
    bpe,
    fingerprints,
    lm_scoring,
    mixing,
    ngram_jaccard,
    pii,
    prefix_trie,
    quality_classifier,
    quality_rules,
    substring_dedup,
    token_counts,
)
from termloom.llm.warc import mark_revisits, read_archives, write_archives
from termloom.session import scratch_path, staged

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
BYTE_LEVEL = "byte_bpe_50k.json"
MAX_TOKENS = 4096


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through a written archive and back. A null page_id stays null."""
    pages = mark_revisits(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), "page_id", "html")

    def urn(column: str):
        return F.concat(F.lit("urn:page:"), F.col(column).cast("string"))

    records = pages.select(
        F.coalesce(urn("page_id"), F.lit("urn:page:")).alias("record_id"),
        F.col("url").alias("uri"),
        urn("refers_to").alias("refers_to_id"),
        F.encode("html", "UTF-8").alias("payload"),
    )
    path = scratch_path(spark, "archives")
    write_archives(records, path)

    def key(column: str):
        return F.regexp_extract(column, "^urn:page:(-?[0-9]+)$", 1).try_cast("bigint")

    read = read_archives(spark, path, payloads=False)
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.col("error"))).otherwise(F.col("record_type"))
    read = read.withColumn("record_type", sound)
    responses = read.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("payload_bytes").alias("full_bytes")
    )
    # Rows that repeat a page repeat its record; one of them tells the length.
    responses = responses.groupBy("refers_to_id").agg(F.max("full_bytes").alias("full_bytes"))
    # Responses refer to nothing; their own ids spread them over all tasks of the join.
    asked = F.coalesce(F.col("refers_to_id"), F.concat(F.lit("none:"), F.col("record_id"))).alias("asked")
    return read.select("*", asked).join(responses.withColumnRenamed("refers_to_id", "asked"), "asked", "left").select(
        key("record_id").alias("page_id"),
        F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        key("refers_to_id").alias("refers_to"),
    )


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and component of every document's set of 4-word shingles, linked from 85 percent on."""
    return ngram_jaccard.join_similar(_table(spark, sf_dir, "documents"), words=4, percent=85)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every text, as counts and as one string."""
    found = pii.find_pii(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.KINDS[:4]))

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def count(kind: str):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
        F.transform("pii", lambda s: s["score"]).alias("scores"),
    )


def held_out(doc_id: str = "doc_id"):
    """The fold that no label is learned from; a row without an id is not in it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


KEEP_FROM = 0.7


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality_classifier.Model:
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out())
    return quality_classifier.train(docs, labels, "quality")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every text."""
    docs = _table(spark, sf_dir, "documents")
    scored = quality_classifier.score(docs, quality_model(spark, sf_dir, docs), keep=["doc_id"])
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_count().alias("size"), mixing.place().alias("place")
    )
    docs = staged(docs, "mix-sizes")
    mixed = mixing.mix(docs, mixing.plan_mix(docs))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every text, and whether it passes all quality rules."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.order_rules(docs, quality_rules.FURTHER_RULES, after=quality_rules.BASE_RULES)
    return quality_rules.stats_and_verdict(docs, rules, keep=["doc_id"])


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next one's are."""
    docs = fingerprints.edited_neighbours(_table(spark, sf_dir, "documents"))
    docs = docs.withColumns(
        {"own": fingerprints.sketch(F.col("text")), "other": fingerprints.sketch(F.col("edited"))}
    )
    return docs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("own")).alias("fingerprint"),
        fingerprints.as_text(F.col("other")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("own"), F.col("other")).alias("near_edited"),
        fingerprints.resemblance(F.col("own"), F.col("next_sketch")).alias("near_next"),
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much every document is like the benchmark rather than like all documents."""
    docs = _table(spark, sf_dir, "documents")
    scorer = lm_scoring.fit(_table(spark, sf_dir, "benchmark"), docs)
    return lm_scoring.score(docs, scorer, keep=["doc_id"])


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again, as digests."""
    path = public_tokenizers.path(TOKENIZER)
    decoded = bpe.encode(_table(spark, sf_dir, "documents"), path, keep=["doc_id"], decoded=True)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the passages that a document with a smaller id has."""
    found = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every common beginning of the rebuilt conversations."""
    told = prefix_trie.sequences(_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_nodes(prefix_trie.rebuilt(told))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every text by two tokenizers, in groups that end together."""
    paths = (public_tokenizers.path(name) for name in (BYTE_LEVEL, PIECES))
    return alignment.alignments(_table(spark, sf_dir, "documents"), *paths, keep=["doc_id"])


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of bytes and tokens of every text, and whether it has more than a context holds."""
    docs = _table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs, public_tokenizers.path(PIECES), keep=["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_pii": op3_pii,
    "op4_quality": op4_quality,
    "op5_mixing": op5_mixing,
    "op6_quality_rules": op6_quality_rules,
    "op7_fingerprints": op7_fingerprints,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_bpe": op9_bpe,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_alignment": op12_token_alignment,
    "op13_token_counts": op13_token_counts,
}

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {1 + 5 * i}, 5))::INTEGER >> {s}) & 31) + 1, 1)"
    for i in range(8)
    for s in (15, 10, 5, 0)
)

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP2 = rf"""WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b) AS least FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least(least, doc_id), doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""

_OP5 = f"""WITH d AS (
    SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT AS place
    FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 3.0::DOUBLE * source_size AS most, [5.0, 2.0, 1.0][
          ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::DOUBLE AS weight FROM s),
l AS (SELECT *, row_number() OVER o AS number, most / weight AS reach,
             (sum(source_size) OVER () - coalesce(sum(most) OVER (
                 ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (
                 ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w WINDOW o AS (ORDER BY most / weight, source NULLS LAST)),
g AS (SELECT source, source_size, coalesce(least(most, weight *
          (SELECT level FROM l WHERE level <= reach ORDER BY number LIMIT 1)), most) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM g),
c AS (SELECT source, place, sum(size) AS size FROM d GROUP BY ALL),
r AS (SELECT source, place, size, sum(size) OVER (PARTITION BY source ORDER BY place) AS upto FROM c),
e AS (SELECT r.source, CASE WHEN upto - rest < rest - (upto - size) THEN place + 1 ELSE place END AS threshold
      FROM r JOIN (SELECT *, target - passes * source_size AS rest FROM p) q ON r.source IS NOT DISTINCT FROM q.source
      WHERE upto - size < rest AND rest <= upto)
SELECT doc_id, size, source_size, target,
       ((passes + (place < coalesce(threshold, 0))::INTEGER) * size)::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source"""

_OP6 = f"""WITH d AS (SELECT doc_id, text, {_WORDS} AS w FROM documents),
b AS (SELECT doc_id, len(w)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
             length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS n_upper,
             length(regexp_replace(coalesce(text, ''), '[^a-z]', '', 'g')) AS n_lower, w FROM d),
i AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 1, 1))) AS i, w FROM d),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM i),
q AS (SELECT doc_id, count(DISTINCT spot)::BIGINT AS n_repeat_words FROM (
          SELECT doc_id, unnest([i, i + 1, i + 2]) AS spot FROM g WHERE n > 1) GROUP BY doc_id),
s AS (SELECT b.*, (len(lines) - list_unique(lines))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM b LEFT JOIN q USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= 3 * n_words AND 10 * n_dup_lines <= 6 * len(lines)
       AND n_upper <= n_lower AND word_chars BETWEEN 2 * n_words AND 25 * n_words AS kept FROM f"""

_OP10 = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM d),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(w[i:i + 12], ' ')) AS least FROM i),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM m WHERE least < doc_id),
k AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
s AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS kept
      FROM k ANTI JOIN g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN s USING (doc_id)"""

_OP11 = """WITH x AS (SELECT list(v ORDER BY x) AS tab FROM (SELECT x, list_reduce(list_prepend(x, range(8)),
          lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(x))),
t AS (SELECT conv_id, turn, coalesce(text, '') AS text, md5(coalesce(role, '')) || md5(coalesce(text, '')) AS k
      FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(k ORDER BY turn NULLS FIRST, k) AS ks,
             list(octet_length(encode(text))::BIGINT ORDER BY turn NULLS FIRST, k) AS bs FROM t GROUP BY conv_id),
h AS (SELECT conv_id, ks, bs, xor(4294967295, list_reduce(list_prepend(4294967295,
             list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
             lambda a, d: xor(a >> 8, tab[(xor(a, d) & 255) + 1]))) % 9 AS h FROM c, x),
r AS (SELECT h.conv_id, list_concat(coalesce(c.ks[1:h], []), h.ks[h + 1:]) AS ks,
             list_concat(coalesce(c.bs[1:h], []), h.bs[h + 1:]) AS bs
      FROM h LEFT JOIN c ON c.conv_id = h.conv_id - h.conv_id % 5),
p AS (SELECT conv_id, ks, bs, unnest(range(len(ks) + 1)) AS d FROM r),
n AS (SELECT d, md5(array_to_string(ks[1:d], '')) AS k, md5(array_to_string(ks[1:greatest(d - 1, 0)], '')) AS up,
             min(conv_id) AS conv_id, count(*) AS n, any_value(bs[d]) AS b, any_value(ks[1:d]) AS ks,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = len(ks)), '') AS ends
      FROM p GROUP BY d, k, up),
m AS (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN (
          SELECT up AS k, d - 1 AS d, count(*) AS kids FROM n WHERE d > 0 GROUP BY ALL) USING (k, d)),
a AS (SELECT e AS d, md5(array_to_string(ks[1:e], '')) AS k, sum((kids = 0)::BIGINT) AS leaves,
             sum((n - 1) * coalesce(b, 0)) AS saved FROM (SELECT *, unnest(range(d + 1)) AS e FROM m) GROUP BY ALL)
SELECT m.conv_id, m.d AS depth, o.conv_id AS parent_conv_id, m.n AS n_convs, m.kids AS n_children,
       a.leaves::BIGINT AS n_leaves, a.saved::BIGINT AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN a USING (k, d) LEFT JOIN m o ON m.d > 0 AND o.k = m.up AND o.d = m.d - 1"""

ORACLE_SQL: dict[str, str] = {
    "op1_warc": f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
last AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS newest FROM p)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM newest THEN newest END AS refers_to FROM last""",
    "op2_ngram_jaccard": _OP2,
    "op5_mixing": _OP5,
    "op6_quality_rules": _OP6,
    "op10_substring_dedup": _OP10,
    "op11_prefix_trie": _OP11,
}
