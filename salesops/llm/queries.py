"""The registered queries, one per operator, each on its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.llm import (
    conversations,
    decontamination,
    fingerprints,
    jaccard,
    language_model,
    merkle,
    packing,
    periods,
    quality,
    sharding,
    token_counts,
    toxicity,
    urls,
)
from salesops.llm.registry import ORACLES, QUERIES, in_small_batches, query, table  # noqa: F401

_SIZE = sharding.table_size(sharding.SHARDS)


def _md5_number(text: str, modulus: int) -> str:
    return f"(CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT) % {modulus})"


@query()
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities of the toxicity categories of every document, and the decision."""
    return toxicity.classify(in_small_batches(spark, folder, "documents"), in_small_batches(spark, folder, "labels"))


@query(
    f"""
    WITH RECURSIVE shard AS (
        SELECT k, 'shard-' || lpad(CAST(k AS VARCHAR), 5, '0') AS name FROM range({sharding.SHARDS}) t(k)),
    preference AS (
        SELECT k, [({_md5_number("name || '/offset'", _SIZE)} + j * ({_md5_number("name || '/step'", _SIZE - 1)} + 1))
            % {_SIZE} + 1 FOR j IN range({_SIZE})] AS slots FROM shard),
    claim AS (
        SELECT 0 AS turn, [CAST(NULL AS INTEGER) FOR j IN range({_SIZE})] AS owners
        UNION ALL
        SELECT turn + 1, owners[:slot - 1] || [CAST(turn % {sharding.SHARDS} AS INTEGER)] || owners[slot + 1:]
        FROM (SELECT c.turn, c.owners, list_filter(p.slots, lambda s: c.owners[s] IS NULL)[1] AS slot
              FROM claim c JOIN preference p ON p.k = c.turn % {sharding.SHARDS} WHERE c.turn < {_SIZE}) t)
    SELECT d.doc_id, d.slot, c.owners[d.slot + 1] AS shard
    FROM (SELECT doc_id, {_md5_number("coalesce(CAST(doc_id AS VARCHAR), '')", _SIZE)} AS slot FROM documents) d,
        (SELECT owners FROM claim WHERE turn = {_SIZE}) c
    """
)
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document among 64 shards."""
    documents = table(spark, folder, "documents").select("doc_id")
    return sharding.place(documents, ["doc_id"], sharding.shard_names())


@query()
def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's class of near duplicates: five words, similarity 0.8."""
    return jaccard.near_duplicates(table(spark, folder, "documents"))


@query()
def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return fingerprints.with_neighbours(table(spark, folder, "documents"))


@query()
def op5_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Probability of every document under a model of nine tenths of them."""
    return language_model.score(table(spark, folder, "documents"))


@query(
    r"""
    WITH one AS (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY conv_id, turn),
    quoting AS (
        SELECT c.conv_id, c.turn, c.text, coalesce(regexp_matches(b1.text, '\S'), false) AS answers,
            coalesce(regexp_matches(b2.text, '\S'), false) AS deeper
        FROM conversations c
        LEFT JOIN one b1 ON b1.conv_id = c.conv_id AND b1.turn = c.turn - 1
        LEFT JOIN one b2 ON b2.conv_id = c.conv_id AND b2.turn = c.turn - 2),
    rooted AS (
        SELECT *, max(CASE WHEN NOT answers THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS root FROM quoting)
    SELECT conv_id, turn, CASE WHEN answers THEN turn - 1 END AS parent, root, turn - root AS depth,
        CAST(answers AS BIGINT) + CAST(deeper AS BIGINT) AS n_quotes,
        CAST(answers AS BIGINT) + CAST(deeper AS BIGINT) AS n_linked,
        CASE WHEN deeper THEN 2 WHEN answers THEN 1 ELSE 0 END::BIGINT AS deepest,
        trim(coalesce(text, ''), E' \t\n\r') AS own_text
    FROM rooted
    """
)
def op6_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations of all turns, found again from quotes alone, after each was written as mail."""
    mail = conversations.as_mail(table(spark, folder, "conversations"))
    return conversations.link_quotes(mail)


@query()
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, and how much of it fits into 2048 of them."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.token_counts(table(spark, folder, "documents"), path, 2048)


@query()
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces in sequences of at most 4096 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, folder, "documents"), path, 4096, 2)


@query()
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every occurrence of a benchmark item in a document, with a tenth of its characters changed at most."""
    return decontamination.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, learned from the labels that are not held out."""
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


# The listed rules for pages.
URL_RULES = (
    urls.Rule("allow", "org/"),
    urls.Rule("block", "example.org/es/"),
    urls.Rule("block", "example.org/en/1"),
    urls.Rule("allow", "com/fr/"),
    urls.Rule("block", "com/de/"),
)


@query()
def op11_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's URL, by the listed rules or by trees that learn from what these decide."""
    return urls.judge(table(spark, folder, "pages"), URL_RULES)


_LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def _sql_leaf(text: str) -> str:
    parts = (f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in (*_LEAF[:-1], text))
    return f"sha256({' || '.join(parts)})"


# A run of eight becomes the digest of its digests; done trees pass through. Levels keep all nodes.
_SQL_TREE = """
    {0} AS (
        SELECT 0 AS level, tree, position, digest, size FROM {1}
        UNION ALL
        SELECT level + 1, tree, position // 8, sha256(string_agg(digest, '' ORDER BY position)), (any_value(size) + 7) // 8
        FROM {0} WHERE size > 1 GROUP BY level, tree, position // 8)"""


@query(
    f"""
    WITH RECURSIVE
    bits AS (
        SELECT i, 0 AS step, CAST(i AS BIGINT) AS v FROM range(256) t(i)
        UNION ALL
        SELECT i, step + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE step < 8),
    crcs AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE step = 8),
    leaves AS (
        SELECT doc_id, lang, {_sql_leaf("text")} AS leaf, {_sql_leaf("lowered")} AS changed,
            xor(list_reduce(
                list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), 4294967295), 4294967295) % 3 = 0 AS tampered
        FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM documents), crcs),
    placed AS (
        SELECT *, coalesce('=' || lang, '') AS tree,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS position FROM leaves),
    bottom AS (SELECT tree, position, leaf AS digest, count(*) OVER (PARTITION BY tree) AS size FROM placed),
    {_SQL_TREE.format("low", "bottom")},
    subroots AS (SELECT tree AS name, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM low WHERE size = 1),
    roofs AS (SELECT '' AS tree, place AS position, subroot AS digest, count(*) OVER () AS size FROM subroots),
    {_SQL_TREE.format("high", "roofs")},
    top AS (SELECT digest AS root FROM high WHERE size = 1),
    runs AS (
        SELECT 'low' AS part, level, tree, position // 8 AS run, list(digest ORDER BY position) AS digests
        FROM low WHERE size > 1 GROUP BY ALL
        UNION ALL
        SELECT 'high', level, tree, position // 8, list(digest ORDER BY position) FROM high WHERE size > 1 GROUP BY ALL),
    climb AS (
        SELECT doc_id, leaf, tree, position, 'low' AS part, 0 AS level, tree AS now,
            CASE WHEN tampered THEN changed ELSE leaf END AS folded, '' AS proof, position AS at, false AS done FROM placed
        UNION ALL
        SELECT c.doc_id, c.leaf, c.tree, c.position,
            CASE WHEN r.run IS NULL THEN 'high' ELSE c.part END,
            CASE WHEN r.run IS NULL THEN 0 ELSE c.level + 1 END,
            CASE WHEN r.run IS NULL THEN '' ELSE c.now END,
            CASE WHEN r.run IS NULL THEN c.folded ELSE sha256(
                array_to_string(r.digests[:c.at % 8] || [c.folded] || r.digests[c.at % 8 + 2:], '')) END,
            CASE WHEN r.run IS NULL THEN c.proof
                ELSE c.proof || array_to_string(r.digests[:c.at % 8] || r.digests[c.at % 8 + 2:], '') END,
            CASE WHEN r.run IS NULL THEN s.place ELSE c.at // 8 END,
            r.run IS NULL AND c.part = 'high'
        FROM climb c
        LEFT JOIN runs r ON r.part = c.part AND r.level = c.level AND r.tree = c.now AND r.run = c.at // 8
        JOIN subroots s ON s.name = c.tree
        WHERE NOT c.done)
    SELECT c.doc_id, c.leaf, s.subroot, root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = root AS verified
    FROM climb c JOIN subroots s ON s.name = c.tree, top WHERE c.done
    """
)
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of all documents by language, and what folding gives where every third text lost its capitals."""
    documents = table(spark, folder, "documents")
    columns = [F.col(c) for c in _LEAF]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf([*columns[:-1], lowered]))
    proved = merkle.manifest(documents, "doc_id", F.col("lang"), merkle.leaf(columns), tampered)
    return proved.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


# With h = 10 g: the words from place a = g % n on repeat the first p = 1 + (n - a) / (3 + g % 8) of them.
_REPEATED = r"""
    element_at(transform(array(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)), w ->
        CASE WHEN size(w) = 0 THEN '' ELSE array_join(transform(sequence(0, size(w) - 1), i ->
            get(w, int(CASE WHEN i < g % size(w) THEN i
                ELSE g % size(w) + (i - g % size(w)) % (1 + (size(w) - g % size(w)) div (3 + g % 8)) END))), ' ') END), 1)
"""


def with_repeats(documents: DataFrame) -> DataFrame:
    """Documents of which a tenth, by a hash of the id, repeat some of their words to the end; the others as they are."""
    hashed = F.crc32(F.col("doc_id").cast("string"))
    return (
        documents.select("doc_id", "text", hashed.alias("h"), F.floor(hashed / 10).alias("g"))
        .select("doc_id", F.when(F.col("h") % 10 == 0, F.expr(_REPEATED)).otherwise(F.col("text")).alias("text"))
    )


@query()
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in all documents, a tenth of which were made periodic, and the texts without repeats."""
    found = periods.periodic_runs(with_repeats(table(spark, folder, "documents")))
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    longest = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    length, period = F.col("longest.length"), -F.col("longest.period")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(length * 1000 / period).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
