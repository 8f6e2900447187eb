"""The registered queries of the subpackage: whole tables in, whole results out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from ..session import cut
from ..sources.derived import table
from . import (
    chat, collocations, decontamination, licenses, pieces, quality, records, repeats, simhash, spelling, surrogates, topk, toxicity,
)
from .settings import bound_batches, byte_tokenizer, piece_model, surrogate_key
from .training import fold


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.anonymise(docs, surrogate_key(spark))


def op2_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products for each vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), topk.integer_vector(F.col("embedding")).alias("vector")
    )
    return topk.top_k(vectors.filter("id % 50 = 0"), vectors)


def op3_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token records on disk; per document what the files say."""
    docs = table(spark, sf_dir, "documents")
    shards = cut(records.write_records(docs, records.new_folder(spark, "records"), byte_tokenizer(), vocabulary=50257))
    return records.read_digests(shards)


def op4_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of every document that holds a license text."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, as examples; digests read back from them."""
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.expand(turns.unionByName(extra)))


def op6_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from four fifths of the labels."""
    stats = cut(quality.with_statistics(table(spark, sf_dir, "documents")))
    model = quality.fit(stats, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return quality.score(stats, model).select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op7_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, as it stands or re-parameterised."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op8_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from two thirds of the labels."""
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    model = toxicity.fit(docs, labels, fold("doc_id", 3) != 1)
    return toxicity.with_toxicity(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "offending",
    )


def op9_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The piece ids of every document, and whether they decode to its text."""
    bound_batches(spark)
    vocabulary = pieces.Vocabulary.load(piece_model())
    encoded = pieces.encode(table(spark, sf_dir, "documents"), vocabulary)
    return pieces.decode(encoded, vocabulary).select(
        "doc_id", F.size("ids").alias("n_pieces"), "ids", (F.crc32("decoded") == F.col("check")).alias("round_trip")
    )


def op10_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_quotient_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two to four words in each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_prefix_free_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of every document stays when strings of 100 bytes that stand earlier go."""
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the corpus with its most frequent neighbour at one edit."""
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_impact_topk": op2_impact_topk,
    "op3_binary_records": op3_binary_records,
    "op4_patience_licenses": op4_patience_licenses,
    "op5_prefix_targets": op5_prefix_targets,
    "op6_fourier_quality": op6_fourier_quality,
    "op7_template_decontamination": op7_template_decontamination,
    "op8_noisy_or_toxicity": op8_noisy_or_toxicity,
    "op9_piece_lattice": op9_piece_lattice,
    "op10_simhash_variants": op10_simhash_variants,
    "op11_quotient_collocations": op11_quotient_collocations,
    "op12_prefix_free_dedup": op12_prefix_free_dedup,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}

#: SQL equivalents; the other queries have none because SQL lacks what their results are made of (model
#: files, XXH64, fitted models, keyed draws), and are held against brute force in ``tests/llm``.
ORACLES = {
    "op2_impact_topk": """
        WITH v AS (
          SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
          FROM embeddings
          WHERE vec_id IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (
          SELECT q.vec_id AS query_id, c.vec_id, q.e, c.e AS f
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) AND q.vec_id % 50 = 0),
        s AS (
          SELECT query_id, vec_id, CAST(list_sum(list_transform(list_zip(e, f), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM p),
        r AS (
          SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op5_prefix_targets": r"""
        WITH t AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
          UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        m AS (
          SELECT *, length('<|turn|><|text|><|end|>')
              + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS chars,
            row_number() OVER o AS n, count(*) OVER (PARTITION BY conv_id) AS size
          FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)),
        c AS (
          SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS upto FROM m)
        SELECT conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
          CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
          CAST(sum(upto) FILTER (role = 'assistant' OR n = size) AS BIGINT) AS formatted_chars
        FROM c GROUP BY conv_id
    """,
    "op11_quotient_collocations": r"""
        WITH p AS (
          SELECT row_number() OVER () AS piece, lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w
          FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents)),
        g AS (
          SELECT lang, k, w[i : i + k - 1] AS ids
          FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p), (SELECT unnest([1, 2, 3, 4]) AS k)
          WHERE i + k - 1 <= len(w)),
        f AS (SELECT lang, k, ids, count(*) AS f FROM g GROUP BY ALL),
        n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, ids, f AS a FROM f WHERE k > 1 AND f >= 30),
        cuts AS (
          SELECT c.lang, c.ids, c.k, c.a, x.l, x.r, x.cut, (CAST(2000000 AS HUGEINT) * c.a) // (x.l + x.r) AS score
          FROM c JOIN (
            SELECT d.lang, d.ids, d.cut, fl.f AS l, fr.f AS r
            FROM (SELECT lang, ids, k, unnest(range(1, k)) AS cut FROM c) d
            JOIN f fl ON fl.lang = d.lang AND fl.ids = d.ids[1 : d.cut]
            JOIN f fr ON fr.lang = d.lang AND fr.ids = d.ids[d.cut + 1 : d.k]) x ON x.lang = c.lang AND x.ids = c.ids),
        best AS (
          SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ids ORDER BY score, cut) = 1),
        longer AS (
          SELECT DISTINCT lang, part, a FROM (
            SELECT lang, a, ids[i : i + m - 1] AS part
            FROM (SELECT lang, k, ids, a, unnest(range(1, k + 1)) AS i FROM c), (SELECT unnest([2, 3]) AS m)
            WHERE m < k AND i + m - 1 <= k)),
        kept AS (
          SELECT b.* FROM best b
          WHERE NOT EXISTS (SELECT 1 FROM longer o WHERE o.lang = b.lang AND o.part = b.ids AND 100 * o.a >= 80 * b.a)),
        ranked AS (
          SELECT lang, array_to_string(ids, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score,
            row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ids, ' ')) AS rank
          FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
    """,
}
