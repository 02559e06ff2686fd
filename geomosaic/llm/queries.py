"""The registered query of each operator of this package, and its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geomosaic.llm import bpe_codec, chat, collocations, exact_dedup, minhash, packing, periodic_runs, quality_classifier, quality_rules, sharding, simhash, suffix_tree, token_counts
from geomosaic.llm.common import read


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document."""
    docs = read(spark, sf_dir, "documents")
    return quality_classifier.scores(docs, quality_classifier.fit(docs, read(spark, sf_dir, "labels")))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model score and base score of every document."""
    return suffix_tree.scores(read(spark, sf_dir, "documents"))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the text decoded from them."""
    docs = read(spark, sf_dir, "documents")
    decoded = bpe_codec.decode(bpe_codec.encode(docs, bpe_codec.frequent_lexicon(docs)))
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return quality_rules.judge(read(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length histogram of all documents with its sums."""
    return token_counts.histogram(token_counts.lengths(read(spark, sf_dir, "documents")))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, size and verdict of every document."""
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents")).drop("n_chars")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    pieces = packing.pack(read(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, shards of equal row counts."""
    assigned = sharding.interleave(read(spark, sf_dir, "documents"), shards=8)
    return assigned.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


#: A conversation that says the markers of a chat template itself.
_TRAP = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from its segments."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(_TRAP, "conv_id long, turn long, role string, text string"))
    return chat.read_back(chat.segments(turns))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component and verdict of every document."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents")).drop("mark")


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of every language."""
    return collocations.collocations(read(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text); every tenth document by crc32 of its id repeats from some word on, as the query's contract lays down."""
    word = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size("words")
    at = docs.select("doc_id", "text", h.alias("h"), F.when((h % 10 == 0) & F.col("text").isNotNull(), word).alias("words"))
    at = at.withColumn("a", F.when(n > 0, g % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    made = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", place(i).cast("int")))
    return at.select("doc_id", F.when(n > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document with planted runs: the longest, and digests of all and of the text without repeats."""
    found = periodic_runs.periodic_runs(with_planted_runs(read(spark, sf_dir, "documents")))
    by_length = F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("start"), (-r.period).alias("period")))
    found = found.withColumn("best", F.array_max(by_length))
    lines = F.transform("runs", lambda r: F.concat_ws("", F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    length, period = F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_lm_scores": op2_lm_scores,
    "op3_bpe_codec": op3_bpe_codec,
    "op4_quality_rules": op4_quality_rules,
    "op5_token_counts": op5_token_counts,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_packing": op7_packing,
    "op8_sharding": op8_sharding,
    "op9_chat_format": op9_chat_format,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_simhash_near_dedup": op11_simhash_near_dedup,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES = {
    "op4_quality_rules": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w
            FROM documents),
        p AS (
            SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(w[1:len(w) - 2]) AS x, unnest(w[2:len(w) - 1]) AS y,
                   unnest(w[3:len(w)]) AS z
            FROM d WHERE len(w) > 2),
        f AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x, y, z) AS n FROM p),
        r AS (
            SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
            FROM f, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY doc_id),
        l AS (
            SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines,
                   length(regexp_replace(t, '[^!?]', '', 'g')) AS marks,
                   length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_,
                   length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower_
            FROM d),
        b AS (
            SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[ \t-\r]+', '', 'g')) AS word_chars,
                   length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words, marks, upper_, lower_
            FROM d JOIN l USING (doc_id) LEFT JOIN r USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * n_words
                    OR 100 * marks > 20 * n_words OR 2 * upper_ > lower_ + upper_
                    OR word_chars < 2 * n_words OR word_chars > 15 * n_words
                    OR 100 * n_dup_lines > 50 * n_lines) AS kept
        FROM b""",
    "op6_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                   sha256(regexp_replace(coalesce(text, ''), '[ \t-\r]+', '', 'g')) AS text_sha256
            FROM documents),
        r AS (
            SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r""",
    "op9_chat_format": """
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
        m AS (
            SELECT list_sum(list_transform(
                       ['␛', '<|turn|>', '<|says|>', '<|end|>', '<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>',
                        '<</SYS>>', '<|im_start|>', '<|im_end|>'],
                       lambda c: (length(text) - length(replace(text, c, ''))) // length(c))) AS escapes,
                   lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before, *
            FROM t)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(24 + length(role) + length(text) + escapes) AS BIGINT) AS formatted_chars,
               count(*) FILTER (NOT list_contains(
                   CASE before WHEN 'system' THEN ['user'] WHEN 'user' THEN ['assistant'] WHEN 'assistant' THEN ['user', 'tool']
                               WHEN 'tool' THEN ['assistant', 'tool'] ELSE ['system', 'user'] END, role)) AS n_bad_turns
        FROM m GROUP BY conv_id""",
    "op12_phrase_mining": r"""
        WITH d AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[.,;:!?\n-\r]')) AS piece
            FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM d),
        one AS (SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM w) GROUP BY lang, x),
        two AS (
            SELECT lang, x, y, count(*) AS f
            FROM (SELECT lang, unnest(w[1:len(w) - 1]) AS x, unnest(w[2:len(w)]) AS y FROM w WHERE len(w) > 1)
            GROUP BY lang, x, y),
        three AS (
            SELECT lang, x, y, z, count(*) AS f
            FROM (SELECT lang, unnest(w[1:len(w) - 2]) AS x, unnest(w[2:len(w) - 1]) AS y, unnest(w[3:len(w)]) AS z
                  FROM w WHERE len(w) > 2)
            GROUP BY lang, x, y, z HAVING count(*) >= 10),
        cuts AS (
            SELECT t.lang, t.x || ' ' || t.y AS phrase, t.f AS a, 1 AS k, p.f AS l, q.f AS r
            FROM two t JOIN one p ON p.lang = t.lang AND p.x = t.x JOIN one q ON q.lang = t.lang AND q.x = t.y
            WHERE t.f >= 10 AND NOT EXISTS (
                SELECT 1 FROM three h WHERE h.lang = t.lang AND 100 * h.f >= 50 * t.f
                                        AND (h.x = t.x AND h.y = t.y OR h.y = t.x AND h.z = t.y))
            UNION ALL
            SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 1, p.f, q.f
            FROM three t JOIN one p ON p.lang = t.lang AND p.x = t.x JOIN two q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z
            UNION ALL
            SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 2, p.f, q.f
            FROM three t JOIN two p ON p.lang = t.lang AND p.x = t.x AND p.y = t.y JOIN one q ON q.lang = t.lang AND q.x = t.z),
        scored AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
        least AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least),
        sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY lang)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000""",
}
