"""Byte-level BPE encoding and decoding by a lexicon of frequent words.

Pieces are counted over all documents; the most frequent ``LEXICON_WORDS`` are compiled with
their ids into a minimal acyclic transducer (``lexicon``), a file in the shared folder that
every executor fetches once and its workers map into memory. A piece that the lexicon lacks is merged
exactly by the tokenizer's own rules. The lexicon changes the time, never an id.
"""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pyarrow as pa
from pyspark import SparkFiles, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomosaic.llm.bpe_words import Remembered, byte_tokenizer, token_bytes
from geomosaic.llm.common import slices
from geomosaic.llm.lexicon import Lexicon, compile_words
from geomosaic.session import work_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LEXICON_WORDS = 50_000
#: Distinct pieces that a task counts before it passes its counts on.
_COUNTED = 200_000
#: Text or id bytes that a worker has in pieces at once: a piece costs many times its bytes.
_CUT_BYTES = 1 << 20


def piece_counts(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(piece, n) over all texts; added tokens are left out."""

    def run(batches):
        tokenizer, counts = byte_tokenizer(path), Counter()

        def counted():
            known = [(p, n) for p, n in counts.items() if isinstance(p, str)]
            return pa.RecordBatch.from_pydict({"piece": [p for p, _ in known], "n": [n for _, n in known]}, _COUNTS)

        for _, texts in slices(batches, "text", _CUT_BYTES):
            for text in texts:
                counts.update(tokenizer.cut(text.decode()))
            if len(counts) > _COUNTED:
                yield counted()
                counts.clear()
        yield counted()

    parts = docs.select("text").mapInArrow(run, "piece string, n long")
    return parts.groupBy("piece").agg(F.sum("n").alias("n"))


_COUNTS = pa.schema([("piece", pa.string()), ("n", pa.int64())])


def most_frequent(counts: DataFrame, words: int) -> DataFrame:
    """The first ``words`` rows of kept ``counts`` by descending n, then piece; rows behind them leave no task but for ties.

    How many pieces share a count is known first, a row per count, so the count of the last one taken is known.
    """
    above, least = 0, None
    for r in sorted(counts.groupBy("n").agg(F.count("*").alias("pieces")).collect(), reverse=True):
        if above + r["pieces"] > words:
            least = r["n"]
            break
        above += r["pieces"]
    if least is None:
        return counts
    ties = counts.where(F.col("n") == least).orderBy("piece").limit(words - above)
    return counts.where(F.col("n") > least).unionByName(ties)


def frequent_lexicon(docs: DataFrame, path: str = TOKENIZER, words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent pieces; the name under which executors find the file."""
    spark = docs.sparkSession
    counts = piece_counts(docs, path).persist(StorageLevel.DISK_ONLY)
    rows = most_frequent(counts, words).collect()
    counts.unpersist()
    tokenizer = byte_tokenizer(path)
    made = compile_words({r["piece"].encode(): memoryview(tokenizer.merge(r["piece"])).cast("I").tolist() for r in rows})
    place = work_path(spark, "lexicon")
    _write(spark, place, made)
    spark.sparkContext.addFile(place)
    return place.rsplit("/", 1)[1]


def _write(spark: SparkSession, place: str, content: bytes) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(place)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.write(content)
    out.close()


def encode(docs: DataFrame, lexicon: str, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens, ids) of each row; ids are unsigned 32-bit integers,
    little-endian as the machines are.

    Null text counts as empty and has no ids. Rows are encoded one by one, so repeated rows, null ids and
    empty tables need no care. Other columns of ``docs`` (doc_id, text, ...) are ignored.
    """

    def run(batches):
        tokenizer, known = byte_tokenizer(path), Lexicon(SparkFiles.get(lexicon))

        def ids_of(pieces):
            places = known.places([p.encode() if isinstance(p, str) else b"" for p in pieces]).tolist()
            return [known.ids_of(k) if k >= 0 else tokenizer.merge(p) for p, k in zip(pieces, places, strict=True)]

        remembered = Remembered(ids_of)
        for part, texts in slices(batches, "text", _CUT_BYTES):
            cuts = [tokenizer.cut(t.decode()) for t in texts]
            remembered.learn(cuts)
            ids = [b"".join(map(remembered.__getitem__, c)) for c in cuts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "ids"],
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """``encoded`` (ids, ...) with a column ``decoded``, added tokens included; broken UTF-8 is replaced as usual."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches):
        bytes_of = token_bytes(path).__getitem__
        for part, ids in slices(batches, "ids", _CUT_BYTES):
            texts = [b"".join(map(bytes_of, memoryview(i).cast("I"))).decode("utf-8", "replace") for i in ids]
            yield part.append_column("decoded", pa.array(texts, pa.string()))

    return encoded.mapInArrow(run, schema)
