"""The training-data operators against plain versions, on small frames with the awkward cases."""

import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from compare import compare, connect
from geomosaic.llm import (
    bpe_codec,
    bpe_words,
    chat,
    common,
    exact_dedup,
    fuse_filter,
    lexicon,
    minhash,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    suffix_tree,
    token_counts,
)

SF_DIR = "/root/testdata/sf0.001"
RNG = random.Random(3)
WORDS = ["the", "Sun", "rose", "over", "été", "grün", "<|endoftext|>", "it's", "12", "…", " ", "end.", "Σας", "💡"]
BASE = " ".join(RNG.choice("abcdefgh") + RNG.choice(["x", "yy", "zzz."]) for _ in range(120))
NEAR = BASE.replace("ax", "qq", 1)
LONG = " ".join(RNG.choice(WORDS) for _ in range(30_000))
TEXTS = [
    (1, BASE), (2, BASE), (3, NEAR), (4, BASE.replace(" ", "\t ", 3)), (5, None), (6, ""), (7, " \n\t"), (8, LONG),
    (9, "a b"), (9, "a b"), (10, "A B"), (None, "a b"), (None, None), (11, "same line here\n" * 40),
    (12, "<|endoftext|>x\n\n  y"), (13, "\x1c\x85  z ␛"), (14, "x" * 70_000), (15, "$$$ *** " * 60), (9, "c d e f g h"),
]
CLASH = "doc_id long, text string, lang string, source string, n_chars long, kept int, node string, row int, mark int, n int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, None if k % 5 else f"s{k % 2}", None, 1, "n", 2, 3, 4) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, CLASH).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i not in (11, 15)), None) for i in (1, 2, 3, 4, 8, 9, 11, 15)] + [(1, None, 0), (None, 1, 1), (1, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def applied(name, docs, labels):
    if name == "classifier":
        return quality_classifier.scores(docs, quality_classifier.fit(docs, labels))
    if name == "codec":
        return bpe_codec.decode(bpe_codec.encode(docs, bpe_codec.frequent_lexicon(docs, words=7)))
    run = {
        "lm": suffix_tree.scores, "rules": quality_rules.judge, "lengths": token_counts.lengths, "exact": exact_dedup.exact_duplicates,
        "pack": packing.pack, "shard": sharding.interleave, "near": minhash.near_duplicates,
    }
    return run[name](docs)


@pytest.mark.parametrize("name", ["classifier", "lm", "codec", "rules", "lengths", "exact", "shard", "near", "pack"])
def test_awkward_rows_all_come_back_and_empty_tables_give_none(docs, labels, name):
    found = applied(name, docs, labels).collect()
    ids = [r["doc_id"] for r in found if name != "pack" or r["start"] == 0]
    assert sorted(map(str, ids)) == sorted(str(i) for i, _ in TEXTS)
    assert applied(name, docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("name", ["quality_rules", "quality_classifier", "exact_dedup", "near_dedup"])
def test_stages_keep_all_columns_and_take_empty_tables(spark, docs, name):
    stage = getattr(corpus_pipeline, f"{name}_stage")
    kept = stage(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    if name == "exact_dedup":
        assert sorted((str(r.doc_id), r.text) for r in kept.collect() if r.doc_id in (1, 2, 4, 9)) == [
            ("4", BASE.replace(" ", "\t ", 3)), ("9", "a b"), ("9", "c d e f g h")
        ]
    if name == "near_dedup":
        assert {r.doc_id for r in kept.collect()} & {1, 2, 3, 4} == {1}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    size = min(5, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()


def roots(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), r) for i, r in roots(ids, links).items()}


def test_near_duplicates_equal_all_pairs(spark):
    rng = random.Random(5)
    texts = []
    for group in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 8, 40, 150]))]
        for _ in range(rng.randrange(1, 12)):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 20)):
                words[rng.randrange(len(words))] = f"z{rng.randrange(99)}"
            texts.append((len(texts) * 3 + group % 2, " ".join(words)))
    found = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_bitmaps_never_differ_in_more_bits_than_their_sets_in_shingles():
    rng = np.random.default_rng(5)
    for size in (0, 1, 4, 150, 5_000):
        common = rng.integers(0, 2**64, size, dtype=np.uint64)
        for own in (0, 1, 30):
            x, y = (np.unique(np.append(common, rng.integers(0, 2**64, own, dtype=np.uint64))) for _ in range(2))
            differ = sum(bin(int(a)).count("1") for a in (minhash.bitmap(x) ^ minhash.bitmap(y)).view(np.uint64))
            assert differ <= len(np.setxor1d(x, y))


def test_fuse_filter_knows_its_keys_and_few_others():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 1000, 30_000):
        keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        made = fuse_filter.build(keys)
        assert fuse_filter.contains(made, keys).all()
        assert fuse_filter.contains(made, rng.integers(0, 2**63, 20_000, dtype=np.uint64)).mean() < 0.01


def test_split_into_snapshot_and_batch_does_not_change_duplicates(docs):
    one = exact_dedup.exact_duplicates(docs, F.lit(False)).collect()
    two = exact_dedup.exact_duplicates(docs, F.coalesce(F.col("doc_id") % 2 == 0, F.lit(True))).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, two))


def test_lexicon_gives_the_ids_of_its_words_only(tmp_path):
    rng = random.Random(1)
    words = {bytes(rng.choices(b"abc", k=rng.randrange(1, 7))): [rng.randrange(9)] * rng.randrange(4) for _ in range(300)}
    path = tmp_path / "l"
    path.write_bytes(lexicon.compile_words(words))
    made = lexicon.Lexicon(str(path))
    others = [bytes(rng.choices(b"abcd", k=rng.randrange(0, 9))) for _ in range(300)]
    for word, place in zip(asked := [*words, *others], made.places(asked), strict=True):
        assert (place >= 0) == (word in words)
        if place >= 0:
            assert np.frombuffer(made.ids_of(place), np.uint32).tolist() == words[word]
    assert len(made.final) < sum(map(len, words))  # endings are shared


def test_codec_equals_the_library(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = applied("codec", docs, None).select("ids", "decoded").collect()
    expected = [tokenizer.encode(t or "", add_special_tokens=False).ids for _, t in TEXTS]
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in found) == sorted(expected)
    assert sorted(r.decoded for r in found) == sorted(tokenizer.decode(e, skip_special_tokens=False) for e in expected)


QUOTED = ["He said 'Hello.' and left", "'Hello,' she", "x.'s", "f(\"a')'s", "''ll !'re (it's) 'tis", "?!'d 1'2 \t'\n.'"]


def test_punctuation_before_apostrophes_is_cut_as_by_the_library(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(6)
    texts = QUOTED + ["".join(rng.choices("\"''''.,!?)( strevmlldx1\n", k=12)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    expected = {k: tokenizer.encode(t, add_special_tokens=False).ids for k, t in enumerate(texts)}
    encoded = bpe_codec.encode(docs, bpe_codec.frequent_lexicon(docs, words=50)).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in encoded} == expected
    lengths = {r.doc_id: r.length for r in token_counts.lengths(docs).collect()}
    assert lengths == {k: len(ids) for k, ids in expected.items()}


def test_lexicon_takes_the_most_frequent_pieces_without_sorting_all(spark):
    rng = random.Random(8)
    rows = [(f"p{k}", rng.choice([1, 1, 1, 2, 2, 3, 9])) for k in range(200)]
    counts = spark.createDataFrame(rows, "piece string, n long").repartition(3)
    for words in (0, 1, 30, 60, 199, 200, 500):
        got = sorted(map(tuple, bpe_codec.most_frequent(counts, words).collect()))
        assert got == sorted(sorted(rows, key=lambda r: (-r[1], r[0]))[:words])


def test_codec_holds_few_bytes_at_once(spark, monkeypatch):
    texts = ["ab " * k for k in (0, 50, 10, 400, 3, 20)]
    batch = pa.RecordBatch.from_pydict({"ids": [t.encode() for t in texts]})
    parts = [found for _, found in common.slices([batch], "ids", 200)]
    assert b"".join(sum(parts, [])) == "".join(texts).encode()
    assert all(len(p) == 1 or sum(map(len, p)) <= 200 for p in parts)
    monkeypatch.setattr(bpe_words, "Tokenizer", None)  # bytes of ids need no tokenizer
    assert b"".join(bpe_words.token_bytes.__wrapped__(bpe_codec.TOKENIZER)[i] for i in (39, 50256)) == b"H<|endoftext|>"


def test_histogram_answers_every_limit(spark):
    lengths = [0, 0, 3, 3, 7, 1024, 5000, 5001, 2048]
    made = token_counts.histogram(spark.createDataFrame([(n,) for n in lengths] + [(None,)], "length long"))
    for limit in (0, 1, 3, 4, 1024, 4999, 6000):
        assert token_counts.truncated_total(made, limit) == sum(min(n, limit) for n in lengths)
    assert token_counts.quantile(made, 0.5) == sorted(lengths)[4]
    assert made.where("length = 7").first()["docs_from"] == 5


def test_windows_cost_the_least(spark):
    rng = random.Random(4)
    for _ in range(30):
        cuts = np.cumsum([rng.randrange(1, 9) for _ in range(12)]).tolist()
        costs = [rng.choice([0, 3]) for _ in cuts]
        price = dict(zip(cuts, costs, strict=True))
        ends = packing.best_cuts(cuts, costs, True, size=16)
        best = {0: 0}
        for c in cuts:
            best[c] = min(best[b] + 16 - (c - b) + price[c] for b in best if c - b <= 16)
        assert sum(16 - (b - a) + price[b] for a, b in zip([0, *ends], ends, strict=False)) == best[cuts[-1]]


def test_a_worker_keeps_its_encoder_and_what_it_knows_changes_nothing():
    texts = [(t or "").encode() for _, t in TEXTS] + [b"", b" One. two! \x0b three? ", "\u200b. A\u0301b! x".encode()]
    kept = packing.encoder(packing.TOKENIZER)
    assert kept is packing.encoder(packing.TOKENIZER)
    first, again = kept(texts), kept(texts[::-1])[::-1]
    alone = [packing.Encoder(packing.TOKENIZER)([t])[0] for t in texts[-3:]]
    for (a, b), (c, d) in zip([*first, *first[-3:]], [*again, *alone], strict=True):
        assert a.tolist() == c.tolist() and b.tolist() == d.tolist() and b[-1] == len(a) and (np.diff(b) > 0).all()


def test_packing_holds_every_id_once(docs, monkeypatch):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for _, t in TEXTS]
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 9000)
    packer, got, sizes = packing.Packer(0), {}, {}
    encoded = packing.Encoder(packing.TOKENIZER)([(t or "").encode() for _, t in TEXTS])
    pieces = [p for k, (ids, stops) in enumerate(encoded) for p in packer.add(k, ids, stops)] + packer.flush(True)
    for doc, start, length, ids, whole, sequence, offset in pieces:
        assert start == len(got.setdefault(doc, [])) and offset == sizes.get(sequence, 0) and whole == len(expected[doc])
        got[doc] += np.frombuffer(ids, np.uint32).tolist()
        sizes[sequence] = offset + length
    assert [got[k] for k in range(len(TEXTS))] == expected
    assert max(sizes.values()) <= 4096
    spread = packing.pack(docs).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sum(r.n for r in spread) == sum(map(len, expected)) and max(r.n for r in spread) <= 4096


def test_every_shard_matches_the_mixture(spark):
    rows = [(k, "x" * (k % 7), f"s{0 if k % 3 == 0 else k % 5}") for k in range(1000)]
    found = sharding.interleave(spark.createDataFrame(rows, "doc_id long, text string, source string"), 8).collect()
    source, shares = {k: s for k, _, s in rows}, {}
    for r in found:
        assert r.size == r.doc_id % 7 + 1 and r.text_crc32 == zlib.crc32(b"x" * (r.doc_id % 7))
        shares.setdefault(r.shard, []).append(r)
    assert sorted(map(len, shares.values())) == [125] * 8
    for rows_of in shares.values():
        assert sorted(r.slot for r in rows_of) == list(range(125))
    for s in set(source.values()):
        counts = [sum(source[r.doc_id] == s for r in rows_of) for rows_of in shares.values()]
        assert max(counts) - min(counts) <= 2


def test_chat_escapes_come_back_and_order_is_checked(spark):
    said = ["<|end|>\n", "␛", "a␛␛<|turn|>", "<<|says|>", "[INST][/INST]", "", None, "<|turn|>user<|says|>x<|end|>\n"]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(said)]
    rows += [(2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (2, None, None, None), (None, 1, "user", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("loss", F.lit(1))
    found = {r.conv_id: r for r in chat.read_back(chat.segments(turns)).collect()}
    loss = "".join(t or "" for k, t in enumerate(said) if k % 2)
    assert found[1].n_turns == len(said) and found[1].n_bad_turns == 0 and found[1].loss_chars == len(loss)
    assert found[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    whole = "".join(f"{'assistant' if k % 2 else 'user'}\n{t or ''}\n" for k, t in enumerate(said))
    assert found[1].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
    assert found[2].n_turns == 3 and found[2].n_bad_turns == 3 and found[None].n_turns == 1
    assert chat.read_back(chat.segments(turns.limit(0))).count() == 0


def test_isotonic_means_rise():
    _, values = quality_classifier.isotonic(np.arange(6.0), np.array([0, 3, 1, 2, 5, 4.0]), np.array([2, 3, 2, 2, 5, 5.0]))
    assert (np.diff(values) >= 0).all() and len(values) % 2 == 0


def test_classifier_tells_held_out_documents(spark):
    found = entry.queries()["op1_quality_classifier"](spark, "/root/testdata/sf0.01")
    known = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    right = found.where("held_out").join(known, "doc_id").select((F.col("predicted") == F.col("quality")).cast("int").alias("r"))
    assert right.agg(F.avg("r")).first()[0] > 0.95


def test_rules_order_changes_no_verdict():
    rules = quality_rules.RULES
    assert quality_rules.by_rejection_per_cost([1.0, 1.0, 0.1], [1, 5, 1]) == [2, 1, 0]
    docs = [quality_rules.Doc((t or "").encode(), quality_rules.WordHash()) for _, t in TEXTS] * 3
    cascade = quality_rules.Cascade(rules, sample=5)
    assert [cascade.keeps(d) for d in docs] == [not any(r.rejects(d) for r in rules) for d in docs]


def test_suffix_tree_scores(spark):
    found = suffix_tree.scores(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    words = {i: suffix_tree.tokens((t or "").encode()) for i, t in texts.items()}
    counts = {}
    for i, ws in words.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for w in ws:
                counts[w] = counts.get(w, 0) + 1
    size = sum(counts.values()) + len(counts) + 1
    for r in found:
        base = sum(math.log10((counts.get(w, 0) + 1) / size) for w in words[r.doc_id])
        assert r.base_score == pytest.approx(base) and r.n_known == sum(w in counts for w in words[r.doc_id])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_next_symbol_probabilities_add_up(spark):
    training = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    words = suffix_tree.vocabulary(suffix_tree.word_counts(training))
    tree = suffix_tree.grow(training, words)
    symbols = np.arange(len(words.symbol_counts))
    assert any((w < 1).any() for w in tree.weights)
    for before in ([0, 0], [5, 0], [int(tree.contexts[0][-1]), 3]):
        history = [np.full(len(symbols), b) for b in before]
        assert tree.probability(symbols, history).sum() == pytest.approx(1.0)


def test_tree_learns_longer_contexts_and_rare_words_of_a_large_corpus(spark):
    rng = random.Random(8)
    phrases = ["a0 b c e0", "a1 b c e1", "q c z"]  # the word after c depends on the last one, two and three
    texts = [" ".join(rng.choices(phrases, k=40)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    words = suffix_tree.vocabulary(suffix_tree.word_counts(docs))
    tree = suffix_tree.grow(docs, words)
    at = lambda word: np.flatnonzero(words.symbols == suffix_tree.hashes_of([word])[0]) + 2
    a0, a1, b, c, e0, e1 = map(at, [b"a0", b"a1", b"b", b"c", b"e0", b"e1"])
    for first, mine, other in ((a0, e0, e1), (a1, e1, e0)):
        assert tree.probability(mine, [c, b, first]) > 0.9 > 0.1 > tree.probability(other, [c, b, first])
    # the same counts mean the same among a thousand times as many other tokens
    counts = spark.createDataFrame([(1, b"aa", 9_000_000), (2, b"bb", 50), (3, b"cc", 3)], "word long, ending binary, n long")
    assert suffix_tree.vocabulary(counts).symbols.tolist() == [1, 2]


def test_what_was_sent_to_tasks_leaves_the_disk(spark):
    place = spark.sparkContext._temp_dir
    docs = spark.createDataFrame([(k, "a b c a b d " * 9) for k in range(20)], "doc_id long, text string")
    before = set(os.listdir(place))
    assert suffix_tree.scores(docs).count() == 20
    assert set(os.listdir(place)) <= before


def test_parts_of_texts_lose_no_entry(spark, monkeypatch):
    rng = random.Random(10)
    # the last word depends on the first, up to nine tokens before
    phrases = [" ".join([f"s{k}{v}", *(f"f{k}{j}" for j in range(k)), f"e{k}{v}"]) for k in range(9) for v in "ab"]
    texts = [" ".join(x for p in rng.choices(phrases, k=30) for x in (p, str(rng.randrange(10**6)))) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    words = suffix_tree.vocabulary(suffix_tree.word_counts(docs))
    kept, parts_of = [], suffix_tree.parts_of

    def watched(symbols, depth, repeated):
        parts = parts_of(symbols, depth, repeated)
        kept.append(parts.selectExpr("sum(length(symbols)) / 4").first()[0])
        return parts

    monkeypatch.setattr(suffix_tree, "parts_of", watched)
    tree = suffix_tree.grow(docs, words)
    monkeypatch.setattr(suffix_tree, "parts_of", lambda symbols, *_: symbols)
    whole = suffix_tree.grow(docs, words)
    assert len(tree.contexts) == len(whole.contexts) >= 9
    for name in ("contexts", "weights", "entries", "shares"):
        assert all(map(np.array_equal, getattr(tree, name), getattr(whole, name)))
    assert len(kept) >= 3 and kept == sorted(kept, reverse=True) and kept[-1] < words.symbol_counts.sum() / 2


def test_states_are_those_of_a_plain_count(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choices("abcd", [8, 4, 2, 1], k=rng.randrange(30))) + " a b b c" * (k % 3) for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    words = suffix_tree.vocabulary(suffix_tree.word_counts(docs))
    tree = suffix_tree.grow(docs, words)
    lines = [[0] * 9 + (np.searchsorted(words.symbols, suffix_tree.hashes_of(suffix_tree.tokens(t.encode()))) + 2).tolist() for t in texts]
    total, states = sum(len(x) - 9 for x in lines), {}

    def plain(symbol, history):
        p = tree.root[symbol]
        for size in range(1, len(history) + 1):
            if history[:size] in states:
                own, whole = states[history[:size]]
                kept = {s: n for s, n in own.items() if n > 1}
                p = (kept.get(symbol, 0) + (whole - sum(kept.values()) + 20) * p) / (whole + 20)
        return p

    for size in range(1, 9):
        counts = {}
        for x in lines:
            for k in range(9, len(x)):
                if size <= k - 8:  # what is longer than the text adds nothing
                    own = counts.setdefault(tuple(x[k - size : k][::-1]), {})
                    own[x[k]] = own.get(x[k], 0) + 1
        new = {}
        for history, own in counts.items():
            whole, kept = sum(own.values()), {s: n for s, n in own.items() if n > 1}
            gain = sum(n * math.log(n / whole / plain(s, history[:-1])) for s, n in kept.items())
            if whole >= 5 and gain > 0.5 * len(kept) * math.log(total):
                new[history] = own, whole
        states |= new
        assert len(new) == (len(tree.contexts[size - 1]) if size <= len(tree.contexts) else 0)
        if not new:
            break
    assert size > 2
    for x in lines:
        for k in range(9, len(x)):
            history = tuple(x[k - 8 : k][::-1])
            assert tree.probability(np.array([x[k]]), [np.array([h]) for h in history]) == pytest.approx(plain(x[k], history))


def test_pipeline_equals_its_plain_version(spark):
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    cache = quality_rules.WordHash()
    good = [d for d in docs if not any(r.rejects(quality_rules.Doc(d.text.encode(), cache)) for r in quality_rules.RULES)]
    frame = spark.createDataFrame(good, docs[0].__fields__)
    model = quality_classifier.fit(frame, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    kept = [d for d in good if model.score(quality_classifier.statistics(d.text.encode())[None])[0] >= 0.3]
    bare = {}
    for d in sorted(kept, key=lambda d: (-len(d.text), d.doc_id)):
        bare.setdefault(re.sub(r"[ \t-\r]+", "", d.text), d)
    parts = brute_components([(d.doc_id, d.text) for d in bare.values()])
    assert {r.doc_id for r in found} == {i for i, (_, root) in parts.items() if i == root}


@pytest.mark.parametrize("name", ["op4_quality_rules", "op6_exact_dedup", "op9_chat_format"])
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), entry.queries()[name], entry.oracle_sql()[name], SF_DIR) == []


def test_sharding_runs_no_python(spark):
    plan = entry.queries()["op8_sharding"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
