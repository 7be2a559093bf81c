"""Byte pair encoding, token files and unigram counts against the tokenizers library."""

import glob
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from rosterweave.llm import bpe, token_counts, token_files
from rosterweave.plans.staging import Stage

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PATH = public_tokenizers.path(bpe.VOCABULARY)
FIXED = [
    "", " ", "  ", "a  b", "\n\n a", "a \n", "it's we'll 'x ''s", "a<|endoftext|>b  <|endoftext|> c<|end",
    "x" * 20000, "ab" * 9000 + " " * 9000 + "é" * 7000, " " * 9000, "9" * 9000 + "a",
    "\t\t\tx\r\n y\x85z\xa0 w　　q", "!" * 5000 + "'s", "a\x00b c\x00", "\x1c\x1d a\x1fb",
    "日本語テキスト" * 1500, "a" * 4093 + "'ll b", "thetheingtion" * 2000, "<|endoftext|" * 600,
]


def samples():
    rnd = random.Random(1)
    alphabets = ["ab ", "the ing'sl ", "  \n\tx", "é日a1 !", "aA1!́²Ⅷ ", "<|endoftext|> "]
    made = ["".join(rnd.choice(a) for _ in range(n)) for n in (5, 50, 500, 5000, 30000) for a in alphabets]
    return FIXED + made


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    merges = bpe.merges_at(PATH)
    return bpe.Encoder(merges, bpe.Pieces(merges))


def test_encodes_and_decodes_as_the_library(library, encoder):
    decoder = bpe.Decoder(encoder.merges)
    for text in samples():
        want = library.encode(text, add_special_tokens=False).ids
        got = encoder.encode(text)
        assert got.tolist() == want
        assert decoder.decode(got) == library.decode(want, skip_special_tokens=False) == text


def test_parts_of_any_size_give_the_same_ids(library, encoder):
    rnd = random.Random(2)
    for text in samples():
        out, i = [], 0
        while i < len(text):
            n = rnd.choice([1, 3, 7, 1000, 5000])
            out.append(encoder.feed(text[i : i + n]))
            i += n
        out.append(encoder.finish())
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(b"".join(out), "<u4").tolist() == want


def test_state_stays_small(encoder):
    for part in ("a" * 1000, "<", " ", "1"):
        for _ in range(200):
            encoder.feed(part)
            held = len(encoder.text) + len(encoder.run.held if encoder.run else b"")
            assert held < 2 * bpe._LONG + 4 * encoder.merges.lookahead + 2000
        encoder.finish()



def test_lookahead_of_a_chain_of_merges():
    # c joins d, or b joins c first: what follows "abc" decides about "ab".
    assert bpe.lookahead([(b"c", b"d"), (b"b", b"c"), (b"a", b"b")]) == 3


def test_decoding_broken_bytes_as_the_library(library):
    rnd = random.Random(4)
    decoder = bpe.Decoder(bpe.merges_at(PATH))
    for _ in range(200):
        ids = [rnd.randrange(50257) for _ in range(40)]
        assert decoder.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_encoded_frame(spark, library):
    rows = [(1, "the end", 5), (None, None, 6), (1, "the end", 5), (2, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, c0 int")
    got = bpe.encoded(docs, ["doc_id", "c0", "text"], decode=True).collect()
    want = library.encode("the end", add_special_tokens=False).ids
    assert [r.ids for r in got] == [want, [], want, []]
    assert [r.decoded for r in got] == ["the end", "", "the end", ""]
    assert [r.c0 for r in got] == [5, 6, 5, 7]
    assert bpe.encoded(docs.where("false"), ["doc_id"]).count() == 0


def test_token_files(spark, stage, library):
    rows = [(3 * i % 101, t, i) for i, t in enumerate([*samples(), None])]
    rows += [(None, "null id", 0), (None, None, 1), (3, rows[1][1], 1), (3, rows[1][1], 1)]
    rows += [(50, f"one id, text {i}", i) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place int").repartition(5)
    path = f"{stage.folder}/tokens"
    token_files.write_token_files(docs, path)
    got = sorted(token_files.summary(spark, path, stage).collect(), key=lambda r: r.start)
    want = []
    for doc_id, text, _ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((str(doc_id), len(ids), zlib.crc32(ids.tobytes())))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]


def test_files_are_in_the_order_of_their_numbers(spark, tmp_path):
    for number, doc_id in ((99_999, 1), (100_000, 2), (7, 0)):
        one = spark.createDataFrame([(doc_id, 0, [5, 0])], "doc_id long, place long, ids array<int>")
        one.coalesce(1).write.orc(f"{tmp_path}/{number}")
        (file,) = (tmp_path / str(number)).glob("*.orc")
        (tmp_path / "all").mkdir(exist_ok=True)
        (tmp_path / "all" / file.name.replace("part-00000-", f"part-{number:05}-")).write_bytes(file.read_bytes())
    got = token_files.summary(spark, f"{tmp_path}/all", Stage(spark, str(tmp_path))).collect()
    assert sorted((r.doc_id, r.start) for r in got) == [(0, 0), (1, 2), (2, 4)]


def test_a_lookup_skips_row_groups_and_files(spark, stage):
    path = f"{stage.folder}/tokens"
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        token_files.write_token_files(docs, path)
    finally:
        spark.conf.set(setting, "true")
    found = token_files.tokens_of(spark, path, [31_234, 31_235])
    assert [(r.doc_id, list(r.ids)) for r in found.orderBy("doc_id").collect()] == [
        (i, [64, 0]) for i in (31_234, 31_235)
    ]
    one = token_files.tokens_of(spark, path, [31_234])
    assert len(one.collect()) == 1
    plan = one._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [In(doc_id" in plan.toString() or "EqualTo(doc_id,31234)" in plan.toString()
    scans = plan.collectLeaves()
    assert 0 < scans.head().metrics().apply("numOutputRows").value() <= 20_000


def test_a_file_of_several_stripes_is_read_by_several_tasks(spark, stage):
    from pyarrow import orc

    path = f"{stage.folder}/tokens"
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: F.hash("id", i).cast("string")), " ")
    docs = spark.range(48_000).select(F.col("id").alias("doc_id"), text.alias("text"))
    before = {"spark.sql.files.maxPartitionBytes": "200000", "spark.sql.files.openCostInBytes": "1000"}
    spark.conf.set("orc.stripe.size", "100000")
    old = {k: spark.conf.get(k) for k in before}
    try:
        for k, v in before.items():
            spark.conf.set(k, v)
        token_files.write_token_files(docs.coalesce(1), path)
        stored = token_files.read_token_files(spark, path)
        files = glob.glob(f"{path}/*.orc")
        assert max(orc.ORCFile(f).nstripes for f in files) > 1
        assert stored.rdd.getNumPartitions() > len(files)
        assert stored.count() == 48_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        spark.conf.unset("orc.stripe.size")


def test_pieces_of_two_generations(library, monkeypatch):
    monkeypatch.setattr(bpe, "_CACHED", 7)
    encoder = bpe.Encoder(bpe.merges_at(PATH), bpe.Pieces(bpe.merges_at(PATH)))
    for text in ["to be, or not to be. that; is the: question! or? ", *samples()[:12]] * 2:
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.cached) <= 7 and len(encoder.cached.older) <= 7


def test_token_files_of_nothing(spark, stage):
    path = f"{stage.folder}/tokens"
    token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"), path)
    assert token_files.summary(spark, path, stage).count() == 0


def test_counts_equal_the_library():
    path = public_tokenizers.path(token_counts.VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    vocabulary = token_counts.Vocabulary(path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    scores = [(p, -vocabulary.cost.get(p, 1e8) / 1e6) for p in pieces]
    library = Tokenizer(models.Unigram(scores, unk_id=0, byte_fallback=True))
    rnd = random.Random(5)
    tokens = {"▁" + "".join(rnd.choice("etaoinshré日😀.") for _ in range(rnd.randint(0, 12))) for _ in range(3000)}
    tokens |= {"▁" + "x" * 300, "▁the", "▁their", "▁them"}
    got = dict(vocabulary.counts(tokens))
    assert {t: len(library.encode(t, add_special_tokens=False).ids) for t in tokens} == got


def test_counts_frame(spark):
    rows = [(1, "the end　the"), (None, None), (1, "the end　the"), (2, " \n")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_tokens int")
    got = [tuple(r) for r in token_counts.token_counts(docs).collect()]
    assert got == [(1, 3, 3), (None, 0, 0), (1, 3, 3), (2, 0, 0)]
    assert token_counts.token_counts(docs.where("false")).count() == 0
