"""Classifiers, decontamination and the pipeline on small tables."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from rosterweave.llm import common, decontaminate, quality, toxicity
from rosterweave.llm.samples import labelled_sample, remainder
from rosterweave.plans.staging import Stage

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_hits(docs, items, width):
    windows = {}
    for item, text in items:
        w = split(text)
        n = min(len(w), width)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, names = split(text), set(), set()
        for key, ids in windows.items():
            for i in range(len(w) - len(key) + 1):
                if tuple(w[i : i + len(key)]) == key:
                    hit.update(range(i, i + len(key)))
                    names |= {str(x) for x in ids if x is not None}
        out.append((doc, len(w), len(hit), sorted(names), bool(hit)))
    return out


def test_contamination_equals_brute_force(spark, stage):
    rnd = random.Random(7)
    words = ["a", "b", "The", "x1", "Éa", "é", "ab"]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 9)))) for i in range(12)]
    items += [(3, "b-b.b"), (None, "the x1"), (50, None), (51, " .. "), (10, "only")]
    docs = [(i % 30, " ".join(rnd.choice(words) + rnd.choice([" ", ". ", "\n"]) for _ in range(rnd.randint(0, 40))))
            for i in range(33)]
    docs += [(None, "the x1 the"), (40, None), (41, ""), (42, "a " * 600), (0, docs[0][1])]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, row int").repartition(3)
    found = decontaminate.contamination(df, spark.createDataFrame(items, "item_id long, text string"), stage, 4)
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in found.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_hits(docs, items, 4)))


def test_contamination_without_rows(spark, tmp_path):
    stage, other = Stage(spark, str(tmp_path / "a")), Stage(spark, str(tmp_path / "b"))
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.contamination(docs, items, stage).collect()] == [0]
    none = decontaminate.contamination(docs.where("false"), items, other)
    assert none.count() == 0


def test_proximity_allows_words_near_their_place(spark, stage):
    docs = spark.createDataFrame([(1, "big x red dog"), (2, "big x y z red dog"), (3, "big red dog")], "doc_id long, text string")
    windows = spark.createDataFrame([("big red dog", ["big", "red", "dog"])], "window string, terms array<string>")
    index = decontaminate.build_index(docs, windows.select(F.explode("terms").alias("term")), stage)
    near = decontaminate.phrase_matches(index, windows, stage, slack=1)
    found = near.join(index.documents, "row").select("doc_id").distinct().collect()
    assert sorted(r.doc_id for r in found) == [1, 3]


def test_main_path_is_free_of_python(spark, stage):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    plan = decontaminate.contamination(docs, items, stage)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def made(n, seed=0):
    """Documents of ordinary words; every fourth toxic, every third of bad quality."""
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choice(["th", "er", "on", "an", "in"]) for _ in range(rnd.randint(1, 4))) for _ in range(60)]
        toxic, bad = i % 4 == 0, i % 3 == 0
        if toxic:
            for _ in range(6):
                words[rnd.randrange(60)] = rnd.choice(["idiot", "worthless", "pathetic"])
        text = "!! ".join(w.upper() for w in words) if bad else " ".join(words) + "."
        rows.append((i, text))
        labels.append((i, int(not bad), int(toxic)))
    return rows, labels


def test_classifiers_on_held_out_rows(spark, tmp_path):
    rows, labels = made(400)
    rows += [(900, None), (901, ""), (902, "x" * 20000), (None, "th er"), (3, rows[3][1])]
    docs = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, score double")
    table = spark.createDataFrame([*labels, (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    forest = quality.train(docs, table.select("doc_id", F.col("quality").alias("label")), Stage(spark, str(tmp_path / "q")))
    model = toxicity.train(docs, table.select("doc_id", F.col("toxic").alias("label")), Stage(spark, str(tmp_path / "t")))
    good = {r.doc_id: r.score for r in quality.scored(docs, forest, ["doc_id"]).collect()}
    bad = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert len(good) == len(bad) == 404 and all(0 <= s <= 1 for s in [*good.values(), *bad.values()])
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(good[i] >= quality.CUT) == (i % 3 != 0) for i in held]) > 0.95
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(bad[i] >= toxicity.CUT) == (i % 4 == 0) for i in held]) > 0.9


@pytest.mark.parametrize("labels", [[], [(1, 1)]])
def test_too_few_labels_give_one_score(spark, stage, labels):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, label int")
    forest = quality.train(docs, table, stage)
    assert len({r.score for r in quality.scored(docs, forest, ["doc_id"]).collect()}) == 1


def test_toxicity_with_too_few_labels(spark, stage):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, label int"), stage)
    assert {round(r.score, 3) for r in toxicity.scored(docs, model).collect()} == {0.018}
    assert toxicity.scored(docs.where("false"), model).count() == 0


def test_distances_and_features_equal_their_definition():
    rng = np.random.default_rng(2)
    made_up = [" ".join("".join(rng.choice(["th", "er", "on"], 3)) for _ in range(70)) for _ in range(60)]
    labels = [int(i % 3 == 0) for i in range(60)]
    texts = [t + " Worthless idiots" if y else t for t, y in zip(made_up, labels)]
    dictionaries = toxicity.train_dictionaries(texts, labels)
    for text, got in zip(["", None, "One", texts[0]], dictionaries.features(["", None, "One", texts[0]])):
        want = []
        for width in toxicity.WIDTHS:
            split = [w[:5].upper() + w[5:] for w in (text or "").lower().split()]
            saved = []
            for i in range(0, len(split), width):
                size = []
                for content in (dictionaries.ordinary, dictionaries.toxic + dictionaries.ordinary):
                    data = zstandard.ZstdCompressionDict(content, zstandard.DICT_TYPE_RAWCONTENT)
                    one = zstandard.ZstdCompressor(
                        toxicity.LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
                    )
                    size.append(len(one.compress(" ".join(split[i : i + width]).encode())))
                saved.append(size[0] - size[1])
            top = sorted(saved, reverse=True)
            counted = top or [0]
            want += [counted[0], sum(counted[:3]) / len(counted[:3]), 10 * sum(max(x, 0) for x in counted) / len(counted)]
            want += [10 * sum(counted) / len(counted)]
            want += [math.log1p(sum(x >= k for x in counted)) for k in toxicity.THRESHOLDS]
            want += [math.log1p(len(counted))]
        assert np.allclose(got, want)


def test_sampled_characters_are_bounded(spark, tmp_path, monkeypatch):
    rows, labels = made(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame([(i, t) for i, _, t in labels], "doc_id long, label int")
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 5_000)
    stage = Stage(spark, str(tmp_path / "c"))
    model = toxicity.train(docs, table, stage)
    taken = spark.read.parquet(f"{stage.folder}/taken")
    assert 4_000 < taken.agg(F.sum(F.length("text"))).first()[0] <= 5_000
    assert toxicity.scored(docs, model).count() == 200


def test_sample_is_bounded_and_learns_no_held_out_row(spark, stage):
    rows, labels = made(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame([(i, t) for i, _, t in labels], "doc_id long, label int")
    taken = labelled_sample(docs, table, remainder("doc_id", 3) != 1, {0: 20, 1: 5}, stage).collect()
    assert [sum(r.label == v for r in taken) for v in (0, 1)] == [20, 5]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in taken)


def overlapping(n, share, rude, seed):
    """Texts whose number of rude words and marks leans on the label, without telling it surely."""
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        one = rng.random() < share
        words = ["".join(rng.choice(["th", "er", "on", "an", "in"], 3)) for _ in range(40)]
        for at in rng.integers(0, 40, rng.poisson(2.6 if one else rude)):
            words[at] = str(rng.choice(["idiot!", "worthless!", "pathetic!"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(one)))
    return rows, labels


def test_capped_and_uncapped_fits_decide_alike(spark, tmp_path, monkeypatch):
    rows, labels = overlapping(2500, 0.85, 0.6, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, label int")
    chosen = []
    for name, most in (("all", quality.SAMPLE), ("capped", {0: 6000, 1: 250})):
        monkeypatch.setattr(quality, "SAMPLE", most)
        forest = quality.train(docs, table, Stage(spark, str(tmp_path / name)))
        scores = quality.scored(docs, forest, ["doc_id"]).where(F.col("score") >= quality.CUT)
        chosen.append({r.doc_id for r in scores.collect()})
    assert len(chosen[0] ^ chosen[1]) < 0.1 * len(rows)


def test_toxicity_of_a_capped_sample_cuts_where_the_whole_does(spark, stage, monkeypatch):
    rng = np.random.default_rng(1)
    y = (rng.random(20_000) < 0.12).astype(float)
    x = rng.normal(size=(len(y), 1)) + 1.5 * y[:, None]
    whole = toxicity.fit(None, x, y)
    taken = (y == 1) | (rng.random(len(y)) < 0.05)
    weight = np.where(y[taken] == 1, 1.0, (y == 0).sum() / (y[taken] == 0).sum())
    capped = toxicity.fit(None, x[taken], y[taken], weight)
    share = [(m.calibrated(x) >= toxicity.CUT).mean() for m in (whole, capped)]
    assert abs(share[0] - share[1]) < 0.04
    rows, labels = made(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame([(i, t) for i, _, t in labels], "doc_id long, label int")
    got = labelled_sample(docs, table, F.lit(True), {0: 30, 1: 500}, stage).groupBy("label").agg(F.max("weight"))
    assert dict(got.collect()) == {0: 5.0, 1: 1.0}


def test_trees_walk_as_their_arrays_say():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, len(quality.STATISTICS)))
    y = (x[:, 0] + x[:, 1] > 0).astype(float)
    forest = quality.fit(x, y)
    want = []
    for row in x:
        total = forest.start
        for f, t, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            total += leaf[node - len(f)]
        want.append(1 / (1 + np.exp(-total)))
    assert np.allclose(forest.score(x), want)
    assert np.mean((forest.score(x) > 0.5) == y) > 0.9


def test_pipeline_stages(spark, tmp_path):
    rows, labels = made(240, seed=3)
    line = " ".join(f"w{i}" for i in range(60))
    rows += [(500, rows[1][1]), (501, "one two three " + line), (502, line + " four five six")]
    rows += [(503, "th er bench " + "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 q11 an"), (504, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), i) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, score long")
    folder = str(tmp_path / "sf")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 q11")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    kept = [docs]
    for n, (_, step) in enumerate(corpus_pipeline.STAGES):
        made_ = step(spark, kept[-1], folder)
        assert made_.columns[: len(docs.columns)] == docs.columns
        made_.write.parquet(f"{folder}/{n}")
        kept.append(spark.read.parquet(f"{folder}/{n}"))
    ids = [{r.doc_id for r in k.collect()} for k in kept]
    assert not {i for i in range(0, 240, 3)} & ids[1]
    assert 1 in ids[2] and 500 not in ids[2]
    texts = {r.doc_id: (r.text, r.n_chars) for r in kept[3].collect()}
    if 501 in texts and 502 in texts:
        assert texts[501] == ("one two three", 13) and texts[502] == ("four five six", 13)
    assert 503 not in ids[4] and ids[5] == ids[4]
    assert corpus_pipeline.run(spark, folder).count() == len(ids[5])


def test_pipeline_of_no_documents(spark, tmp_path):
    folder = str(tmp_path / "sf")
    docs = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], docs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_a_scored_text_travels_once_and_in_slices(spark, monkeypatch):
    sent, sizes = [], []
    measure, map_arrow = quality._table, quality.map_arrow

    def sending(df, function, schema):
        sent.append(df.columns)
        batch = pa.RecordBatch.from_pydict({c: [f"a {i}" for i in range(2_500)] for c in df.columns})
        for made in function([batch]):
            sizes.append(len(made))
        return map_arrow(df, function, schema)

    monkeypatch.setattr(quality, "map_arrow", sending)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    forest = quality.fit(np.zeros((0, len(quality.STATISTICS))), np.zeros(0))
    both = quality.scored(docs, forest, ["text", "doc_id"])
    assert both.columns == ["text", "doc_id", "score"]
    assert sorted((r.doc_id, r.text, r.score) for r in both.collect()) == [(1, "a b", 0.5), (2, None, 0.5)]
    assert quality.scored(docs, forest, ["doc_id"]).columns == ["doc_id", "score"]
    assert [len(columns) for columns in sent] == [2, 2]
    assert sizes == [1_000, 1_000, 500] * 2


def test_what_a_worker_keeps_goes_with_the_operator():
    made = []
    get = common.kept(lambda x: made.append(x) or [x])
    common.begin_task("one")
    assert get(1) is get(1) and made == [1]
    common.begin_task("one")
    assert get(1) and made == [1]
    common.begin_task("two")
    assert get(1) and made == [1, 1]
