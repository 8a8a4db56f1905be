"""The pipeline's row-dropping stages against plain versions, with null and repeated ids."""

import math
import random
import zlib
from collections import Counter

import corpus_pipeline
from barloom.llm import class_models

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in rows], DOCS)


def kept_of(found):
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return Counter((r["doc_id"], r["text"]) for r in found.collect())


def test_one_of_each_group_whatever_the_ids(spark):
    a = " ".join(f"a{k}" for k in range(80))
    near_a, b, c = a + " more", " ".join(f"b{k}" for k in range(40)), " ".join(f"c{k}" for k in range(40))
    rows = [(5, "clean text of its own"), (5, a), (4, near_a), (5, b), (5, b), (None, b), (None, c),
            (None, c), (7, None), (7, None), (None, ""), (8, " "), (8, " ")]

    def alike(x, y):
        sets = [{tuple(t.split()[k:k + 5]) for k in range(max(1, len(t.split()) - 4))} for t in (x, y)]
        return 100 * len(sets[0] & sets[1]) >= 80 * len(sets[0] | sets[1])
    want, groups = Counter(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if not (t or "").strip():
            want[i, t] += 1
        elif not any(alike(t, other) for other in groups):
            groups.append(t)
            want[i, t] += 1
    assert kept_of(corpus_pipeline.keep_one_of_each(spark, docs_of(spark, rows), "")) == want


def test_contaminated_rows_go_whatever_their_ids(spark, tmp_path):
    passage = " ".join(f"p{k}" for k in range(20))
    spark.createDataFrame([(1, passage)], "item_id long, text string") \
        .write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(5, "clean"), (5, f"x {passage}"), (None, passage), (None, "clean"), (6, None), (6, None)]
    found = corpus_pipeline.drop_contaminated(spark, docs_of(spark, rows), str(tmp_path))
    assert kept_of(found) == Counter(r for r in rows if passage not in (r[1] or ""))


CLASHING = DOCS + (", print string, toxic_score string, n_pii string, pii_kinds string, kept int, row int, "
                   "docs int, one int, number int, n int, best int")


def clashing_of(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "x", len(t or ""), "mine", "mine", "mine", "mine", *range(7)) for i, t in rows], CLASHING)


def tables_of(spark, folder, docs):
    labels = [(k, 1, k % 2) for k in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"p{k}" for k in range(20)))], "item_id long, text string") \
        .write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")


def learning_rows():
    """Texts of labelled ids: odd ones hold a word that ordinary ones never do."""
    return [(k, " ".join(f"w{(k * 7 + j * j) % 50}" for j in range(12)) + (" vile" if k % 2 else " fine"))
            for k in range(60)]


def odd_rows():
    return [(100, None), (100, None), (101, ""), (None, " "), (102, "vile"), (None, "vile"), (103, "mild one"),
            (103, "mild one"), (None, "call 555-123-4567 now"), (104, " ".join(f"p{k}" for k in range(20)))]


def test_every_stage_passes_clashing_columns_through(spark, tmp_path):
    rows = learning_rows() + odd_rows()
    docs = clashing_of(spark, rows)
    tables_of(spark, str(tmp_path), docs)
    toxic = {t for _, t in rows if t and "vile" in t.split()}
    passage = " ".join(f"p{k}" for k in range(20))
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        got = out.collect()
        assert all(tuple(r)[5:] == ("mine",) * 4 + tuple(range(7)) for r in got), name
        seen.append((name, Counter((r["doc_id"], r["text"]) for r in got)))
        assert stage(spark, docs.filter("doc_id < -1"), str(tmp_path)).count() == 0, name
    want = dict(seen)
    assert want["toxicity"] == Counter(r for r in rows if r[1] not in toxic)
    assert want["decontamination"] == Counter(r for r in rows if r[1] != passage)
    assert sum(want["pii"].values()) == len(rows) and (None, "call 555-123-4567 now") not in want["pii"]
    tokens = corpus_pipeline.tokens(spark, docs, str(tmp_path)).collect()
    assert len(tokens) == len(rows) and all(r["round_trip"] for r in tokens)
    assert corpus_pipeline.tokens(spark, docs.filter("doc_id < -1"), str(tmp_path)).count() == 0


def test_the_whole_run_against_plain_stages(spark, tmp_path):
    from barloom.llm import pii
    from barloom.llm.queries import PII_KEY
    rows = learning_rows() + odd_rows() + [(200 + k, t + " more") for k, t in learning_rows() if k % 10 == 0]
    tables_of(spark, str(tmp_path), docs_of(spark, rows))

    def shingles(text):
        words = text.lower().split()
        return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    left = [r for r in rows if "vile" not in (r[1] or "").split()]
    kept, groups = [], []
    for i, t in sorted(left, key=lambda r: (r[0] is None, r[0] or 0)):
        s = shingles(t or "")
        if not s:
            kept.append((i, t))
        elif not any(100 * len(s & g) >= 80 * len(s | g) for g in groups):
            kept.append((i, t))
            groups.append(s)
    passage = " ".join(f"p{k}" for k in range(20))
    names = pii.Pseudonyms(PII_KEY)
    want = Counter((i, pii.replace(t, names)[0] or "") for i, t in kept if t != passage)
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(corpus_pipeline.BPE_FILE)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == Counter(
        {(i, tuple(library.encode(t, add_special_tokens=False).ids)): n for (i, t), n in want.items()})


def test_toxicity_stage_sums_both_models_over_every_word(spark, tmp_path):
    """The rows kept are those that plain sums over all words keep: no word or pair is left out."""
    from barloom.llm import toxicity
    rng = random.Random(16)
    texts = []
    for k in range(150):
        words = [f"w{min(rng.randrange(25), rng.randrange(25))}" for _ in range(rng.randrange(4, 16))]
        if k % 3 == 0:  # ordinary words, told apart only by their order
            at = rng.randrange(len(words) - 1)
            words[at:at + 2] = ["w1", "w2"]
        texts.append((k, " ".join(words)))
    spark.createDataFrame([(k, 0, int(k % 3 == 0)) for k in range(150)], "doc_id long, quality int, toxic int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    rows = texts + [(None, "w3 w1 w2 w0 w4"), (900, "w2 w1 w0 w3 w4"), (901, "never learnt"), (902, None)]
    docs = docs_of(spark, rows)
    learnt = [k for k in range(150) if zlib.crc32(str(k).encode()) % 5]
    model = toxicity.learn(docs, spark.read.parquet(str(tmp_path / "labels.parquet")).filter(toxicity.learnable()))
    counts, first = (Counter(), Counter()), {}
    for k in learnt:
        first.setdefault(texts[k][1], k)
    for text, k in first.items():
        words = text.split()
        counts[k % 3 != 0].update({*zip([None, *words], words)})
    size, strength = len({w for of in counts for _, w in of}) + 1, model.models.backoffs[0]

    def probability(of, before, word):
        def discount(values):
            ones, twos = values.count(1), values.count(2)
            return ones / (ones + 2 * twos) if ones and twos else .75
        contexts = list(Counter(w for _, w in of).values())
        d = discount(contexts)
        alone = (max(sum(w == word for _, w in of) - d, 0) + d * len(contexts) / size) / len(of)
        d = discount(list(of.values()))
        followers = [n for (v, _), n in of.items() if v == before]
        prior = strength * sum(of.values())
        return (max(of[before, word] - d, 0) + (d * len(followers) + prior) * alone) / (sum(followers) + prior)
    want = Counter()
    for i, t in rows:
        words = (t or "").split()
        mean = sum(math.log(.99 + .01 * probability(counts[0], v, w) / probability(counts[1], v, w))
                   for v, w in zip([None, *words], words)) / max(len(words), 1)
        assert abs(mean - model.threshold) > 1e-6
        want[i, t] += mean < model.threshold
    kept = kept_of(corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)))
    assert kept == +want and (None, "w3 w1 w2 w0 w4") not in kept and (900, "w2 w1 w0 w3 w4") in kept


def test_decoders_get_no_texts(spark, monkeypatch, tmp_path):
    texts = ["Lorem  ipsum\n", "", None, "déjà 中文 \U0001f600", "Lorem  ipsum\n"]
    docs = spark.createDataFrame([(k, t, "en", "web") for k, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string")
    staged = []
    monkeypatch.setattr(corpus_pipeline, "stage_table",
                        lambda df, label, stage=corpus_pipeline.stage_table: staged.append(df.columns) or stage(df, label))
    rows = corpus_pipeline.tokens(spark, docs, str(tmp_path)).orderBy("doc_id").collect()
    assert len(rows) == 5 and all(r["round_trip"] is True for r in rows)
    assert rows[0]["ids"] == rows[4]["ids"] and rows[1]["ids"] == rows[2]["ids"] == []
    assert "ids" in staged[0] and "text" not in staged[0]
    # A decoder that loses something is noticed.
    monkeypatch.setattr(corpus_pipeline.bpe, "decode", lambda encoded, path: encoded.withColumn(
        "decoded", corpus_pipeline.F.when(corpus_pipeline.F.col("doc_id") == 3, "").otherwise("Lorem  ipsum\n")))
    rows = corpus_pipeline.tokens(spark, docs, str(tmp_path)).orderBy("doc_id").collect()
    assert [r["round_trip"] for r in rows] == [True, False, False, False, True]


def test_scorers_and_decoders_get_few_rows_at_once(spark, monkeypatch, tmp_path):
    def told(which, df):
        folder = tmp_path / which
        folder.mkdir(exist_ok=True)

        def run(batches):
            for batch in batches:
                (folder / f"{len(batch)}").touch()
                yield batch
        return df.mapInArrow(run, df.schema)

    def most(which):
        return max(int(p.name) for p in (tmp_path / which).iterdir())
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    rows = learning_rows()
    rows += [(1_000 + k, rows[k % 30 * 2][1]) for k in range(2_000)]
    docs = docs_of(spark, rows).coalesce(1)
    tables_of(spark, str(tmp_path), docs)
    decode, differences = corpus_pipeline.bpe.decode, class_models.differences
    monkeypatch.setattr(corpus_pipeline.bpe, "decode", lambda encoded, path: decode(told("ids", encoded), path))
    monkeypatch.setattr(class_models, "differences", lambda texts, *rest: differences(told("texts", texts), *rest))
    got = corpus_pipeline.tokens(spark, docs, str(tmp_path)).collect()
    assert len(got) == len(rows) and all(r["round_trip"] for r in got)
    kept = kept_of(corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)))
    assert kept == Counter(r for r in rows if "vile" not in r[1].split())
    assert most("ids") <= 500 and most("texts") <= 500
    assert spark.conf.get(key) == before
